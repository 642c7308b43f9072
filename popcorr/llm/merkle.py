"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

Leaves are the sentences of a text (pieces that end after ". ", "! ", "? " or
a line feed), so even a text of one paragraph has branches.  Leaves up to a
line feed form a paragraph; paragraphs form sections whose ends are chosen by
content (a paragraph digest with a last hex digit 0 or 8 ends a section), so
an edit moves no boundary elsewhere.  Each node is the SHA-256 of its
children's digests, and the root is that of the sections.

fingerprint = root (64 hex) ":" section digests (8 hex each, joined by ".")
              ":" leaf digests (8 hex each, joined by ".")

Equal texts have equal fingerprints; different roots mean different texts.
Sections and leaves that differ locate the edit (``changed_leaves``), and the
likeness of two fingerprints is the Dice share of their distinct leaves.

Only DataFrame functions; linear in the length of a text.  Null text counts as
empty; an empty text has one empty leaf.  Repeated rows: each has its own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Neighbouring ids in one bucket, and the most buckets (so the bucket table has a proven bound).
MIN_WIDTH, MAX_BUCKETS = 512, 100_000
_CUT = "\u0001"


def leaves(text: Column) -> Column:
    """The sentences of a text with their end marks; a literal U+0001 is kept apart by a mark after it."""
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit(_CUT), F.lit(_CUT + "\u0002"))
    return F.split(F.regexp_replace(safe, r"([.!?] |\n)", "$1" + _CUT), _CUT)


def _sha(c: Column) -> Column:
    return F.sha2(c, 256)


def tree(text: Column) -> Column:
    """The leaf digests in one string, ";" after the last leaf of a paragraph and "," after others; ``fold`` takes it."""
    return F.array_join(F.transform(leaves(text), lambda p: F.concat(
        _sha(p), F.when(F.endswith(p, F.lit("\n")), F.lit(";")).otherwise(F.lit(",")))), "")


def fold(marked: Column) -> Column:
    """Fingerprint from the marked leaf digests of ``tree``."""
    paragraphs = F.filter(F.split(marked, ";"), lambda p: p != "")
    digests = F.transform(paragraphs, _sha)
    run = F.array_join(F.transform(digests, lambda d: F.concat(
        d, F.when(F.substring(d, 64, 1).isin("0", "8"), F.lit(";")).otherwise(F.lit(",")))), "")
    sections = F.transform(F.filter(F.split(run, ";"), lambda s: s != ""), _sha)
    short = F.transform(sections, lambda s: F.substring(s, 1, 8))
    leaf = F.regexp_replace(marked, "([0-9a-f]{8})[0-9a-f]{56}[,;]", "$1.")
    return F.concat(_sha(F.array_join(sections, ".")), F.lit(":"), F.array_join(short, "."),
                    F.lit(":"), F.rtrim(leaf, F.lit(".")))


def leaf_digests(fingerprint: Column) -> Column:
    return F.split(F.substring_index(fingerprint, ":", -1), r"\.")


def likeness(a: Column, b: Column) -> Column:
    """Dice share of the distinct leaves of two fingerprints, 0 to 1; 1 if the roots are equal."""
    x, y = F.array_distinct(leaf_digests(a)), F.array_distinct(leaf_digests(b))
    return F.when(a == b, F.lit(1.0)).otherwise(
        2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def changed_leaves(a: Column, b: Column) -> Column:
    """Positions (from 0) of the leaves of ``a`` that ``b`` lacks: where the edit is."""
    x, y = leaf_digests(a), F.array_distinct(leaf_digests(b))
    return F.filter(F.transform(x, lambda d, i: F.when(~F.array_contains(y, d), i)), lambda i: i.isNotNull())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id, text) with its fingerprint; a narrow pass."""
    out = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    return out.withColumn("_m", tree(F.col(text_col))).withColumn("fingerprint", fold(F.col("_m"))).drop("_m")


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows by id (after the last: the first).

    Rows go once, by id range, into buckets of bounded width; the first row of
    a bucket also goes to the end of the bucket before it, so a window within
    each bucket sees every neighbour and the texts are shuffled only once.
    Null ids come first.  Rows that repeat an id follow each other by their columns.
    """
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(MIN_WIDTH, -(-(high - low + 1) // MAX_BUCKETS))
    bucket = F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(
        F.floor((F.col(id_col) - F.lit(low)) / F.lit(width))).cast("long")
    edges = (docs.select(F.col(id_col), bucket.alias("_b")).groupBy("_b").agg(F.min(id_col).alias("_first")))
    w = Window.orderBy("_b")                       # at most MAX_BUCKETS + 1 rows
    edges = edges.select("_b", "_first", F.coalesce(F.lag("_b").over(w), F.max("_b").over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"))
    rows = docs.withColumn("_b", bucket).join(F.broadcast(edges), "_b")
    places = F.when(F.col(id_col).eqNullSafe(F.col("_first")),
                    F.array(F.struct(F.lit(0).alias("copy"), F.col("_b").alias("to")),
                            F.struct(F.lit(1).alias("copy"), F.col("_to").alias("to")))
                    ).otherwise(F.array(F.struct(F.lit(0).alias("copy"), F.col("_b").alias("to"))))
    rows = rows.withColumn("_p", F.explode(places)).select(*docs.columns, F.col("_p.copy").alias("_copy"), F.col("_p.to").alias("_to"))
    order = Window.partitionBy("_to").orderBy("_copy", F.col(id_col).asc_nulls_first(), *[F.col(c) for c in columns])
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.where("_copy = 0").drop("_copy", "_to")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form (last half replaced from the next document)."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = with_next(fingerprints(thin, "id", "text"), "id", ["fingerprint", "text"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"),
                      F.expr("substring(next_text, 1, cast(floor(char_length(text) / 2) as int))"))
    rows = rows.select("id", n.cast("long").alias("n_chars"), half.alias("_h"), edited.alias("_e"), "fingerprint", "next_fingerprint")
    rows = rows.withColumn("edited_sha256", _sha(F.col("_e"))).withColumn("_m", tree(F.col("_e")))
    rows = rows.withColumn("edited_fingerprint", fold(F.col("_m")))
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
