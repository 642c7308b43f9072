"""Filter interaction audit: what each of several document filters removes, in every order of applying them.

Each document row gets a bit for every filter it fails.  The failures by
condition on the row itself come from one scan.  A repeated text fails by an
existential self-join: documents are left-semi-joined with the smaller ids of
documents of equal hash and exactly equal text.  The failing ids of both kinds
are united and counted by bit combination, so all orders follow from at most
2^filters counts a part; no order is ever run.

Plan.  Hashes are counted first (8 bytes a row), and only rows whose hash
occurs again take their texts further, so texts that are unique are not
shuffled while the list of repeated hashes is small enough to broadcast
(``BROADCAST_HASHES``; joined otherwise).  The right side of the semi-join is
reduced to the least id of each text before its shuffle, so a group of copies
that holds a third of all rows is one row there, and no pair of copies is made;
the left side of such a group is split by adaptive execution.  Failing rows are
reduced to (id, part, bits) counts before labels are joined, so rows without an
id or under one id are one row.

Null text: as empty (0 words: fails ``A`` only).  Two null or empty texts are
equal.  Null id: never a smaller id, and never larger than one, so it does not
fail ``E``; rows that repeat an id and text are no copies of each other.  Null
lang: part ''.  Null or missing labels: neither good nor toxic; a labelled id
that is repeated counts by its largest values.  Empty table: empty result.
Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popcorr.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: The filter of texts that a smaller id has too.
REPEATED = "E"
#: Repeated hashes that may be broadcast (8 bytes each).
BROADCAST_HASHES = 1_000_000


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on one text: few words, repeated words, capitals, odd signs."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.char_length(text).cast("long") * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def repeated(rows: DataFrame) -> DataFrame:
    """The rows of (id, text, ...) whose text a smaller id has too: left-semi join on hash, exact text and smaller id."""
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    again = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    again = cut_lineage(again, "audit_hashes")
    again = F.broadcast(again) if again.count() <= BROADCAST_HASHES else again
    copies = cut_lineage(rows.join(again, "_hash", "left_semi"), "audit_copies")
    least = copies.groupBy("_hash", "text").agg(F.min("id").alias("least"))
    least = cut_lineage(least.withColumnsRenamed({"_hash": "h", "text": "t"}), "audit_least")
    same = (F.col("_hash") == F.col("h")) & (F.col("text") == F.col("t")) & (F.col("least") < F.col("id"))
    return copies.join(least, same, "left_semi").drop("_hash")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
             filters=text_filters, repeated_as: str | None = REPEATED) -> tuple[DataFrame, list[str]]:
    """(id, part, bits, n): how many rows of an id in a part fail which filters; and the filters by bit."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [*filters(F.col("text")), *([repeated_as] if repeated_as else [])]

    def bits(df: DataFrame) -> DataFrame:
        own = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters(F.col("text")).values())]
        return df.select("id", "part", sum(own, F.lit(0)).alias("bits"))

    failing = bits(rows).withColumn("n", F.lit(1))
    if repeated_as:
        # united with the ids that fail by repetition: their rows move from a combination to the one with that bit
        again = cut_lineage(bits(repeated(rows)), "audit_repeated")
        failing = (failing.unionByName(again.withColumn("n", F.lit(-1)))
                   .unionByName(again.withColumn("bits", F.col("bits") + F.lit(1 << (len(names) - 1))).withColumn("n", F.lit(1))))
    return failing.groupBy("id", "part", "bits").agg(F.sum("n").alias("n")).where("n > 0"), names


def combinations_by_part(failing: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, bits, good, toxic, n): rows by failing filters and labels; at most 4 x 2^filters rows a part."""
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")))
    yes = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    return (failing.join(known, "id", "left")
            .groupBy("part", "bits", yes("quality").alias("good"), yes("toxic").alias("toxic")).agg(F.sum("n").alias("n")))


def interactions(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of all filters and step, from the counts of ``combinations_by_part``.

    A step depends on its filter and on the set of those before it only, so each part has filters x 2^(filters - 1)
    different steps; orders share them.  A filter's Shapley sum weighs each by the orders that have it.
    """
    n, bit = len(names), {f: 1 << i for i, f in enumerate(names)}
    cases = [(f, sum(bit[x] for x in before), factorial(k) * factorial(n - 1 - k))
             for f in names for k in range(n) for before in combinations([x for x in names if x != f], k)]
    case = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(bit[f]).alias("bit"), F.lit(s).alias("before"),
                                        F.lit(w).alias("orders")) for f, s, w in cases]))
    rows = counts.withColumn("_c", case).select("part", "bits", "good", "toxic", "n", "_c.*")
    fails, seen = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0)))
    steps = rows.groupBy("part", "filter", "before", "orders").agg(
        total(~fails & ~seen).alias("kept"), total(fails & ~seen).alias("removed"), total(fails & seen).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"),
        total(fails & ~seen & F.col("good")).alias("good_lost"), total(fails & ~seen & F.col("toxic")).alias("toxic_lost"))
    shapley = steps.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = steps.drop("orders").join(shapley, ["part", "filter"])
    orders = [("".join(p), k + 1, p[k], sum(bit[x] for x in p[:k])) for p in permutations(names) for k in range(n)]
    orders = counts.sparkSession.createDataFrame(orders, "filter_order string, step int, filter string, before int")
    return (steps.join(F.broadcast(orders), ["filter", "before"])               # filters x filters! rows, fixed
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          filters=text_filters, repeated_as: str | None = REPEATED) -> DataFrame:
    """The counts of every part, order and step; ``filters`` maps a text column to named failure conditions."""
    failing, names = failures(docs, id_col, text_col, part_col, filters, repeated_as)
    counts = cut_lineage(combinations_by_part(failing, labels, id_col), "audit_counts")
    return interactions(counts, names)
