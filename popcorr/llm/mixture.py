"""Mixing sources to target weights by Pareto order sampling.

Each source has a target of words (capped water filling over the sources'
weights).  Every document first gets ``floor(target / source size)`` certain
whole copies.  The rest is a fixed-size unequal-probability sample: documents
are ranked by their random odds divided by their inclusion odds,

    rank = (U / (1 - U)) / (p / (1 - p)),   odds of p = source odds x sqrt(size / mean size)

and taken in that order as long as they fit; a document that does not fit is
skipped.  When none that is left fits, one closing document - the one whose size
is nearest to the words still missing - is added if that brings the source nearer
to its target.  U is a hash of the document id, so reruns agree.  The source's
own odds are the same for all its documents and cancel in the order.

A source may hold a third of all rows, so no source is ever sorted in one
task: words are summed per (source, rank bucket) first, the bucket in which
the target falls is found from those sums, and only that bucket is ordered.  Skipping
goes by rounds: each repeats this over the documents left that fit what is
missing.  A round ends before a document longer than what it leaves, so it takes
a part of the gap at random and rounds grow with the logarithm of the gap.
Broadcasts: the table of sources, when counted to be small; else a join.

Null text has 0 words and 0 taken.  Null source is a source of its own (last).
Repeated rows are separate rows with equal rank.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popcorr.session import cut_lineage

#: Words are runs of anything but space and the controls U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
TOTAL_SHARE, CAP = 1.5, 2
SEED = "mix-1"
#: Rank buckets: one for so many documents; so only about this many are ordered together.
DOCS_PER_BUCKET, MIN_BUCKETS, MAX_BUCKETS = 4096, 256, 1 << 20
#: Sources that may be broadcast (a row is a name and five numbers).
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from 52 bits of the key's MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit("|" + seed))), 1, 13), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: source_size, n, target.  Weights repeat over the sources by code point, null last.

    Water filling in closed form: with sources by cap / weight ascending, the
    level is (total - caps of those before) / (weights from here on) at the
    first source where that does not exceed its own cap / weight.  One row per
    source, so the windows here are over the short list of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("_i", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.col("_i") - 1, F.lit(len(WEIGHTS))).cast("int") + 1)
    per = per.withColumn("weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * CAP)
    per = per.withColumn("_ratio", F.col("_cap").cast("double") / F.col("weight"))
    order = Window.orderBy("_ratio", "_i")
    whole = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(TOTAL_SHARE) * F.sum("source_size").over(whole)
    per = per.withColumn("_level", (total - before) / onward).withColumn("_k", F.row_number().over(order))
    per = per.withColumn("_first", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.col("_k"))).over(whole))
    per = per.withColumn("_t", F.max(F.when(F.col("_k") == F.col("_first"), F.col("_level"))).over(whole))
    target = F.least(F.col("_cap").cast("double"), F.col("_t") * F.col("weight"))
    return per.select("source", "source_size", "n", target.alias("target"))


def _take(rows: DataFrame, fits: Column, small) -> DataFrame:
    """``rows`` with extra = 1 also for those that ``fits`` marks and that, in rank order, come before the first one over ``room``."""
    # the bucket in which each source's room ends, and the words before it
    sums = rows.where(fits).groupBy("source", "room", "bucket").agg(F.sum("size").alias("words"))
    w = Window.partitionBy("source").orderBy("bucket")
    edge = (sums.withColumn("upto", F.sum("words").over(w))
                .where("upto > room")
                .groupBy(F.col("source").alias("_s")).agg(F.min("bucket").alias("edge"),
                                                          F.min(F.col("upto") - F.col("words")).alias("before")))
    edge = cut_lineage(edge, "mix_edges")
    rows = rows.join(small(edge), rows["source"].eqNullSafe(edge["_s"]), "left").drop("_s")
    at_edge = fits & F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    inside = (rows.where(at_edge)
              .withColumn("upto", F.col("before") + F.sum("size").over(
                  Window.partitionBy("source").orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("extra", (F.col("upto") <= F.col("room")).cast("int")).drop("upto"))
    before = (F.col("bucket") < F.col("edge")) | (F.col("edge").isNull() & (F.col("room") > 0))
    return inside.unionByName(rows.where(~at_edge).withColumn(
        "extra", F.when(fits & F.coalesce(before, F.lit(False)), F.lit(1)).otherwise(F.col("extra"))))


def _gaps(chosen: DataFrame) -> DataFrame:
    """(source, words still missing) for every source."""
    return (chosen.groupBy("source", "rest").agg(F.sum(F.col("size") * F.col("extra")).alias("_got"))
                  .select(F.col("source").alias("_s"), (F.col("rest") - F.col("_got")).alias("gap")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED) -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row of ``docs``."""
    sizes = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size"),
                                    uniform(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), seed).alias("u")), "mix_sizes")
    per = cut_lineage(source_targets(sizes), "mix_sources")
    rows, names = per.agg(F.sum("n"), F.count(F.lit(1))).first()
    small = F.broadcast if names <= BROADCAST_SOURCES else (lambda df: df)
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, (rows or 0) // DOCS_PER_BUCKET))

    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    per = (per.withColumn("base", base)
              .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
              .withColumn("mean", F.col("source_size") / F.col("n"))
              .withColumnRenamed("source", "_s").drop("n"))
    tilt = F.sqrt(F.col("size") / F.col("mean"))
    ranked = (sizes.join(small(per), sizes["source"].eqNullSafe(per["_s"])).drop("_s")
              .withColumn("rank", F.when(F.col("size") > 0, (F.col("u") / (1 - F.col("u"))) / tilt))
              .withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * buckets).cast("int")))

    keep = ["id", "source", "size", "source_size", "target", "base", "rest", "rank", "bucket", "extra"]
    ranked = ranked.withColumn("extra", F.lit(0))
    chosen = cut_lineage(_take(ranked.withColumn("room", F.col("rest")), F.col("size") > 0, small).select(*keep), "mix_chosen")
    gap = cut_lineage(_gaps(chosen), "mix_gaps")
    while True:
        fits = (F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("room"))
        rows = chosen.join(small(gap), chosen["source"].eqNullSafe(gap["_s"])).drop("_s").withColumnRenamed("gap", "room")
        if rows.where(fits).isEmpty():
            break
        chosen = cut_lineage(_take(rows, fits, small).select(*keep), "mix_chosen")
        gap = cut_lineage(_gaps(chosen), "mix_gaps")

    # the closing document: of those left out, the one whose size is nearest to what is missing
    left = chosen.where("extra = 0 and size > 0")
    left = (left.join(small(gap), left["source"].eqNullSafe(gap["_s"])).drop("_s")
                .withColumn("off", F.abs(F.col("gap") - F.col("size"))).where("off < gap"))
    best = left.groupBy("source").agg(F.min("off").alias("_off"))
    best = best.withColumnRenamed("source", "_s")
    closing = (left.join(small(best), left["source"].eqNullSafe(best["_s"]) & (left["off"] == best["_off"]))
                   .groupBy("source").agg(F.min("id").alias("_id")).withColumnRenamed("source", "_s"))
    closing = cut_lineage(closing, "mix_closing")
    last = (F.col("extra") == 0) & (F.col("id") == F.col("_id"))
    return (chosen.join(small(closing), chosen["source"].eqNullSafe(closing["_s"]), "left")
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    (F.col("base") + F.when(F.col("size") > 0, F.col("extra") + F.coalesce(last, F.lit(False)).cast("int")).otherwise(0))
                    .alias("copies")))
