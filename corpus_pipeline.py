"""The corpus pipeline: five stages, each one operator of ``popcorr.llm`` applied to all that the stage before kept.

1 language ID                 rejects documents without letters, or unlike every language learned
2 n-gram Jaccard join         one document of each class of near copies stays (the one of least id)
3 benchmark decontamination   documents that hold a test item go
4 mixing                      documents are repeated or left out so that sources meet their target weights
5 sharding                    every row that is left gets its shard and slot

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  Lists of ids are broadcast only when
counted to be small, and joined otherwise.  Rows with a null id stay as long as
no stage finds a reason against their text; rows that repeat an id with another
text are documents of their own, except that the mix takes them equally often
and a test item in one is held against both.  Ties go to the least id, or to the
order that the operator's module states.  Texts of any length go through whole.
Columns other than those of ``documents`` are left out by the first stage,
whatever their names.  Where no row tells a language, none is rejected for it.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popcorr.llm import decontaminate, lang_id, mixture, ngram_join, shards, textops
from popcorr.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Likeness to the nearest language under which a document is rejected (prose of any length has about 0.4 or more).
LEAST_SCORE = 0.25
SHARDS = 16
#: Ids that may be broadcast (16 bytes each), and rows of an Arrow batch of texts.
BROADCAST_IDS, BATCH_ROWS = 1_000_000, 500

#: SQL cannot express rank-order language profiles or alignments; tests hold the stages against brute force.
ORACLE_SQL = None


def _small(ids: DataFrame) -> DataFrame:
    ids = cut_lineage(ids, "pipeline_ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _without(docs: DataFrame, gone: DataFrame, by: str = "doc_id") -> DataFrame:
    """``docs`` but for the ids of ``gone`` (a null there stands for rows without an id)."""
    return docs.join(_small(gone.select(F.col("doc_id").alias("_id")).distinct()),
                     F.col(by).eqNullSafe(F.col("_id")), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told; all with a letter where no language could be learned."""
    docs = docs.select(*COLUMNS)
    profiles = lang_id.learn(docs.where(~lang_id.held_out(F.col("doc_id"))), F.col("text"), F.col("lang"))
    profiles = cut_lineage(profiles, "pipeline_profiles")
    if profiles.isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = lang_id.predict(docs, profiles)
    return told.where((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents; of rows that repeat an id, one."""
    docs = docs.select(*COLUMNS)
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        classes = ngram_join.classes(docs)
        return _without(docs, classes.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))
    # ids that repeat or are missing: rows are told apart by id (null last) and text
    own = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))
    docs = docs.withColumn("_row", own)
    classes = ngram_join.classes(docs, id_col="_row")
    gone = classes.where(F.col("_row") != F.col("component_id")).select(F.col("_row").alias("doc_id"))
    return _without(docs.dropDuplicates(["_row"]), gone, "_row").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    docs = docs.select(*COLUMNS)
    with textops.arrow_rows(spark, BATCH_ROWS):
        return _without(docs, decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0, 1 or 2 times."""
    docs = docs.select(*COLUMNS)
    times = mixture.mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").cast("int").alias("_times")).where("_times > 0")
    taken = docs.join(_small(times), F.col("doc_id").eqNullSafe(F.col("_id")))
    return taken.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return shards.shard(docs.select(*COLUMNS), SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
