"""Layer I/O: raw JSON envelopes, formatted/usage Parquet, inventory, bad records.

Layout: ``<root>/<layer>/<group>/<entity>/run_date=YYYYMMDD/part-*.parquet``.
``run_date`` is a Hive partition column, so reading one run is partition
pruning and re-running one day overwrites only that day (dynamic partition
overwrite).  Raw envelopes are JSON objects ``{metadata..., <array>: [...]}``;
the writer emits one envelope per bounded chunk (never the whole table as one
array in one task), the reader ``inline``s the array of every envelope.
"""

from __future__ import annotations

from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from popcorr.session import cut_lineage, path_exists

RUN_DATE_COL = "run_date"
# Records per raw envelope chunk.
ENVELOPE_CHUNK_ROWS = 50_000


def layer_path(root: str, layer: str, group: str, entity: str) -> str:
    """``root/layer/group/entity``; run dates are partitions below it."""
    return "/".join([root.rstrip("/"), layer, group, entity])


# ── raw envelopes ────────────────────────────────────────────────────────────
def write_envelope(records: DataFrame, path: str, meta: dict, array_field: str,
                   chunk_rows: int = ENVELOPE_CHUNK_ROWS) -> None:
    """Write records as JSON-lines envelopes of about ``chunk_rows`` records.

    Records are written once (the upstream runs once) and spread over
    ``ceil(n / chunk_rows)`` buckets by a hash of their own columns, so a
    retried task deals them the same way; each bucket becomes one envelope
    carrying ``meta`` plus its own ``count``.
    """
    records = cut_lineage(records, "envelope")
    n = records.count()
    chunks = max(1, -(-n // chunk_rows))
    bucket = F.pmod(F.xxhash64(*records.columns), F.lit(chunks))
    meta_cols = [F.lit(v).alias(k) if not isinstance(v, list)
                 else F.array(*[F.lit(x) for x in v]).cast("array<string>").alias(k)
                 for k, v in meta.items()]
    env = (records.withColumn("_chunk", bucket)
                  .groupBy("_chunk")
                  .agg(F.collect_list(F.struct(*records.columns)).alias(array_field))
                  .select(*meta_cols, F.size(array_field).cast("int").alias("count"),
                          F.col(array_field)))
    env.write.mode("overwrite").json(path)


def read_envelope(spark: SparkSession, path: str, envelope_schema: StructType,
                  array_field: str, multi_line: bool = False) -> DataFrame:
    """All records of all envelopes under ``path``; a missing array gives no rows."""
    env = spark.read.schema(envelope_schema).option("multiLine", multi_line).json(path)
    return env.select(F.inline(F.coalesce(F.col(array_field), F.array().cast(
        envelope_schema[array_field].dataType))))


def read_envelope_meta(spark: SparkSession, path: str, envelope_schema: StructType,
                       array_field: str, multi_line: bool = False) -> DataFrame:
    """Envelope metadata (everything but the record array)."""
    env = spark.read.schema(envelope_schema).option("multiLine", multi_line).json(path)
    return env.drop(array_field)


# ── formatted / usage Parquet ────────────────────────────────────────────────
def write_layer(df: DataFrame, path: str, run_date: str, sort_cols: list[str] | None = None,
                compression: str = "snappy", metrics: bool = True, range_sorted: bool = False,
                skip_empty: bool = False) -> dict:
    """Overwrite one ``run_date`` partition of a layer table; return run metadata.

    Rows are sorted within output files; with ``range_sorted`` they are range
    partitioned first, so the files follow each other in order too.  With
    ``skip_empty`` an empty frame writes nothing and leaves what is there.
    The row count is observed during the write itself (no second pass).
    """
    if skip_empty and df.isEmpty():
        return {"date": run_date, "row_count": 0, "path": path, "written": False}
    out = df.withColumn(RUN_DATE_COL, F.lit(run_date))
    if sort_cols:
        if range_sorted:
            out = out.repartitionByRange(*sort_cols)
        out = out.sortWithinPartitions(*sort_cols)
    rows = None
    obs = Observation("layer_write")
    if metrics:
        out = out.observe(obs, F.count(F.lit(1)).alias("row_count"))
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(RUN_DATE_COL)
        .parquet(path))
    if metrics:
        rows = _observed_rows(obs, df.sparkSession, path, run_date)
    return {"date": run_date, "row_count": rows, "path": path, "written": True}


def _observed_rows(obs: Observation, spark: SparkSession, path: str, run_date: str) -> int:
    """The observed count.  A plan that was optimised to an empty relation observes nothing:
    the written partition is then counted, so a failure shows as an error and not as 0 rows."""
    try:
        seen = obs.get
    except Py4JJavaError:
        seen = {}
    if "row_count" in seen:
        return int(seen["row_count"])
    target = f"{path}/{RUN_DATE_COL}={run_date}"
    return spark.read.parquet(target).count() if path_exists(spark, target) else 0


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None,
               run_date: str | None = None) -> DataFrame:
    """Read a layer table (optionally one run date, pruned by partition)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType(list(schema.fields)
                                          + [StructField(RUN_DATE_COL, StringType(), True)]))
    df = reader.parquet(path)
    if run_date is not None:
        df = df.where(F.col(RUN_DATE_COL) == run_date)
    return df


def read_optional(spark: SparkSession, path: str, schema: StructType,
                  run_date: str | None = None) -> DataFrame:
    """Like ``read_layer`` but a missing source yields an empty, typed frame (any other trouble is an error)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_layer(spark, path, schema, run_date).drop(RUN_DATE_COL)


def partition_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Objects under a layer table: one row per (run_date, file) with its row count."""
    df = spark.read.parquet(path)
    return (df.select(F.col(RUN_DATE_COL).cast("string").alias(RUN_DATE_COL),
                      F.col("_metadata.file_path").alias("file_path"))
              .groupBy(RUN_DATE_COL, "file_path").agg(F.count(F.lit(1)).alias("rows")))


@contextmanager
def footers_only(spark: SparkSession):
    """Parquet through the source that pushes counts into file footers, for reads planned and run inside."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def count_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(run_date, rows); inside ``footers_only`` no row is read."""
    return spark.read.parquet(path).groupBy(RUN_DATE_COL).agg(F.count(F.lit(1)).alias("rows"))


def partition_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each run date of a layer table, from metadata alone."""
    with footers_only(spark):
        counts = cut_lineage(count_partitions(spark, path), "partition_rows")
    return counts.select(F.col(RUN_DATE_COL).cast("string").alias(RUN_DATE_COL), "rows")


# ── partial-failure loading ─────────────────────────────────────────────────
CORRUPT_COL = "_corrupt_record"


def read_json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a corrupt-record column (PERMISSIVE): nothing is dropped."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])
    return (spark.read.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL).json(path))


def split_bad_records(df: DataFrame, key_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with their raw text).

    A record is bad when it does not parse or when it lacks a key field
    (incomplete).  Referencing the keys also keeps Spark from rejecting a
    raw-JSON query that would touch only the corrupt-record column.
    """
    bad = F.col(CORRUPT_COL).isNotNull()
    for k in key_cols:
        bad = bad | F.col(k).isNull()
    return df.where(~bad).drop(CORRUPT_COL), df.where(bad)
