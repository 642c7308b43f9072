"""Ranking without funnelling a group into one task.

``rank_within`` gives every row its 0-based position inside its group under a
total order, like ``row_number() OVER (PARTITION BY g ORDER BY o) - 1``, but
without a window whose partition holds a whole group: rows are range
partitioned on (g, o) - a hot group is split across many tasks - sorted
inside each task, numbered locally, and shifted by the number of rows of the
same group in all earlier tasks (a prefix sum over a table of at most
tasks x groups rows).  Meant for few, possibly huge groups (class labels);
the order must be total (end it with a unique id).  The numbered rows are
written once to the shared folder, so every later use sees the same task
assignment (and a lost executor does not renumber anything).

``top_n`` is the bounded global top-k: ``orderBy().limit(n)`` plans a
TakeOrderedAndProject (per-task top-k, then a merge of k rows per task), and
only those n rows are numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popcorr.operators.joins import bounded_broadcast
from popcorr.session import cut_lineage


def rank_within(df: DataFrame, group, order: list, out: str = "pos",
                num_partitions: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``columns`` only, which must hold the group's) with each row's position."""
    groups = [group] if isinstance(group, str) else list(group)
    gcols = [F.col(g) for g in groups]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    # written once: the per-task offsets and the rows must see the same task
    # assignment, and a re-evaluated range partitioning (sampled bounds over an
    # input whose order can vary between runs) could assign rows differently
    columns = columns or df.columns
    ranked = cut_lineage(df.repartitionByRange(n, *gcols, *order_cols)
                           .sortWithinPartitions(*gcols, *order_cols)
                           .select(*columns)
                           .withColumn("_pid", F.spark_partition_id())
                           .withColumn("_mid", F.monotonically_increasing_id()), "rank_within")
    # rows of each group per task, and where the group starts inside the task
    blocks = ranked.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_cnt"),
                                                  F.min("_mid").alias("_first"))
    w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    # tasks x groups rows: broadcast after a size check (labels: a handful per task)
    return (ranked.join(bounded_broadcast(offsets.select("_pid", *groups, "_first", "_before")),
                        ["_pid", *groups])
                  .withColumn(out, F.col("_before") + F.col("_mid") - F.col("_first"))
                  .select(*columns, out))


def top_n(df: DataFrame, n: int, order: list, out: str = "rank") -> DataFrame:
    """The first n rows under ``order`` with a 1-based ``rank``."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("int"))
