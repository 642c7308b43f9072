"""Join helpers: broadcast only behind a size check, salt where a key is hot.

``bounded_broadcast`` counts at most ``max_rows + 1`` rows of the candidate
side (a bounded job) and only then hints ``broadcast``; above the bound the
join stays a shuffle join that AQE can re-plan and split for skew.  It is
used where the optimizer has no size statistics for a side (computed
frames); joins against written layer tables leave the choice to Catalyst's
statistics-based broadcast threshold and AQE.

``salted_join_many`` joins a large, possibly skewed fact side to a modest
side on a key where one key value may hold a third of all fact rows: the
fact side gets a random-free, deterministic salt, the other side is
replicated once per salt value, and the join runs on (key, salt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a side is never broadcast.  A dimension row here is a few
# short columns, so this keeps a broadcast well below 100 MB.
BROADCAST_MAX_ROWS = 1_000_000
# Replication factor of the small side in a salted join.
DEFAULT_SALTS = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def salted_join_many(big: DataFrame, small: DataFrame, key: str, salt_cols: list[str],
                     salts: int = DEFAULT_SALTS, how: str = "inner") -> DataFrame:
    """Join ``big`` to ``small`` on ``key``, spreading every key over ``salts`` tasks.

    The salt of a ``big`` row is a hash of ``salt_cols`` (deterministic, so a
    retried task reproduces the same rows); ``small`` is replicated ``salts``
    times with ``explode(sequence(...))``.
    """
    salted_big = big.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salts)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, [key, "_salt"], how).drop("_salt")


def join_one_to_many(big: DataFrame, small: DataFrame, key: str, salt_cols: list[str],
                     salts: int | None = None) -> DataFrame:
    """Equi-join on one key where ``small`` fans each ``big`` row out.

    Default: a plain join.  ``small`` here is a scan/aggregate of a written
    layer table, so Catalyst has file statistics: below
    ``spark.sql.autoBroadcastJoinThreshold`` it plans a broadcast hash join
    (no shuffle of ``big``; a hot key costs nothing extra), above it a
    sort-merge join whose skewed partitions AQE splits across tasks.  With
    ``salts`` the join is salted explicitly (for a side known to be too big
    to broadcast with keys known to be hot).
    """
    if salts:
        return salted_join_many(big, small, key, salt_cols, salts)
    return big.join(small, key, "inner")
