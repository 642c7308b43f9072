"""raw -> formatted: typed snapshot and bar tables with their KPIs.

Each function is one projection over the raw records (a single ``select``,
so Catalyst collapses it into the scan's codegen stage).  Sorting is left to
the writer (``sortWithinPartitions``), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.sources import schemas


def null_defaults_games(raw: DataFrame) -> DataFrame:
    """Missing-key defaults of raw game records: text -> '', counts -> 0."""
    text = ["app_id", "name", "developer", "publisher", "owners"]
    counts = ["positive", "negative", "average_forever", "average_2weeks", "peak_ccu"]
    return raw.select(*[
        F.coalesce(F.col(c), F.lit("")).alias(c) if c in text
        else F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) if c in counts
        else F.col(c)
        for c in raw.columns])


def format_steam(raw: DataFrame) -> DataFrame:
    """Snapshot (games): typed dates, defaults, review ratio, rank score."""
    zero = F.lit(0).cast("long")
    counts = {c: F.coalesce(F.col(c).cast("long"), zero)
              for c in ["positive", "negative", "peak_ccu", "average_2weeks", "average_forever"]}
    out = raw.select(
        F.col("rank").cast("int").alias("rank"), "app_id", "name", "developer", "publisher",
        counts["positive"].alias("positive"), counts["negative"].alias("negative"), "owners",
        counts["average_forever"].alias("average_forever"),
        counts["average_2weeks"].alias("average_2weeks"),
        counts["peak_ccu"].alias("peak_ccu"),
        F.coalesce(F.col("price").try_cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("ticker"), F.lit(kpi.UNKNOWN_TICKER)).alias("ticker"),
        kpi.parse_timestamp("extracted_at").alias("extracted_at"),
        kpi.parse_date("date", "yyyyMMdd").alias("date"),
        kpi.review_ratio(counts["positive"], counts["negative"]).alias("review_ratio"),
        kpi.rank_score(F.col("rank").cast("int")).cast("int").alias("rank_score"),
    )
    return out


def format_twitch(raw: DataFrame) -> DataFrame:
    """Snapshot (streams): typed dates, viewers default 0, rank score, log viewers."""
    viewers = F.coalesce(F.col("top_stream_viewers").cast("long"), F.lit(0).cast("long"))
    return raw.select(
        F.col("rank").cast("int").alias("rank"), "game_id", "game_name", "box_art_url",
        viewers.alias("top_stream_viewers"),
        kpi.parse_timestamp("extracted_at").alias("extracted_at"),
        kpi.parse_date("date", "yyyyMMdd").alias("date"),
        kpi.rank_score(F.col("rank").cast("int")).cast("int").alias("viewer_rank_score"),
        kpi.log_viewers(viewers).alias("log_viewers"),
    )


def format_bars(raw: DataFrame) -> DataFrame:
    """Daily bars: typed date, NaN and missing values -> 0, change / range KPIs, fixed column order."""
    o, h, lo, c = (F.coalesce(kpi.clean_numeric(F.col(x).cast("double")), F.lit(0.0)) for x in ("open", "high", "low", "close"))
    volume = F.col("volume")
    if raw.schema["volume"].dataType.typeName() in ("double", "float"):
        volume = kpi.clean_numeric(volume)
    rng = kpi.daily_range(h, lo)
    return raw.select(
        F.col("ticker"),
        kpi.parse_date("date", "yyyy-MM-dd").alias("date"),
        o.alias("open"), h.alias("high"), lo.alias("low"), c.alias("close"),
        F.coalesce(volume.cast("long"), F.lit(0).cast("long")).alias("volume"),
        kpi.daily_change_pct(o, c).cast("double").alias("daily_change_pct"),
        rng.alias("daily_range"),
        kpi.daily_range_pct(rng, o).cast("double").alias("daily_range_pct"),
    ).select(*schemas.BARS_COLUMNS)

