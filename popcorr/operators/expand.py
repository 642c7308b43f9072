"""Snapshot-to-history expansion and the stream-only path.

A one-day snapshot row is repeated on every trading day of its ticker (the
snapshot date is replaced by the bar date); rows whose ticker has no bars
vanish.  The stream-only path keeps stream entities whose case-folded,
trimmed name is not already covered by an expanded snapshot row, maps them
to a ticker through the stream name map, and expands them the same way.

Expansion is an equi-join on ``ticker`` against the (ticker, date) calendar:
a broadcast hash join when the calendar is under the broadcast threshold (the
usual case: tickers x trading days), else a sort-merge join in which AQE
splits a hot ticker's partition (or an explicitly salted join), so a ticker
that owns a third of all games never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.operators.joins import join_one_to_many


def ticker_calendar(bars: DataFrame) -> DataFrame:
    """Distinct (ticker, date) pairs of the bars."""
    return bars.select("ticker", "date").distinct()


def expand_snapshot(snapshot: DataFrame, calendar: DataFrame, jitter: bool = False,
                    name_col: str = "name", score_col: str = "rank_score") -> DataFrame:
    """Each snapshot row x every calendar date of its ticker.

    With ``jitter`` the score becomes the deterministic noisy score
    ``greatest(1, round(score + z * 0.05 * score, 2))`` keyed by
    (name, ticker, date).
    """
    base = snapshot.drop("date")
    out = join_one_to_many(base, calendar, "ticker", salt_cols=[name_col, "ticker"])
    if jitter:
        z = kpi.gaussian(F.col(name_col), F.col("ticker"), F.col("date"), "s")
        out = out.withColumn(score_col, kpi.jitter_snapshot_score(F.col(score_col), z))
    return out


def covered_names(snapshot: DataFrame, calendar: DataFrame, name_col: str = "name") -> DataFrame:
    """Case-folded names that block the stream-only path.

    "Covered" is decided after expansion: only names whose ticker has at least
    one date.  If no snapshot row expands at all, the unexpanded frame is
    kept, so every snapshot name blocks.  That data-dependent branch is an
    uncorrelated ``NOT EXISTS`` subquery (one row, ``CollectLimit 1``) inside
    the same lazy plan - no driver-side probe.
    """
    tickers = calendar.select("ticker").distinct()
    expanded = snapshot.join(tickers, "ticker", "left_semi")
    flagged = snapshot.join(tickers.withColumn("_has_dates", F.lit(True)), "ticker", "left")
    keep = F.col("_has_dates").isNotNull() | ~expanded.exists()
    return flagged.where(keep).select(F.lower(F.col(name_col)).alias("name_key")).distinct()


def stream_only_candidates(streams: DataFrame, blocking: DataFrame,
                           name_col: str = "game_name") -> DataFrame:
    """Stream rows with a non-blank trimmed name that no expanded snapshot covers."""
    trimmed = F.trim(F.col(name_col))
    return (streams
            .where(F.col(name_col).isNotNull() & (trimmed != ""))
            .withColumn("name_key", F.lower(trimmed))
            .join(blocking, "name_key", "left_anti"))


def stream_ticker_lookup(candidates: DataFrame, stream_map: DataFrame) -> DataFrame:
    """Exact lookup on the case-folded trimmed name; misses are dropped."""
    m = stream_map.select(F.col("name_lower").alias("name_key"), "ticker")
    return candidates.drop("ticker").join(m, "name_key", "inner")


def expand_stream_only(mapped: DataFrame, calendar: DataFrame, jitter: bool = True,
                       name_col: str = "game_name") -> DataFrame:
    """Stream-only entities over their ticker's dates.

    Output: game_name (trimmed), ticker, date, twitch_viewers, twitch_rank,
    twitch_rank_score.  Jitter keys use the name as delivered (untrimmed).
    """
    rows = join_one_to_many(mapped.drop("date"), calendar, "ticker",
                            salt_cols=[name_col, "ticker"])
    viewers = F.coalesce(F.col("top_stream_viewers"), F.lit(0)).cast("long")
    score = F.coalesce(F.col("viewer_rank_score"), F.lit(0)).cast("double")
    if jitter:
        raw = F.col(name_col)
        viewers = kpi.jitter_viewers(viewers, kpi.gaussian(raw, F.col("ticker"), F.col("date"), "v"))
        score = kpi.jitter_stream_score(score, kpi.gaussian(raw, F.col("ticker"), F.col("date"), "r"))
    return rows.select(
        F.trim(F.col(name_col)).alias("game_name"), "ticker", "date",
        viewers.alias("twitch_viewers"),
        F.col("rank").cast("long").alias("twitch_rank"),
        score.alias("twitch_rank_score"))


def unresolved_tickers(calendar: DataFrame, **dimensions: DataFrame) -> DataFrame:
    """Tickers a dimension maps to that have no bars (their games would vanish
    silently from the expansion): one row per (dimension, ticker)."""
    have = calendar.select("ticker").distinct()
    out = None
    for name, dim in dimensions.items():
        t = (dim.where(F.col("ticker").isNotNull())
                .select(F.lit(name).alias("dimension"), "ticker").distinct())
        out = t if out is None else out.unionByName(t)
    return out.join(have, "ticker", "left_anti").select("dimension", "ticker")


def failed_tickers(tracked: DataFrame, bars: DataFrame) -> DataFrame:
    """Tracked tickers for which no bar was fetched."""
    return tracked.join(bars.select("ticker").distinct(), "ticker", "left_anti")


def known_tickers(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows whose ticker was resolved."""
    return snapshot.where(F.col("ticker") != kpi.UNKNOWN_TICKER)
