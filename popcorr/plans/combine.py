"""formatted -> usage: the combine composition.

    bars ─ drop bad dates ─ zero-fill ─ market columns ───────────────┐
    games ─ zero-fill ─ LEFT JOIN streams (name) ─ expand ⋈ bars ──────┼─ UNION ALL
    streams ─ not covered ─ name map ─ expand ⋈ bars ──────────────────┘
      ─ popularity ─ two 7-row Pearson r (one window) ─ signal ─ [model] ─ clean

One lazy lineage; the only actions before the final write are bounded
probes (broadcast size checks, the "nothing expanded" test).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.operators import correlate, expand
from popcorr.sources import schemas


def prep_bars(bars: DataFrame) -> DataFrame:
    """Drop rows whose date is missing/unparseable; KPI NULLs become 0."""
    return (bars.where(F.col("date").isNotNull())
                .fillna(0, subset=["open", "high", "low", "close", "volume",
                                   "daily_change_pct", "daily_range", "daily_range_pct"]))


def prep_snapshot(games: DataFrame) -> DataFrame:
    """Zero-fill every numeric column of the games snapshot."""
    num = [f.name for f in games.schema.fields
           if f.dataType.typeName() in ("integer", "long", "double", "float", "short")]
    return games.fillna(0, subset=num) if num else games


def empty_streams(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.TWITCH_FORMATTED)


def branches(games: DataFrame, bars: DataFrame, streams: DataFrame | None,
             stream_map: DataFrame, jitter: bool = True, real_scores: DataFrame | None = None,
             parts: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """The snapshot rows and the stream-only rows of the joined relation.

    No (game, ticker) group has rows of both: a stream-only game's folded name is
    that of no expanded snapshot game.  With ``parts`` the rows of each come dealt
    by (game, ticker) to so many tasks.
    """
    spark = games.sparkSession
    streams = streams if streams is not None else empty_streams(spark)
    streams = streams.fillna(0, subset=["top_stream_viewers", "viewer_rank_score"])
    bars_p = prep_bars(bars)
    market = correlate.market_columns(bars_p)
    cal = expand.ticker_calendar(bars_p)
    games_p = prep_snapshot(games)

    steam_rows = correlate.snapshot_branch(
        correlate.join_stream_left(games_p, streams), market, jitter=jitter,
        real_scores=real_scores, parts=parts and parts[0])

    blocking = expand.covered_names(games_p, cal)
    cands = expand.stream_only_candidates(streams, blocking)
    mapped = expand.stream_ticker_lookup(cands, stream_map)
    if parts:
        mapped = mapped.repartition(parts[1], F.trim("game_name"), "ticker")
    stream_rows = correlate.stream_only_branch(
        expand.expand_stream_only(mapped, cal, jitter=jitter), market)
    return steam_rows, stream_rows


def joined(games: DataFrame, bars: DataFrame, streams: DataFrame | None,
           stream_map: DataFrame, jitter: bool = True,
           real_scores: DataFrame | None = None) -> DataFrame:
    """The 19-column joined relation (both branches, UNION ALL)."""
    return correlate.union_sources(*branches(games, bars, streams, stream_map, jitter, real_scores))


#: Rows of a (game, ticker) group that one window task may hold; beyond, groups are cut into chunks.
CHUNK_ROWS = 200_000
#: Rows of a window task about, and the fewest that make a task worth while.
TASK_ROWS, LEAST_ROWS = 200_000, 20_000


@dataclass
class Bounds:
    """Upper bounds on the rows of any (game, ticker) group, of the snapshot branch and of the stream-only branch."""

    group: int
    snapshot: int
    stream_only: int


def bounds(games: DataFrame, bars: DataFrame, streams: DataFrame | None) -> Bounds:
    """Bounds on the joined relation's rows.

    Of a group: dates of one ticker (the most) times equal games of one name and
    ticker times the streams of that name; for stream-only rows, dates times streams
    of one name that is not blank (blank ones are no candidates).  Of a branch: the
    same, of all games with their own ticker's dates and of all such streams.  All from
    aggregates over the snapshots, so the joined relation itself is not computed for it.
    """
    def key(c: str) -> F.Column:
        return F.lower(F.trim(F.col(c)))

    def most_and_all(df: DataFrame, most: str, every: str) -> tuple[int, int]:
        m, n = df.agg(F.max(most), F.sum(every)).first()
        return m or 0, n or 0

    count = F.count(F.lit(1))
    per_ticker = bars.groupBy("ticker").agg(count.alias("d"))
    dates, _ = most_and_all(per_ticker, "d", "d")
    rows = games.groupBy("name", "ticker").agg(count.alias("n")).withColumn("_k", key("name"))
    if streams is not None:
        by_name = streams.groupBy(key("game_name").alias("_k")).agg(count.alias("s"))
        rows = rows.join(by_name, "_k", "left").withColumn("n", F.col("n") * F.coalesce("s", F.lit(1)))
    rows = rows.join(per_ticker, "ticker", "left").withColumn("all", F.col("n") * F.coalesce("d", F.lit(0)))
    same, snapshot = most_and_all(rows, "n", "all")
    if streams is None:
        return Bounds(dates * same, snapshot, 0)
    alike, every = most_and_all(by_name.where(F.col("_k") != ""), "s", "s")
    return Bounds(dates * (same + alike), snapshot, dates * every)


def largest_group(games: DataFrame, bars: DataFrame, streams: DataFrame | None) -> int:
    """An upper bound on the rows of any (game, ticker) group of the joined relation."""
    return bounds(games, bars, streams).group


def window_tasks(rows: int, cores: int) -> int:
    """Tasks for a window over ``rows`` rows: their rows do not grow with the input, and no core idles for want of tasks."""
    return max(1, -(-rows // TASK_ROWS), min(cores, -(-rows // LEAST_ROWS)))


def correlated(joined_df: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Popularity score, both rolling correlations, signal label.

    With ``chunk_rows`` the correlations take the chunked form (equal results),
    for data in which a (game, ticker) group may be too large for one task.
    """
    scored = joined_df.transform(correlate.with_popularity)
    if chunk_rows:
        corr = correlate.with_rolling_correlations_chunked(scored, chunk_rows)
    else:
        corr = correlate.with_rolling_correlations(scored)
    return corr.transform(correlate.with_signal)


def usage_rows(games: DataFrame, bars: DataFrame, streams: DataFrame | None, stream_map: DataFrame,
               jitter: bool, chunk_rows: int | None, real_scores: DataFrame | None = None) -> DataFrame:
    """The correlated rows of both branches.

    Where groups fit a task, each branch's games are dealt by (game, ticker) to as
    many tasks as its rows need and expanded there; the window needs no other shuffle.
    (Shuffled rows of a game are so alike that they compress to a few bytes, and tasks
    cut by shuffled bytes had more rows to sort the larger the input.)
    """
    size = bounds(games, bars, streams)
    if chunk_rows is None and size.group > CHUNK_ROWS:
        chunk_rows = CHUNK_ROWS
    if chunk_rows:
        return correlated(joined(games, bars, streams, stream_map, jitter, real_scores), chunk_rows)
    cores = games.sparkSession.sparkContext.defaultParallelism
    parts = window_tasks(size.snapshot, cores), window_tasks(size.stream_only, cores)
    both = branches(games, bars, streams, stream_map, jitter, real_scores, parts)
    steam, stream_only = (correlated(correlate.union_sources(b)) for b in both)
    return steam.unionByName(stream_only)


def combine(games: DataFrame, bars: DataFrame, streams: DataFrame | None,
            stream_map: DataFrame, jitter: bool = True, chunk_rows: int | None = None) -> DataFrame:
    """Usage table without the model columns (date kept as DateType).

    Unless the caller gives ``chunk_rows``, a bound on the largest group
    decides whether the rolling windows run in chunks.
    """
    return usage_rows(games, bars, streams, stream_map, jitter, chunk_rows)


def combine_history(games_history: DataFrame, bars: DataFrame, streams: DataFrame | None,
                    stream_map: DataFrame, run_date: str, jitter: bool = True) -> DataFrame:
    """Multi-day mode over an accumulated snapshot layer (many ``run_date`` partitions).

    The run's own snapshot is expanded over the price history as usual; on
    every date for which the layer holds a snapshot of that game (same name
    and ticker, snapshot ``date``) the real rank score replaces the jittered
    one, so popularity varies for real as the history accumulates.
    """
    run = games_history.where(F.col("run_date") == run_date).drop("run_date")
    history = (games_history.where(F.col("date").isNotNull())
               .select("name", F.coalesce(F.col("ticker"), F.lit(kpi.UNKNOWN_TICKER)).alias("ticker"),
                       "date", "rank_score"))
    return usage_rows(run, bars, streams, stream_map, jitter, None, history)


def to_usage(df: DataFrame) -> DataFrame:
    """Final usage shape: ``date`` as yyyy-MM-dd text, NaN/Inf -> NULL, fixed columns."""
    cols = []
    for f in schemas.USAGE.fields:
        if f.name == "date":
            cols.append(F.date_format("date", "yyyy-MM-dd").alias("date"))
        elif f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.typeName() == "double":
            cols.append(kpi.clean_numeric(F.col(f.name).cast("double")).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)
