"""Source joins, union, popularity score, rolling correlations, signal labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.functions.rolling import rolling_pearson, rows_window
from popcorr.operators.expand import known_tickers
from popcorr.operators.joins import join_one_to_many
from popcorr.sources import schemas

# Window of the usage table: per (game, ticker), trading-day order; source and
# stream rank break ties when duplicate stream names fan a date out.
USAGE_PARTITION = ["game_name", "ticker"]
USAGE_ORDER = ["date", "source", "twitch_rank"]


def market_columns(bars: DataFrame) -> DataFrame:
    """Bars renamed to the usage table's market columns (zero-filled KPIs)."""
    return bars.select(
        "ticker", "date",
        F.col("open").alias("stock_open"), F.col("close").alias("stock_close"),
        F.col("high").alias("stock_high"), F.col("low").alias("stock_low"),
        F.col("volume").alias("stock_volume"),
        F.coalesce(F.col("daily_change_pct"), F.lit(0.0)).alias("daily_change_pct"),
        F.coalesce(F.col("daily_range_pct"), F.lit(0.0)).alias("daily_range_pct"))


def join_stream_left(snapshot: DataFrame, streams: DataFrame) -> DataFrame:
    """Snapshot LEFT JOIN streams on ``lower(name) = lower(game_name)`` (no trim, no date).

    Misses get viewers 0, rank 999, score 0; duplicate stream names fan out.
    Runs at snapshot grain, *before* the expansion over dates: the join
    condition only reads snapshot columns, so this equals joining after the
    expansion while touching games instead of games x dates rows.
    """
    s = streams.select(F.lower(F.col("game_name")).alias("_k"),
                       F.col("top_stream_viewers").alias("_v"),
                       F.col("rank").alias("_r"),
                       F.col("viewer_rank_score").alias("_sc"))
    out = snapshot.withColumn("_k", F.lower(F.col("name"))).join(s, "_k", "left")
    return (out.withColumn("twitch_viewers", F.coalesce(F.col("_v"), F.lit(kpi.NO_STREAM_VIEWERS)).cast("long"))
               .withColumn("twitch_rank", F.coalesce(F.col("_r"), F.lit(kpi.NO_STREAM_RANK)).cast("long"))
               .withColumn("twitch_rank_score",
                           F.coalesce(F.col("_sc").cast("double"), F.lit(kpi.NO_STREAM_SCORE)))
               .drop("_k", "_v", "_r", "_sc"))


def snapshot_branch(snapshot_with_streams: DataFrame, market: DataFrame,
                    jitter: bool = True, real_scores: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Expanded snapshot rows INNER JOIN bars on (ticker, date), as 'steam' rows.

    The expansion over the calendar and the (ticker, date) join with the
    bars collapse into one equi-join on ticker: every bar row is one
    calendar date (duplicates fan out the same way in both forms).
    With ``parts`` the rows come dealt by (game, ticker) to so many tasks: before
    the expansion (so games are shuffled, not games x dates), or after the join with
    ``real_scores``, which deals them by date too.
    """
    s = known_tickers(snapshot_with_streams).drop("date")
    if parts and real_scores is None:
        s = s.repartition(parts, "name", "ticker")
    rows = join_one_to_many(s, market, "ticker", salt_cols=["name", "ticker"])
    score = F.col("rank_score").cast("double")
    if jitter:
        z = kpi.gaussian(F.col("name"), F.col("ticker"), F.col("date"), "s")
        score = kpi.jitter_snapshot_score(score, z)
    if real_scores is not None:
        # multi-day history: a day with its own snapshot keeps its real score
        rows = rows.join(real_scores.select("name", "ticker", "date",
                                            F.col("rank_score").cast("double").alias("_real")),
                         ["name", "ticker", "date"], "left")
        if parts:
            rows = rows.repartition(parts, "name", "ticker")
        score = F.coalesce(F.col("_real"), score)
    return rows.select(
        "date", F.col("name").alias("game_name"), "ticker", F.lit("steam").alias("source"),
        F.col("rank").cast("long").alias("steam_rank"),
        score.alias("steam_rank_score"),
        F.col("peak_ccu").cast("long").alias("peak_ccu"),
        F.col("average_2weeks").cast("long").alias("avg_playtime_2weeks"),
        F.coalesce(F.col("review_ratio"), F.lit(0.0)).alias("review_ratio"),
        "twitch_viewers", "twitch_rank", "twitch_rank_score",
        "stock_open", "stock_close", "stock_high", "stock_low", "stock_volume",
        "daily_change_pct", "daily_range_pct")


def stream_only_branch(stream_only: DataFrame, market: DataFrame) -> DataFrame:
    """Expanded stream-only rows INNER JOIN bars on (ticker, date), as 'twitch' rows."""
    rows = stream_only.join(market, ["ticker", "date"], "inner")
    zero_l, zero_d = F.lit(0).cast("long"), F.lit(0.0)
    return rows.select(
        "date", "game_name", "ticker", F.lit("twitch").alias("source"),
        zero_l.alias("steam_rank"), zero_d.alias("steam_rank_score"),
        zero_l.alias("peak_ccu"), zero_l.alias("avg_playtime_2weeks"),
        zero_d.alias("review_ratio"),
        "twitch_viewers", "twitch_rank", "twitch_rank_score",
        "stock_open", "stock_close", "stock_high", "stock_low", "stock_volume",
        "daily_change_pct", "daily_range_pct")


def union_sources(*branches: DataFrame) -> DataFrame:
    """UNION ALL by name after casting each branch to the joined schema."""
    typed = [b.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.JOINED.fields])
             for b in branches]
    out = typed[0]
    for b in typed[1:]:
        out = out.unionByName(b)
    return out


def with_popularity(df: DataFrame) -> DataFrame:
    return df.withColumn("popularity_score", kpi.popularity_score())


def with_rolling_correlations(df: DataFrame, rows: int = 7) -> DataFrame:
    """Both 7-row correlations over one shared window (one exchange, one sort)."""
    w = rows_window(USAGE_PARTITION, USAGE_ORDER, rows)
    return (df.withColumn("corr_7d_popularity_price",
                          rolling_pearson("popularity_score", "daily_change_pct", w))
              .withColumn("corr_7d_viewers_price",
                          rolling_pearson("twitch_viewers", "daily_change_pct", w)))


def with_rolling_correlations_chunked(df: DataFrame, chunk_rows: int, rows: int = 7) -> DataFrame:
    """Same result as ``with_rolling_correlations``, for groups too large for one task.

    Each (game, ticker) group is numbered by its distributed position
    (``rank.rank_within``: range-partitioned, no group in one task) and cut
    into chunks of ``chunk_rows``; the last ``rows - 1`` rows of every chunk
    are copied into the next chunk as context.  The window then runs per
    (game, ticker, chunk): every frame of ``rows`` rows is complete, and the
    context copies are dropped from the output.
    """
    from popcorr.operators.rank import rank_within
    ctx_n = rows - 1
    pos = rank_within(df, USAGE_PARTITION, USAGE_ORDER, out="_pos")
    base = pos.withColumn("_chunk", F.floor(F.col("_pos") / chunk_rows)).withColumn("_ctx", F.lit(False))
    # the context of chunk c is the last ctx_n rows before it, which may span several
    # earlier chunks when chunk_rows < ctx_n: copy each row forward to every chunk
    # whose start lies within its next ctx_n positions
    first = F.floor((F.col("_pos") + 1) / chunk_rows)
    last = F.floor((F.col("_pos") + ctx_n) / chunk_rows)
    ctx = (pos.where(last >= first)
              .withColumn("_chunk", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
              .where(F.col("_chunk") * chunk_rows > F.col("_pos"))
              .withColumn("_ctx", F.lit(True)))
    w = rows_window(USAGE_PARTITION + ["_chunk"], USAGE_ORDER, rows)
    out = (base.unionByName(ctx)
               .withColumn("corr_7d_popularity_price", rolling_pearson("popularity_score", "daily_change_pct", w))
               .withColumn("corr_7d_viewers_price", rolling_pearson("twitch_viewers", "daily_change_pct", w)))
    return out.where(~F.col("_ctx")).drop("_pos", "_chunk", "_ctx")


def with_signal(df: DataFrame, corr_col: str = "corr_7d_popularity_price") -> DataFrame:
    return (df.withColumn("signal", kpi.signal_label(corr_col))
              .withColumn("source_is_twitch", (F.col("source") == "twitch").cast("int")))
