"""Shape the driver's TPC-H-like tables into the domain inputs.

bars         events grouped by (event_type, day): first/max/min/last value, count
raw_games    parts ranked by shipped quantity (publisher = brand, developer = type)
raw_streams  parts ranked by revenue, upper-cased names, some padded, some NULL viewers
quotes       events as live ticks, with the previous bar's close
stream_map   lower-case part names of a subset of parts -> ticker
publisher_map, tracked  fixed dimension rows

Every frame is derived lazily from the given tables, so its cost grows with
them; all parts are ranked by the distributed ranking (no window over a whole
table); only the top-N report takes the first n rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popcorr.operators.rank import rank_within, top_n
from popcorr.session import table_path
from popcorr.sources import schemas

# ── fixed values of the test model ───────────────────────────────────────────
RUN_DATE = "20240131"                      # snapshot day (yyyyMMdd); bars end the day before
RUN_EXTRACTED_AT = "2024-01-31T08:00:00.123456+00:00"
TOP_GAMES = 100
TOP_STREAMS = 300
#: In lists that come in pages: the page that is empty, and the one that loses its cursor.
PAGE_WITHOUT_RECORDS, PAGE_WITHOUT_CURSOR = 3, 2
BLANK_NAME_REST = 7                        # streams of parts with p_partkey % 50 = 7 have a blank name
RECENT_PLAY_SINCE = "2001-07-01 00:00:00"  # lower bound of the "last two weeks" play column
# Publisher/developer -> ticker map, in match order ("Brand#1" is a substring of Brand#10..19).
PUBLISHER_MAP_ROWS = [
    (0, "Brand#1", "click"),
    (1, "Brand#2", "view"),
    (2, "Brand#3", None),
    (3, "brand#15", "purchase"),
    (4, "Brand#5", "signup"),
    (5, "ECONOMY", "error"),
    (6, "PROMO EXTRA", "signup"),
    (7, "Brand#17", "error"),
    (8, "Brand#14", None),
]
# Stream name map: parts with p_partkey % 5 in (0, 1, 2) -> ticker by the remainder.
STREAM_MAP_TICKERS = {0: "click", 1: "view", 2: "signup"}
TRACKED_TICKERS = ["click", "view", "signup", "purchase", "error", "DELISTED"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _display_name(key_col: str = "p_partkey") -> F.Column:
    return F.concat(F.col("p_name"), F.lit(" #"), F.col(key_col).cast("string"))


def packed_order(*parts: F.Column) -> F.Column:
    """Longs (the first up to 10^18, the second not negative) as one decimal that orders like them."""
    high, low = parts
    return (high.cast("decimal(18,0)") * F.lit(Decimal(10) ** 19) + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def raw_bars(events: DataFrame) -> DataFrame:
    """One OHLCV bar per (event_type, day); date as raw ``yyyy-MM-dd`` text.

    open/close are the values of the first/last event by (ts, event_id).
    One scan and one hash aggregation with map-side combine: (ts, event_id)
    is packed into one decimal, a type that hash aggregation updates in
    place, so a task hands on one row per (ticker, day) and no event is
    shuffled, however skewed the types are.
    """
    ev = events.select(F.col("event_type").alias("ticker"), F.to_date("ts").alias("day"), "value",
                       packed_order(F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")).alias("at"))
    return (ev.groupBy("ticker", "day")
              .agg(F.min_by("value", "at").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
                   F.max_by("value", "at").alias("close"), F.count(F.lit(1)).alias("volume"))
              .select("ticker", F.date_format("day", "yyyy-MM-dd").alias("date"),
                      "open", "high", "low", "close", "volume"))


def part_stats(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per part, in one hash aggregation over the order lines: shipped quantity,
    kept/returned line counts, largest line, recent quantity, revenue in cents
    (exact integer ranking) - everything both top-N lists need."""
    is_r = F.col("l_returnflag") == "R"
    recent = F.col("l_shipdate") >= F.lit(RECENT_PLAY_SINCE).cast("timestamp_ntz")
    stats = (lineitem
             .groupBy("l_partkey")
             .agg(F.sum("l_quantity").alias("q"),
                  F.count(F.when(~is_r, 1)).alias("pos"),
                  F.count(F.when(is_r, 1)).alias("neg"),
                  F.max("l_quantity").alias("mx"),
                  F.sum(F.when(recent, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("q2"),
                  F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("r")))
    return stats.join(part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
                      F.col("l_partkey") == F.col("p_partkey"))


def ranked_by(stats: DataFrame, order: list, n: int | None) -> DataFrame:
    """``stats`` with its 1-based rank: the first ``n`` rows (a bounded top-n), or all by distributed ranking."""
    if n is not None:
        return top_n(stats, n, order)
    return rank_within(stats, [], order, out="rank").withColumn("rank", (F.col("rank") + 1).cast("int"))


def raw_games(stats: DataFrame, n: int | None = None, run_date: str = RUN_DATE) -> DataFrame:
    """Parts by shipped quantity as raw game records (ticker unresolved): all, or the first ``n``."""
    ranked = ranked_by(stats, [F.desc("q"), F.asc("p_partkey")], n)
    return ranked.select(
        "rank",
        F.col("p_partkey").cast("string").alias("app_id"),
        _display_name().alias("name"),
        F.col("p_type").alias("developer"),
        F.col("p_brand").alias("publisher"),
        F.col("pos").cast("long").alias("positive"),
        F.col("neg").cast("long").alias("negative"),
        F.lit("").alias("owners"),
        F.col("q").cast("long").alias("average_forever"),
        F.col("q2").cast("long").alias("average_2weeks"),
        F.col("mx").cast("long").alias("peak_ccu"),
        (F.col("p_size") * 100).cast("string").alias("price"),
        F.lit(None).cast("string").alias("ticker"),
        F.lit(RUN_EXTRACTED_AT).alias("extracted_at"),
        F.lit(run_date).alias("date"),
    )


def raw_streams(stats: DataFrame, n: int | None = None, run_date: str = RUN_DATE) -> DataFrame:
    """Parts by revenue (integer cents, exact rank) as raw stream records: all, or the first ``n``."""
    upper = F.upper(_display_name())
    name = (F.when(F.col("p_partkey") % 50 == BLANK_NAME_REST, F.lit("   "))
             .when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("  "), upper, F.lit(" "))).otherwise(upper))
    viewers = F.when(F.col("p_partkey") % 10 == 0, F.lit(None)).otherwise(F.col("q").cast("long"))
    return (ranked_by(stats, [F.desc("r"), F.asc("p_partkey")], n)
            .select("rank",
                    F.col("p_partkey").cast("string").alias("game_id"),
                    name.alias("game_name"),
                    F.lit("").alias("box_art_url"),
                    viewers.alias("top_stream_viewers"),
                    F.lit(RUN_EXTRACTED_AT).alias("extracted_at"),
                    F.lit(run_date).alias("date")))


def stream_map(part: DataFrame) -> DataFrame:
    rem = F.col("p_partkey") % 5
    ticker = F.lit(None).cast("string")
    for r, t in sorted(STREAM_MAP_TICKERS.items(), reverse=True):
        ticker = F.when(rem == r, F.lit(t)).otherwise(ticker)
    return (part.where(rem.isin(list(STREAM_MAP_TICKERS)))
            .select(F.lower(_display_name()).alias("name_lower"), ticker.alias("ticker")))


def publisher_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PUBLISHER_MAP_ROWS, schemas.PUBLISHER_MAP)


def tracked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TRACKED_TICKERS], schemas.TRACKED)


def quote_ticks(events: DataFrame) -> DataFrame:
    """Events as live ticks (no previous close yet): ticker, timestamp, price, seq."""
    return events.select(
        F.col("event_type").alias("ticker"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("current_price"),
        F.col("event_id").alias("seq"))
