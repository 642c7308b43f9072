"""One fixed StructType per layer table.

raw       JSON envelopes (metadata + array of records), read without inference
formatted typed snapshot / bar tables, Parquet partitioned by ``run_date``
usage     the joined, correlated, labelled and scored table
serving   the keyed document table (explicit field types)
live      the live quote series
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# ── raw layer ────────────────────────────────────────────────────────────────
RAW_GAME = _struct(
    ("rank", I), ("app_id", S), ("name", S), ("developer", S), ("publisher", S),
    ("positive", L), ("negative", L), ("owners", S), ("average_forever", L),
    ("average_2weeks", L), ("peak_ccu", L), ("price", S), ("ticker", S),
    ("extracted_at", S), ("date", S),
)
RAW_STREAM = _struct(
    ("rank", I), ("game_id", S), ("game_name", S), ("box_art_url", S),
    ("top_stream_viewers", L), ("extracted_at", S), ("date", S),
)
RAW_BAR = _struct(
    ("ticker", S), ("date", S), ("open", D), ("high", D), ("low", D), ("close", D),
    ("volume", L),
)

GAMES_ENVELOPE = _struct(("source", S), ("date", S), ("count", I),
                         ("games", ArrayType(RAW_GAME)))
STREAMS_ENVELOPE = _struct(("source", S), ("date", S), ("count", I),
                           ("games", ArrayType(RAW_STREAM)))
BARS_ENVELOPE = _struct(
    ("source", S), ("date", S), ("tickers", ArrayType(S)), ("failed_tickers", ArrayType(S)),
    ("count", I), ("records", ArrayType(RAW_BAR)), ("extracted_at", S),
)

# ── formatted layer ──────────────────────────────────────────────────────────
STEAM_FORMATTED = _struct(
    ("rank", I), ("app_id", S), ("name", S), ("developer", S), ("publisher", S),
    ("positive", L), ("negative", L), ("owners", S), ("average_forever", L),
    ("average_2weeks", L), ("peak_ccu", L), ("price", D), ("ticker", S),
    ("extracted_at", TimestampType()), ("date", DateType()), ("review_ratio", D),
    ("rank_score", I),
)
TWITCH_FORMATTED = _struct(
    ("rank", I), ("game_id", S), ("game_name", S), ("box_art_url", S),
    ("top_stream_viewers", L), ("extracted_at", TimestampType()), ("date", DateType()),
    ("viewer_rank_score", I), ("log_viewers", D),
)
# Output column order of the formatted bars is part of the contract.
BARS_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume",
                "daily_change_pct", "daily_range", "daily_range_pct"]
BARS_FORMATTED = _struct(
    ("ticker", S), ("date", DateType()), ("open", D), ("high", D), ("low", D),
    ("close", D), ("volume", L), ("daily_change_pct", D), ("daily_range", D),
    ("daily_range_pct", D),
)

# ── usage layer ──────────────────────────────────────────────────────────────
JOINED_COLUMNS = [
    "date", "game_name", "ticker", "source", "steam_rank", "steam_rank_score", "peak_ccu",
    "avg_playtime_2weeks", "review_ratio", "twitch_viewers", "twitch_rank",
    "twitch_rank_score", "stock_open", "stock_close", "stock_high", "stock_low",
    "stock_volume", "daily_change_pct", "daily_range_pct",
]
JOINED = _struct(
    ("date", DateType()), ("game_name", S), ("ticker", S), ("source", S),
    ("steam_rank", L), ("steam_rank_score", D), ("peak_ccu", L),
    ("avg_playtime_2weeks", L), ("review_ratio", D), ("twitch_viewers", L),
    ("twitch_rank", L), ("twitch_rank_score", D), ("stock_open", D), ("stock_close", D),
    ("stock_high", D), ("stock_low", D), ("stock_volume", L), ("daily_change_pct", D),
    ("daily_range_pct", D),
)
ML_COLUMNS = ["ml_prediction", "ml_confidence", "ml_accuracy", "ml_f1_weighted",
              "ml_f1_macro", "ml_precision", "ml_recall"]
USAGE = StructType(
    [f for f in JOINED.fields if f.name != "date"]
    + [StructField("date", S, True)]
    + _struct(
        ("popularity_score", D), ("corr_7d_popularity_price", D),
        ("corr_7d_viewers_price", D), ("signal", S), ("source_is_twitch", I),
        ("ml_prediction", S), ("ml_confidence", D), ("ml_accuracy", D),
        ("ml_f1_weighted", D), ("ml_f1_macro", D), ("ml_precision", D), ("ml_recall", D),
    ).fields
)

# ── serving layer (explicit mapping: keyword/integer/long/float/date) ────────
F32 = D  # float fields of the mapping are stored as double here
SERVING = _struct(
    ("doc_id", S), ("date", DateType()), ("game_name", S), ("ticker", S),
    ("steam_rank", I), ("steam_rank_score", F32), ("peak_ccu", L),
    ("avg_playtime_2weeks", L), ("review_ratio", F32), ("twitch_viewers", L),
    ("twitch_rank", I), ("twitch_rank_score", F32), ("stock_open", F32),
    ("stock_close", F32), ("stock_high", F32), ("stock_low", F32), ("stock_volume", L),
    ("daily_change_pct", F32), ("daily_range_pct", F32), ("popularity_score", F32),
    ("corr_7d_popularity_price", F32), ("corr_7d_viewers_price", F32), ("signal", S),
    ("ml_prediction", S), ("ml_confidence", F32), ("ml_accuracy", F32),
    ("ml_f1_weighted", F32), ("ml_f1_macro", F32), ("ml_precision", F32),
    ("ml_recall", F32), ("indexed_at", TimestampType()),
)

# ── live quotes ──────────────────────────────────────────────────────────────
QUOTE = _struct(
    ("ticker", S), ("timestamp", TimestampType()), ("current_price", D),
    ("previous_close", D), ("change_pct", D), ("market_cap", L),
    ("fifty_two_week_high", D), ("fifty_two_week_low", D), ("currency", S),
    ("exchange", S), ("fetched_at", TimestampType()),
)

# ── dimensions ───────────────────────────────────────────────────────────────
PUBLISHER_MAP = _struct(("ordinal", I), ("k", S), ("ticker", S))
STREAM_MAP = _struct(("name_lower", S), ("ticker", S))
TRACKED = _struct(("ticker", S))
