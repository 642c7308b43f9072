"""Scalar column expressions.  All built-in Spark functions: they stay inside
whole-stage codegen and need no Python worker.

Guarded KPIs return NULL where the reference's guard fails (``open <= 0``,
no reviews); callers zero-fill later where the pipeline does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ── fixed values that results depend on ──────────────────────────────────────
# Signal ladder (lower bounds, inclusive), checked top to bottom; below the
# last bound the label is STRONG_NEGATIVE; NULL/NaN correlation is NEUTRAL.
SIGNAL_LADDER = [
    ("STRONG_POSITIVE", 0.5),
    ("WEAK_POSITIVE", 0.2),
    ("NEUTRAL", -0.2),
    ("WEAK_NEGATIVE", -0.5),
]
SIGNAL_BELOW_LADDER = "STRONG_NEGATIVE"
SIGNAL_UNDEFINED = "NEUTRAL"
SIGNAL_CLASSES = sorted([name for name, _ in SIGNAL_LADDER] + [SIGNAL_BELOW_LADDER])
# Rank score: rank 1 -> 100, rank 100 -> 1 (and <= 0 past rank 100).
RANK_SCORE_BASE = 101
# Popularity weights of a snapshot row (steam score, stream score).
POPULARITY_WEIGHTS = (0.6, 0.4)
# Defaults of a snapshot game that has no stream.
NO_STREAM_VIEWERS, NO_STREAM_RANK, NO_STREAM_SCORE = 0, 999, 0.0
UNKNOWN_TICKER = "UNKNOWN"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def daily_change_pct(open_="open", close="close") -> Column:
    o, c = _c(open_), _c(close)
    return F.when(o > 0, F.round((c - o) / o * 100, 4))


def daily_range(high="high", low="low") -> Column:
    return F.round(_c(high) - _c(low), 4)


def daily_range_pct(rng="daily_range", open_="open") -> Column:
    """Uses the already rounded range, as the formatted table does."""
    o = _c(open_)
    return F.when(o > 0, F.round(_c(rng) / o * 100, 4))


def review_ratio(pos="positive", neg="negative") -> Column:
    p, n = _c(pos), _c(neg)
    return F.when((p + n) > 0, p / (p + n))


def rank_score(rank="rank") -> Column:
    return F.lit(RANK_SCORE_BASE) - _c(rank)


def log_viewers(viewers="top_stream_viewers") -> Column:
    v = _c(viewers)
    return F.when(v > 0, F.ln(v)).otherwise(F.lit(0.0))


def popularity_score(source="source", steam_score="steam_rank_score",
                     stream_score="twitch_rank_score") -> Column:
    ws, wt = POPULARITY_WEIGHTS
    t = _c(stream_score).cast("double")
    return (F.when(_c(source) == "twitch", F.round(t, 4))
            .otherwise(F.round(_c(steam_score).cast("double") * F.lit(ws) + t * F.lit(wt), 4)))


def signal_label(r="corr_7d_popularity_price") -> Column:
    r = _c(r)
    expr = F.when(r.isNull() | F.isnan(r), F.lit(SIGNAL_UNDEFINED))
    for name, bound in SIGNAL_LADDER:
        expr = expr.when(r >= bound, F.lit(name))
    return expr.otherwise(F.lit(SIGNAL_BELOW_LADDER))


def clean_numeric(x) -> Column:
    """NaN and +/-Inf become NULL; everything else passes through."""
    c = _c(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def parse_date(x, fmt: str) -> Column:
    """Unparseable text gives NULL (ANSI-safe)."""
    return F.try_to_date(_c(x), fmt)


def parse_timestamp(x) -> Column:
    """ISO-8601 text with optional fraction and offset -> UTC instant; bad text -> NULL."""
    return F.try_to_timestamp(_c(x))


def change_pct(price="current_price", prev="previous_close") -> Column:
    """Live change vs previous close; NULL when either side is NULL or 0."""
    p, q = _c(price), _c(prev)
    return F.when((p != 0) & (q != 0), F.round((p - q) / q * 100, 4))


def doc_id(ticker="ticker", date="date", game="game_name") -> Column:
    """``ticker_YYYYMMDD_game``: blanks -> '_' first, then the game is cut to 30 chars."""
    t = F.regexp_replace(F.coalesce(_c(ticker), F.lit(UNKNOWN_TICKER)), " ", "_")
    d = F.regexp_replace(F.coalesce(_c(date).cast("string"), F.lit("")), "-", "")
    g = F.substring(F.regexp_replace(F.coalesce(_c(game), F.lit("")), " ", "_"), 1, 30)
    return F.concat_ws("_", t, d, g)


# ── deterministic Gaussian jitter ────────────────────────────────────────────
# A row's noise is a pure function of its key, so it is identical for any
# partitioning, any retry and any engine that implements md5.
JITTER_SEED = 42
_TWO_POW_52 = 4503599627370496.0
_TWO_PI = 6.283185307179586


def _uniform(key: Column) -> Column:
    """(first 13 hex digits of md5(key) as an integer + 0.5) / 2^52, in (0, 1)."""
    hex13 = F.substring(F.md5(key), 1, 13)
    return (F.conv(hex13, 16, 10).cast("double") + F.lit(0.5)) / F.lit(_TWO_POW_52)


def gaussian(name: Column, ticker: Column, date: Column, salt: str) -> Column:
    """Standard normal draw from ``lower(name)|ticker|yyyy-MM-dd|<seed><salt>`` (Box-Muller)."""
    base = F.concat_ws("|", F.lower(name), ticker, F.date_format(date, "yyyy-MM-dd"),
                       F.lit(f"{JITTER_SEED}{salt}"))
    u1 = _uniform(F.concat(base, F.lit("a")))
    u2 = _uniform(F.concat(base, F.lit("b")))
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(_TWO_PI) * u2)


def jitter_snapshot_score(score: Column, z: Column) -> Column:
    s = score.cast("double")
    return F.greatest(F.lit(1.0), F.round(s + z * (s * F.lit(0.05)), 2))


def jitter_stream_score(score: Column, z: Column) -> Column:
    s = score.cast("double")
    return F.greatest(F.lit(1.0), F.round(s + z * F.greatest(s * F.lit(0.05), F.lit(1.0)), 2))


def jitter_viewers(viewers: Column, z: Column) -> Column:
    v = viewers.cast("double")
    noisy = v + z * F.greatest(v * F.lit(0.08), F.lit(1.0))
    # cast to long truncates toward zero, like int() in the reference
    return F.greatest(F.lit(0).cast("long"), noisy.cast("long"))
