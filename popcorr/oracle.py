"""Engine-neutral oracle SQL (DuckDB dialect) for the registered queries.

The SQL is written independently of the Spark code path: plain CTEs over the
driver tables, re-deriving every input.  Fixed dimension rows come from the
same constants the Spark side uses.  Output conventions shared with
``popcorr.catalog.present``: dates as ``yyyy-MM-dd`` text, timestamps as
``yyyy-MM-dd HH:mm:ss.ffffff`` text.
"""

from __future__ import annotations

from popcorr.functions import kpi
from popcorr.sources import testbed as tb


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


PMAP_VALUES = ", ".join(f"({o}, {_lit(k)}, {_lit(t)})" for o, k, t in tb.PUBLISHER_MAP_ROWS)
SMAP_CASE = " ".join(f"WHEN p_partkey % 5 = {r} THEN {_lit(t)}" for r, t in sorted(tb.STREAM_MAP_TICKERS.items()))
SMAP_KEYS = ", ".join(str(r) for r in sorted(tb.STREAM_MAP_TICKERS))
TRACKED_VALUES = ", ".join(f"({_lit(t)})" for t in tb.TRACKED_TICKERS)


def d(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def signal_sql(c: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL OR isnan({c}) THEN '{kpi.SIGNAL_UNDEFINED}'"]
    for name, bound in kpi.SIGNAL_LADDER:
        parts.append(f"WHEN {c} >= {bound} THEN '{name}'")
    parts.append(f"ELSE '{kpi.SIGNAL_BELOW_LADDER}' END")
    return " ".join(parts)


def corr_sql(x: str, y: str, w: str = "w") -> str:
    return (f"round(CASE WHEN min({x}) OVER {w} < max({x}) OVER {w} AND min({y}) OVER {w} < max({y}) OVER {w} "
            f"THEN covar_pop({x}, {y}) OVER {w} / nullif(stddev_pop({x}) OVER {w} * stddev_pop({y}) OVER {w}, 0) END, 6)")


def _u(key: str) -> str:
    return f"((CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)"


def z_sql(name: str, ticker: str, date: str, salt: str) -> str:
    base = f"(lower({name}) || '|' || {ticker} || '|' || strftime({date}, '%Y-%m-%d') || '|{kpi.JITTER_SEED}{salt}')"
    return f"(sqrt(-2.0 * ln({_u(base + ' || ' + _lit('a'))})) * cos(6.283185307179586 * {_u(base + ' || ' + _lit('b'))}))"


def j_snapshot(score: str, z: str) -> str:
    s = f"CAST({score} AS DOUBLE)"
    return f"greatest(1.0, round({s} + {z} * ({s} * 0.05::DOUBLE), 2))"


def j_stream(score: str, z: str) -> str:
    s = f"CAST({score} AS DOUBLE)"
    return f"greatest(1.0, round({s} + {z} * greatest({s} * 0.05::DOUBLE, 1.0), 2))"


def j_viewers(v: str, z: str) -> str:
    s = f"CAST({v} AS DOUBLE)"
    return f"greatest(0, CAST(trunc({s} + {z} * greatest({s} * 0.08::DOUBLE, 1.0)) AS BIGINT))"


# ── shared CTEs ──────────────────────────────────────────────────────────────
BARS_RAW = """
bars_raw AS (
  SELECT event_type AS ticker, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*) AS volume
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""

BARS = BARS_RAW + """,
bars0 AS (
  SELECT ticker, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date,
         coalesce(open, 0.0) AS open, coalesce(high, 0.0) AS high, coalesce(low, 0.0) AS low,
         coalesce(close, 0.0) AS close, CAST(coalesce(volume, 0) AS BIGINT) AS volume
  FROM bars_raw),
bars AS (
  SELECT ticker, date, open, high, low, close, volume,
         CASE WHEN open > 0 THEN round((close - open) / open * 100, 4) END AS daily_change_pct,
         round(high - low, 4) AS daily_range,
         CASE WHEN open > 0 THEN round(round(high - low, 4) / open * 100, 4) END AS daily_range_pct
  FROM bars0)"""

RAW_GAMES = f"""
ga AS (
  SELECT l_partkey, sum(l_quantity) AS q,
         count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS pos,
         count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS neg,
         max(l_quantity) AS mx,
         sum(CASE WHEN l_shipdate >= TIMESTAMP '{tb.RECENT_PLAY_SINCE}' THEN l_quantity ELSE 0 END) AS q2
  FROM lineitem GROUP BY l_partkey),
raw_games0 AS (
  SELECT CAST(row_number() OVER (ORDER BY q DESC, p_partkey) AS INTEGER) AS rank,
         CAST(p_partkey AS VARCHAR) AS app_id,
         concat(p_name, ' #', CAST(p_partkey AS VARCHAR)) AS name,
         p_type AS developer, p_brand AS publisher,
         CAST(pos AS BIGINT) AS positive, CAST(neg AS BIGINT) AS negative, '' AS owners,
         CAST(q AS BIGINT) AS average_forever, CAST(q2 AS BIGINT) AS average_2weeks,
         CAST(mx AS BIGINT) AS peak_ccu, CAST(p_size * 100 AS VARCHAR) AS price,
         '{tb.RUN_EXTRACTED_AT}' AS extracted_at, '{tb.RUN_DATE}' AS date
  FROM ga JOIN part ON p_partkey = l_partkey),
pmap AS (SELECT * FROM (VALUES {PMAP_VALUES}) AS t(ordinal, k, ticker)),
names AS (
  SELECT publisher AS nm FROM raw_games0 WHERE publisher IS NOT NULL AND publisher <> ''
  UNION
  SELECT developer AS nm FROM raw_games0 WHERE developer IS NOT NULL AND developer <> ''),
hits AS (
  SELECT nm, ordinal, m.ticker,
         CASE WHEN nm = k AND m.ticker IS NOT NULL THEN 0 ELSE 1 END AS p
  FROM names JOIN pmap m
    ON (nm = k AND m.ticker IS NOT NULL) OR contains(lower(nm), lower(k)) OR contains(lower(k), lower(nm))),
res AS (
  SELECT nm, ticker FROM (
    SELECT nm, ticker, row_number() OVER (PARTITION BY nm ORDER BY p, ordinal) AS rn FROM hits) WHERE rn = 1),
raw_games AS (
  SELECT g.rank, g.app_id, g.name, g.developer, g.publisher, g.positive, g.negative, g.owners,
         g.average_forever, g.average_2weeks, g.peak_ccu, g.price,
         CASE WHEN rp.nm IS NOT NULL THEN rp.ticker WHEN rd.nm IS NOT NULL THEN rd.ticker END AS ticker,
         g.extracted_at, g.date
  FROM raw_games0 g LEFT JOIN res rp ON g.publisher = rp.nm LEFT JOIN res rd ON g.developer = rd.nm)"""

GAMES = RAW_GAMES + f""",
games AS (
  SELECT rank, app_id, name, developer, publisher,
         coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative, owners,
         coalesce(average_forever, 0) AS average_forever, coalesce(average_2weeks, 0) AS average_2weeks,
         coalesce(peak_ccu, 0) AS peak_ccu, coalesce(TRY_CAST(price AS DOUBLE), 0.0) AS price,
         coalesce(ticker, '{kpi.UNKNOWN_TICKER}') AS ticker,
         timezone('UTC', try_strptime(extracted_at, '%Y-%m-%dT%H:%M:%S.%f%z')) AS extracted_at,
         CAST(try_strptime(date, '%Y%m%d') AS DATE) AS date,
         CASE WHEN coalesce(positive, 0) + coalesce(negative, 0) > 0
              THEN CAST(coalesce(positive, 0) AS DOUBLE) / (coalesce(positive, 0) + coalesce(negative, 0)) END AS review_ratio,
         CAST({kpi.RANK_SCORE_BASE} - rank AS INTEGER) AS rank_score
  FROM raw_games)"""

RAW_STREAMS = f"""
sa AS (
  SELECT l_partkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS r, sum(l_quantity) AS q
  FROM lineitem GROUP BY l_partkey),
raw_streams AS (
  SELECT CAST(row_number() OVER (ORDER BY r DESC, p_partkey) AS INTEGER) AS rank,
         CAST(p_partkey AS VARCHAR) AS game_id,
         CASE WHEN p_partkey % 50 = {tb.BLANK_NAME_REST} THEN '   '
              WHEN p_partkey % 4 = 0 THEN concat('  ', upper(concat(p_name, ' #', CAST(p_partkey AS VARCHAR))), ' ')
              ELSE upper(concat(p_name, ' #', CAST(p_partkey AS VARCHAR))) END AS game_name,
         '' AS box_art_url,
         CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(q AS BIGINT) END AS top_stream_viewers,
         '{tb.RUN_EXTRACTED_AT}' AS extracted_at, '{tb.RUN_DATE}' AS date
  FROM sa JOIN part ON p_partkey = l_partkey)"""

STREAMS = RAW_STREAMS + f""",
streams AS (
  SELECT rank, game_id, game_name, box_art_url,
         coalesce(top_stream_viewers, 0) AS top_stream_viewers,
         timezone('UTC', try_strptime(extracted_at, '%Y-%m-%dT%H:%M:%S.%f%z')) AS extracted_at,
         CAST(try_strptime(date, '%Y%m%d') AS DATE) AS date,
         CAST({kpi.RANK_SCORE_BASE} - rank AS INTEGER) AS viewer_rank_score,
         CASE WHEN coalesce(top_stream_viewers, 0) > 0 THEN ln(coalesce(top_stream_viewers, 0)) ELSE CAST(0.0 AS DOUBLE) END AS log_viewers
  FROM raw_streams)"""

SMAP = f"""
smap AS (
  SELECT lower(concat(p_name, ' #', CAST(p_partkey AS VARCHAR))) AS name_lower,
         CASE {SMAP_CASE} END AS ticker
  FROM part WHERE p_partkey % 5 IN ({SMAP_KEYS}))"""

TRACKED = f"""
tracked AS (SELECT * FROM (VALUES {TRACKED_VALUES}) AS t(ticker))"""


def combine_ctes(jitter: bool = True, streams_present: bool = True, real_day: str | None = None) -> str:
    zs = z_sql("sb.name", "sb.ticker", "k.date", "s")
    zr = z_sql("so.raw_name", "so.ticker", "k.date", "r")
    zv = z_sql("so.raw_name", "so.ticker", "k.date", "v")
    steam_score = j_snapshot("sb.rank_score", zs) if jitter else "CAST(sb.rank_score AS DOUBLE)"
    if real_day:
        steam_score = f"CASE WHEN k.date = DATE '{real_day}' THEN CAST(sb.rank_score + 5 AS DOUBLE) ELSE {steam_score} END"
    stream_score = j_stream("so.score", zr) if jitter else "CAST(so.score AS DOUBLE)"
    stream_viewers = j_viewers("so.v", zv) if jitter else "so.v"
    streams = STREAMS if streams_present else STREAMS.replace("FROM raw_streams)", "FROM raw_streams WHERE false)")
    return ",".join([BARS, GAMES, streams, SMAP]) + f""",
kpi AS (
  SELECT ticker, date, open AS stock_open, close AS stock_close, high AS stock_high, low AS stock_low,
         volume AS stock_volume, coalesce(daily_change_pct, 0.0) AS daily_change_pct,
         coalesce(daily_range_pct, 0.0) AS daily_range_pct
  FROM bars WHERE date IS NOT NULL),
cal AS (SELECT DISTINCT ticker, date FROM kpi),
tw AS (SELECT rank, game_name, top_stream_viewers AS v, viewer_rank_score AS score FROM streams),
sb AS (
  SELECT g.name, g.ticker, g.rank, g.rank_score, g.peak_ccu, g.average_2weeks,
         coalesce(g.review_ratio, 0.0) AS review_ratio,
         coalesce(t.v, {kpi.NO_STREAM_VIEWERS}) AS twitch_viewers,
         coalesce(t.rank, {kpi.NO_STREAM_RANK}) AS twitch_rank,
         coalesce(CAST(t.score AS DOUBLE), {kpi.NO_STREAM_SCORE}) AS twitch_rank_score
  FROM games g LEFT JOIN tw t ON lower(g.name) = lower(t.game_name)
  WHERE g.ticker <> '{kpi.UNKNOWN_TICKER}'),
steam_rows AS (
  SELECT k.date, sb.name AS game_name, sb.ticker, 'steam' AS source,
         CAST(sb.rank AS BIGINT) AS steam_rank, {steam_score} AS steam_rank_score,
         CAST(sb.peak_ccu AS BIGINT) AS peak_ccu, CAST(sb.average_2weeks AS BIGINT) AS avg_playtime_2weeks,
         sb.review_ratio, CAST(sb.twitch_viewers AS BIGINT) AS twitch_viewers,
         CAST(sb.twitch_rank AS BIGINT) AS twitch_rank, sb.twitch_rank_score,
         k.stock_open, k.stock_close, k.stock_high, k.stock_low, k.stock_volume,
         k.daily_change_pct, k.daily_range_pct
  FROM sb JOIN kpi k ON sb.ticker = k.ticker),
blocking AS (
  SELECT DISTINCT lower(name) AS name_key FROM games
  WHERE ticker IN (SELECT ticker FROM cal)
     OR NOT EXISTS (SELECT 1 FROM games g2 WHERE g2.ticker IN (SELECT ticker FROM cal))),
so AS (
  SELECT t.game_name AS raw_name, trim(t.game_name) AS game_name, m.ticker, t.rank,
         coalesce(t.v, 0) AS v, coalesce(t.score, 0) AS score
  FROM tw t JOIN smap m ON lower(trim(t.game_name)) = m.name_lower
  WHERE t.game_name IS NOT NULL AND trim(t.game_name) <> ''
    AND lower(trim(t.game_name)) NOT IN (SELECT name_key FROM blocking)),
stream_rows AS (
  SELECT k.date, so.game_name, so.ticker, 'twitch' AS source,
         CAST(0 AS BIGINT) AS steam_rank, CAST(0.0 AS DOUBLE) AS steam_rank_score, CAST(0 AS BIGINT) AS peak_ccu,
         CAST(0 AS BIGINT) AS avg_playtime_2weeks, CAST(0.0 AS DOUBLE) AS review_ratio,
         CAST({stream_viewers} AS BIGINT) AS twitch_viewers, CAST(so.rank AS BIGINT) AS twitch_rank,
         {stream_score} AS twitch_rank_score,
         k.stock_open, k.stock_close, k.stock_high, k.stock_low, k.stock_volume,
         k.daily_change_pct, k.daily_range_pct
  FROM so JOIN kpi k ON so.ticker = k.ticker),
joined AS (SELECT * FROM steam_rows UNION ALL SELECT * FROM stream_rows),
scored AS (
  SELECT *, CASE WHEN source = 'twitch' THEN round(CAST(twitch_rank_score AS DOUBLE), 4)
                 ELSE round(steam_rank_score * 0.6::DOUBLE + twitch_rank_score * 0.4::DOUBLE, 4) END AS popularity_score
  FROM joined),
correlated AS (
  SELECT *, {corr_sql('popularity_score', 'daily_change_pct')} AS corr_7d_popularity_price,
            {corr_sql('twitch_viewers', 'daily_change_pct')} AS corr_7d_viewers_price
  FROM scored
  WINDOW w AS (PARTITION BY game_name, ticker ORDER BY date, source, twitch_rank
               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
usage AS (
  SELECT *, {signal_sql('corr_7d_popularity_price')} AS signal,
         CAST(source = 'twitch' AS INTEGER) AS source_is_twitch
  FROM correlated)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def doc_id_sql(ticker: str = "ticker", date: str = "date", game: str = "game_name") -> str:
    return (f"concat_ws('_', replace(coalesce({ticker}, '{kpi.UNKNOWN_TICKER}'), ' ', '_'), "
            f"replace(coalesce(strftime({date}, '%Y-%m-%d'), ''), '-', ''), "
            f"substr(replace(coalesce({game}, ''), ' ', '_'), 1, 30))")


TRAIN = """
train AS (SELECT * FROM usage WHERE date >= (SELECT max(date) FROM usage) - INTERVAL 29 DAY),
pairs AS (SELECT *, """ + signal_sql("corr_7d_viewers_price") + """ AS viewers_signal FROM train)"""

PRF = """
pc AS (SELECT signal AS actual, viewers_signal AS predicted, count(*) AS n FROM pairs GROUP BY 1, 2),
sup AS (SELECT actual AS cls, sum(n) AS support FROM pc GROUP BY 1),
pr AS (SELECT predicted AS cls, sum(n) AS n_pred FROM pc GROUP BY 1),
tp AS (SELECT actual AS cls, n AS tp FROM pc WHERE actual = predicted),
pcls AS (
  SELECT coalesce(sup.cls, pr.cls) AS cls, CAST(coalesce(tp.tp, 0) AS DOUBLE) AS tp,
         CAST(coalesce(sup.support, 0) AS DOUBLE) AS support, CAST(coalesce(pr.n_pred, 0) AS DOUBLE) AS n_pred
  FROM sup FULL JOIN pr ON sup.cls = pr.cls LEFT JOIN tp ON tp.cls = coalesce(sup.cls, pr.cls)),
prf0 AS (
  SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pcls),
prf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM prf0)"""

LIVE_CTX = """
ctx AS (
  SELECT ticker, date, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS previous_close,
         max(high) OVER (PARTITION BY ticker ORDER BY date_diff('day', DATE '1970-01-01', date)
                         RANGE BETWEEN 364 PRECEDING AND 1 PRECEDING) AS fifty_two_week_high,
         min(low) OVER (PARTITION BY ticker ORDER BY date_diff('day', DATE '1970-01-01', date)
                        RANGE BETWEEN 364 PRECEDING AND 1 PRECEDING) AS fifty_two_week_low
  FROM bars),
ticks AS (
  SELECT event_type AS ticker, CAST(ts AS TIMESTAMP) AS timestamp, value AS current_price, event_id AS seq,
         CAST(ts AS DATE) AS date
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL),
docs AS (
  SELECT concat_ws('_', t.ticker, strftime(t.timestamp, '%Y%m%d%H%M')) AS doc_id, t.ticker, t.timestamp,
         t.current_price, c.previous_close,
         CASE WHEN t.current_price <> 0 AND c.previous_close <> 0
              THEN round((t.current_price - c.previous_close) / c.previous_close * 100, 4) END AS change_pct,
         CASE WHEN t.current_price * 1000000.0::DOUBLE <> 0
              THEN CAST(trunc(t.current_price * 1000000.0::DOUBLE) AS BIGINT) END AS market_cap,
         c.fifty_two_week_high, c.fifty_two_week_low, 'USD' AS currency, '' AS exchange, t.seq, t.date
  FROM ticks t LEFT JOIN ctx c ON t.ticker = c.ticker AND t.date = c.date),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY timestamp DESC, seq DESC) AS rn
                 FROM docs) WHERE rn = 1)"""
