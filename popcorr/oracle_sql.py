"""Oracle SQL per registered key (DuckDB dialect), built from ``popcorr.oracle``."""

from __future__ import annotations

from popcorr.sources import pages as _pg
from popcorr.sources import testbed as _tb
from popcorr.oracle import (BARS, GAMES, RAW_GAMES, RAW_STREAMS, STREAMS, combine_ctes, corr_sql, d, j_stream, j_viewers,
                            signal_sql, ts, with_)

SQL: dict[str, str] = {}

SQL["bars_format"] = with_(BARS, f"""
SELECT ticker, {d('date')} AS date, open, high, low, close, volume, daily_change_pct, daily_range,
       daily_range_pct FROM bars""")

_ACT = f"""
SELECT ticker, {d('date')} AS date, volume, daily_change_pct,
       {corr_sql('CAST(volume AS DOUBLE)', 'daily_change_pct')} AS corr_7d_activity_price
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

SQL["rolling_corr_activity"] = with_(BARS, _ACT)

SQL["signal_label"] = with_(BARS + f",\nact AS ({_ACT})", f"""
SELECT *, {signal_sql('corr_7d_activity_price')} AS signal FROM act""")

SQL["steam_format"] = with_(GAMES, f"""
SELECT rank, app_id, name, developer, publisher, positive, negative, owners, average_forever,
       average_2weeks, peak_ccu, price, ticker,
       {ts('extracted_at')} AS extracted_at,
       {d('date')} AS date, review_ratio, rank_score FROM games""")

# log_viewers is compared at 10 decimals: the two engines' natural logs may
# differ in the last bit of a double
SQL["twitch_format"] = with_(STREAMS, f"""
SELECT rank, game_id, game_name, box_art_url, top_stream_viewers, {ts('extracted_at')} AS extracted_at,
       {d('date')} AS date, viewer_rank_score, round(log_viewers, 10) AS log_viewers FROM streams""")

SQL["ticker_resolution"] = with_(RAW_GAMES, """
SELECT rank, name, publisher, developer, ticker FROM raw_games""")

SQL["top_n_rank"] = with_(RAW_GAMES + "," + RAW_STREAMS, f"""
SELECT 'games' AS list, rank, app_id AS id, average_forever AS metric FROM raw_games0 WHERE rank <= {_tb.TOP_GAMES}
UNION ALL
SELECT 'streams' AS list, rank, game_id AS id, CAST(NULL AS BIGINT) AS metric FROM raw_streams WHERE rank <= {_tb.TOP_STREAMS}""")

_CORE_COLS = ("date, game_name, ticker, source, steam_rank, steam_rank_score, peak_ccu, avg_playtime_2weeks, "
              "review_ratio, twitch_viewers, twitch_rank, twitch_rank_score, stock_open, stock_close, stock_high, "
              "stock_low, stock_volume, daily_change_pct, daily_range_pct, popularity_score, "
              "corr_7d_popularity_price, corr_7d_viewers_price, signal, source_is_twitch")

SQL["combine_core"] = with_(combine_ctes(True), f"""
SELECT {_CORE_COLS.replace('date,', d('date') + ' AS date,', 1)} FROM usage""")

# ── combine-derived keys ─────────────────────────────────────────────────────
from popcorr.oracle import (BARS_RAW, LIVE_CTX, PMAP_VALUES, PRF, SMAP, TRACKED, TRAIN, doc_id_sql,  # noqa: E402
                            j_snapshot, z_sql)
from popcorr.functions import kpi as _kpi  # noqa: E402

_C = combine_ctes(True)
_KEY = f"{d('date')} AS date, game_name, ticker, source, twitch_rank"

SQL["popularity_score"] = with_(_C, f"SELECT {_KEY}, popularity_score FROM usage")
SQL["rolling_corr_popularity"] = with_(_C, f"""
SELECT {_KEY}, popularity_score, daily_change_pct, corr_7d_popularity_price FROM usage""")
SQL["rolling_corr_viewers"] = with_(_C, f"""
SELECT {_KEY}, twitch_viewers, daily_change_pct, corr_7d_viewers_price FROM usage""")
SQL["signal_distribution"] = with_(_C, "SELECT signal, count(*) AS n FROM usage GROUP BY signal")
_JOINED_COLS = ("date, game_name, ticker, source, steam_rank, steam_rank_score, peak_ccu, avg_playtime_2weeks, "
                "review_ratio, twitch_viewers, twitch_rank, twitch_rank_score, stock_open, stock_close, "
                "stock_high, stock_low, stock_volume, daily_change_pct, daily_range_pct")
_JC = _JOINED_COLS.replace("date,", d("date") + " AS date,", 1)
SQL["union_sources"] = with_(_C, f"SELECT {_JC} FROM joined")
SQL["join_steam_bars"] = with_(_C, f"SELECT {_JC} FROM steam_rows")
SQL["join_stream_only_bars"] = with_(_C, f"SELECT {_JC} FROM stream_rows")
SQL["optional_source_absent"] = with_(combine_ctes(True, streams_present=False), f"""
SELECT {_CORE_COLS.replace('date,', d('date') + ' AS date,', 1)} FROM usage""")

SQL["ticker_calendar"] = with_(BARS, f"SELECT DISTINCT ticker, {d('date')} AS date FROM bars")
SQL["expand_snapshot"] = with_(_C, f"""
SELECT g.name, g.ticker, {d('c.date')} AS date, g.rank_score FROM games g JOIN cal c ON g.ticker = c.ticker""")
SQL["expand_snapshot_jitter"] = with_(_C, f"""
SELECT g.name, g.ticker, {d('c.date')} AS date,
       {j_snapshot('g.rank_score', z_sql('g.name', 'g.ticker', 'c.date', 's'))} AS rank_score
FROM games g JOIN cal c ON g.ticker = c.ticker""")
SQL["stream_only_candidates"] = with_(_C, """
SELECT rank, game_name, lower(trim(game_name)) AS name_key FROM streams
WHERE game_name IS NOT NULL AND trim(game_name) <> ''
  AND lower(trim(game_name)) NOT IN (SELECT name_key FROM blocking)""")
SQL["stream_ticker_lookup"] = with_(_C, """
SELECT so.rank, lower(so.game_name) AS name_key, so.ticker FROM so""")
SQL["expand_stream_only"] = with_(_C, f"""
SELECT so.game_name, so.ticker, {d('k.date')} AS date,
       CAST({j_viewers('so.v', z_sql('so.raw_name', 'so.ticker', 'k.date', 'v'))} AS BIGINT) AS twitch_viewers,
       CAST(so.rank AS BIGINT) AS twitch_rank,
       {j_stream('so.score', z_sql('so.raw_name', 'so.ticker', 'k.date', 'r'))} AS twitch_rank_score
FROM so JOIN cal k ON so.ticker = k.ticker""")
SQL["join_stream_left"] = with_(_C, f"""
SELECT g.name, g.ticker, CAST(coalesce(t.v, 0) AS BIGINT) AS twitch_viewers,
       CAST(coalesce(t.rank, {_kpi.NO_STREAM_RANK}) AS BIGINT) AS twitch_rank,
       coalesce(CAST(t.score AS DOUBLE), 0.0) AS twitch_rank_score
FROM games g LEFT JOIN tw t ON lower(g.name) = lower(t.game_name)""")
SQL["filter_unknown"] = with_(GAMES, f"SELECT rank, name, ticker FROM games WHERE ticker <> '{_kpi.UNKNOWN_TICKER}'")
SQL["failed_tickers"] = with_(BARS + "," + TRACKED, """
SELECT ticker FROM tracked WHERE ticker NOT IN (SELECT DISTINCT ticker FROM bars)""")
SQL["top_stream_per_game"] = with_(RAW_STREAMS + """,
li AS (
  SELECT l_partkey, CAST(l_quantity AS BIGINT) AS viewers,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS stream_id,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem WHERE l_partkey IN (SELECT CAST(game_id AS BIGINT) FROM raw_streams))""", """
SELECT s.game_id, CAST(coalesce(li.viewers, 0) AS BIGINT) AS top_viewers, li.stream_id AS top_stream
FROM raw_streams s LEFT JOIN li ON li.l_partkey = CAST(s.game_id AS BIGINT) AND li.rn = 1""")

# ── preparation ─────────────────────────────────────────────────────────────
SQL["null_defaults"] = with_(RAW_GAMES + "," + RAW_STREAMS, f"""
SELECT 'streams' AS list, game_id AS id, CAST(NULL AS VARCHAR) AS developer, CAST(NULL AS VARCHAR) AS owners,
       coalesce(top_stream_viewers, 0) AS count_value FROM raw_streams
UNION ALL
SELECT 'games', app_id, CASE WHEN CAST(app_id AS BIGINT) % 7 = 0 THEN '' ELSE developer END, '' AS owners,
       CASE WHEN CAST(app_id AS BIGINT) % 9 = 0 THEN 0 ELSE positive END FROM raw_games0""")
SQL["drop_bad_dates"] = f"""
SELECT event_id, date_text, {d('dt')} AS date FROM (
  SELECT event_id, date_text, CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS dt FROM (
    SELECT event_id, '2024-01-' || lpad(json_extract_string(props, '$.k'), 2, '0') AS date_text FROM events))
WHERE dt IS NOT NULL"""
SQL["prep_zero_fill"] = with_(GAMES, """
SELECT rank, name, positive, negative, coalesce(review_ratio, 0.0) AS review_ratio, price FROM games""")
SQL["prep_all_null_text"] = with_(RAW_GAMES, """
SELECT rank, name, CASE WHEN CAST(app_id AS BIGINT) % 7 <> 0 THEN developer END AS developer,
       CASE WHEN CAST(app_id AS BIGINT) % 5 <> 0 THEN owners END AS owners, '' AS ticker FROM raw_games0""")
SQL["prep_dates"] = with_(GAMES, f"""
SELECT rank, {d('date')} AS date, coalesce({d('extracted_at')}, '') AS extracted_at FROM games""")
_clean = "CASE WHEN isinf({0}) OR isnan({0}) THEN NULL ELSE {0} END"
SQL["clean_numeric"] = with_(BARS, f"""
SELECT ticker, {d('date')} AS date, {_clean.format('x_pos')} AS x_pos, {_clean.format('x_neg')} AS x_neg,
       {_clean.format('x_nan')} AS x_nan, {_clean.format('x_mix')} AS x_mix, {_clean.format('x_ok')} AS x_ok
FROM (SELECT ticker, date, exp(volume * 1000.0::DOUBLE) AS x_pos, -exp(volume * 1000.0::DOUBLE) AS x_neg,
             exp(volume * 1000.0::DOUBLE) - exp(volume * 1000.0::DOUBLE) AS x_nan,
             CASE WHEN volume % 2 = 0 THEN exp(volume * 1000.0::DOUBLE) ELSE high END AS x_mix,
             close AS x_ok FROM bars)""")
SQL["train_window_filter"] = with_(_C + "," + TRAIN, f"SELECT {_KEY}, signal FROM train")
SQL["bars_history_window"] = with_(BARS, f"""
SELECT ticker, {d('date')} AS date, open, high, low, close, volume, daily_change_pct, daily_range, daily_range_pct
FROM bars WHERE date >= DATE '2024-01-31' - INTERVAL 365 DAY AND date < DATE '2024-01-31'""")
SQL["bars_date_range"] = with_(BARS, f"""
SELECT {d('min(date)')} AS min_date, {d('max(date)')} AS max_date, count(DISTINCT ticker) AS tickers,
       count(*) AS bars FROM bars""")
SQL["parse_timestamps"] = f"""
SELECT event_id, raw, strftime(timezone('UTC', TRY_CAST(raw AS TIMESTAMPTZ)), '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM (
  SELECT event_id,
         CASE WHEN event_id % 3 = 0 THEN strftime(CAST(ts AS TIMESTAMP) + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
              WHEN event_id % 3 = 1 THEN strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') || 'Z'
              ELSE strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') END AS raw
  FROM events)"""

# ── serving ─────────────────────────────────────────────────────────────────
SQL["doc_id"] = with_(_C, f"SELECT {doc_id_sql()} AS doc_id, game_name, ticker, {d('date')} AS date FROM usage")
_SERVING = f"""
serving0 AS (
  SELECT {doc_id_sql()} AS doc_id, date, game_name, ticker, CAST(steam_rank AS INTEGER) AS steam_rank,
         steam_rank_score, peak_ccu, avg_playtime_2weeks, review_ratio, twitch_viewers,
         CAST(twitch_rank AS INTEGER) AS twitch_rank, twitch_rank_score, stock_open, stock_close, stock_high,
         stock_low, stock_volume, daily_change_pct, daily_range_pct, popularity_score,
         corr_7d_popularity_price, corr_7d_viewers_price, signal, CAST(NULL AS VARCHAR) AS ml_prediction,
         CAST(NULL AS DOUBLE) AS ml_confidence, CAST(NULL AS DOUBLE) AS ml_accuracy,
         CAST(NULL AS DOUBLE) AS ml_f1_weighted, CAST(NULL AS DOUBLE) AS ml_f1_macro,
         CAST(NULL AS DOUBLE) AS ml_precision, CAST(NULL AS DOUBLE) AS ml_recall,
         '2024-01-31 08:00:00.000000' AS indexed_at, source AS _s, twitch_rank AS _r
  FROM usage),
serving AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY _s DESC, game_name DESC, _r DESC) AS rn
                 FROM serving0) WHERE rn = 1)"""
_SERV_COLS = ("doc_id, " + d("date") + " AS date, game_name, ticker, steam_rank, steam_rank_score, peak_ccu, "
              "avg_playtime_2weeks, review_ratio, twitch_viewers, twitch_rank, twitch_rank_score, stock_open, "
              "stock_close, stock_high, stock_low, stock_volume, daily_change_pct, daily_range_pct, popularity_score, "
              "corr_7d_popularity_price, corr_7d_viewers_price, signal, ml_prediction, ml_confidence, ml_accuracy, "
              "ml_f1_weighted, ml_f1_macro, ml_precision, ml_recall, indexed_at")
SQL["serving_cast"] = with_(_C + "," + _SERVING, f"SELECT {_SERV_COLS} FROM serving0")
SQL["serving_full_refresh"] = with_(_C + "," + _SERVING, f"SELECT {_SERV_COLS} FROM serving")
SQL["serving_count"] = with_(_C + "," + _SERVING, """
SELECT count(*) AS docs, count(DISTINCT doc_id) AS ids, (SELECT count(*) FROM serving0) - count(*) AS collisions
FROM serving""")
SQL["serving_sample"] = with_(_C + "," + _SERVING, f"""
SELECT doc_id, {d('date')} AS date, game_name, ticker, signal FROM serving ORDER BY doc_id LIMIT 3""")
SQL["usage_summary"] = with_(_C, f"""
SELECT count(*) AS rows, count(DISTINCT ticker) AS tickers, count(DISTINCT game_name) AS games,
       count(DISTINCT {doc_id_sql()}) AS doc_ids FROM usage""")

# ── evaluation ──────────────────────────────────────────────────────────────
SQL["class_counts"] = with_(_C + "," + TRAIN, """
SELECT label, n, CAST(least(5, min(n) OVER ()) AS INTEGER) AS n_folds
FROM (SELECT signal AS label, count(*) AS n FROM pairs GROUP BY signal)""")
SQL["confusion_matrix"] = with_(_C + "," + TRAIN, "SELECT signal AS actual, " + ", ".join(
    f"count(CASE WHEN viewers_signal = '{c}' THEN 1 END) AS {c}" for c in _kpi.SIGNAL_CLASSES)
    + " FROM pairs GROUP BY signal")
SQL["classification_scores"] = with_(_C + "," + TRAIN + "," + PRF, """
SELECT round(sum(tp) / sum(support), 4) AS accuracy,
       round(sum(f1 * support) / sum(support), 4) AS f1_weighted,
       round(avg(f1), 4) AS f1_macro,
       round(sum(precision * support) / sum(support), 4) AS precision_weighted,
       round(sum(recall * support) / sum(support), 4) AS recall_weighted
FROM prf""")
SQL["classification_report"] = with_(_C + "," + TRAIN + "," + PRF, """
SELECT cls AS label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       CAST(support AS BIGINT) AS support FROM prf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4),
       round(sum(f1 * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM prf""")
SQL["cv_folds"] = with_(_C + "," + TRAIN, f"""
SELECT {_KEY}, signal,
       CAST((row_number() OVER (PARTITION BY signal ORDER BY
              md5(concat_ws('|', {d('date')}, game_name, ticker, source, CAST(twitch_rank AS VARCHAR), '42')),
              date, game_name, ticker, source, twitch_rank) - 1)
            % (SELECT least(5, min(n)) FROM (SELECT count(*) AS n FROM train GROUP BY signal)) AS INTEGER) AS fold
FROM train""")
_FEATS = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in [
    "popularity_score", "steam_rank_score", "twitch_rank_score", "twitch_viewers", "peak_ccu",
    "avg_playtime_2weeks", "daily_change_pct", "daily_range_pct", "stock_volume", "source_is_twitch"])
SQL["feature_matrix"] = with_(_C, f"SELECT {_KEY}, {_FEATS} FROM usage")
SQL["label_index"] = with_(_C + "," + TRAIN, """
SELECT signal, CAST(dense_rank() OVER (ORDER BY signal) - 1 AS INTEGER) AS label_index
FROM (SELECT DISTINCT signal FROM train)""")

# ── layer I/O ───────────────────────────────────────────────────────────────
SQL["run_metrics"] = with_(",".join([BARS, GAMES, STREAMS, SMAP]), """
SELECT 'steam/TopGames' AS entity, '20240131' AS date, count(*) AS row_count FROM games
UNION ALL SELECT 'twitch/TopGames', '20240131', count(*) FROM streams
UNION ALL SELECT 'yahoo/GamingStocks', '20240131', count(*) FROM bars
UNION ALL SELECT 'dims/StreamNames', '20240131', count(*) FROM smap""")
SQL["partition_inventory"] = with_(",".join([BARS, GAMES, STREAMS, SMAP]), """
SELECT '20240131' AS run_date, count(*) AS rows, 'steam/TopGames' AS entity FROM games
UNION ALL SELECT '20240131', count(*), 'twitch/TopGames' FROM streams
UNION ALL SELECT '20240131', count(*), 'yahoo/GamingStocks' FROM bars
UNION ALL SELECT '20240131', count(*), 'dims/StreamNames' FROM smap""")
SQL["scan_json_envelope"] = with_(BARS_RAW, "SELECT ticker, date, open, high, low, close, volume FROM bars_raw")
SQL["paged_top_n"] = with_(RAW_STREAMS, f"""
SELECT list, CAST((rank - 1) // {_pg.PAGE_RECORDS} + 1 AS INTEGER) AS page, rank, game_id FROM raw_streams,
  (SELECT 'gap' AS list, {_tb.PAGE_WITHOUT_RECORDS - 1} AS pages UNION ALL SELECT 'no_cursor', {_tb.PAGE_WITHOUT_CURSOR} UNION ALL SELECT 'whole', {_pg.MAX_PAGES})
WHERE (rank - 1) // {_pg.PAGE_RECORDS} + 1 <= pages""")
SQL["union_batches"] = SQL["scan_json_envelope"]
SQL["sink_json_envelope"] = with_(BARS_RAW + "," + TRACKED, """
SELECT 'yahoo_finance' AS source, '20240131' AS date, count(*) AS records,
       (SELECT string_agg(ticker, ',' ORDER BY ticker) FROM tracked
        WHERE ticker NOT IN (SELECT ticker FROM bars_raw)) AS failed_tickers FROM bars_raw""")
SQL["games_from_envelope"] = SQL["steam_format"]
SQL["streams_from_envelope"] = SQL["twitch_format"]
SQL["bars_from_envelope"] = SQL["bars_format"]
SQL["layer_sort_order"] = with_(",".join([BARS, GAMES, STREAMS]), """
SELECT 'steam/TopGames' AS entity, count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM games
UNION ALL SELECT 'twitch/TopGames', count(*), 0 FROM streams
UNION ALL SELECT 'yahoo/GamingStocks', count(*), 0 FROM bars""")
SQL["serving_model"] = with_(_C + "," + _SERVING, "SELECT " + ", ".join(
    c for c in _SERV_COLS.split(", ") if not c.startswith("ml_")) + ", TRUE AS ml_ok FROM serving")
SQL["model_metrics_check"] = """
SELECT metric, TRUE AS equal FROM (VALUES ('accuracy'), ('f1_weighted'), ('f1_macro'), ('precision_weighted'),
                                          ('recall_weighted')) AS t(metric)"""
SQL["combine_full"] = with_(_C, f"""
SELECT {_CORE_COLS.replace('date,', d('date') + ' AS date,', 1)}, TRUE AS ml_ok FROM usage""")
SQL["model_quality"] = "SELECT TRUE AS better_than_guessing, CAST(0 AS BIGINT) AS rows_without_confidence"
SQL["combine_history"] = with_(combine_ctes(True, real_day="2024-01-15"), f"""
SELECT {_CORE_COLS.replace('date,', d('date') + ' AS date,', 1)} FROM usage""")
SQL["scan_parquet"] = SQL["bars_format"]
SQL["sink_parquet_roundtrip"] = with_(BARS, f"""
SELECT ticker, {d('date')} AS date, open, high, low, close, volume, daily_change_pct, daily_range,
       daily_range_pct, codec
FROM bars, (VALUES ('snappy'), ('gzip'), ('none')) AS c(codec)""")
SQL["empty_bars_schema"] = with_(BARS, f"""
SELECT ticker, {d('date')} AS date, open, high, low, close, volume, daily_change_pct, daily_range, daily_range_pct
FROM bars WHERE date < (SELECT min(date) FROM bars) AND date >= (SELECT min(date) FROM bars) - INTERVAL 365 DAY""")
SQL["bad_record_split"] = with_(RAW_STREAMS, """
SELECT 'good' AS status, count(*) AS n FROM raw_streams WHERE top_stream_viewers IS NOT NULL
UNION ALL SELECT 'bad', count(*) FROM raw_streams WHERE top_stream_viewers IS NULL""")

# ── live quotes ─────────────────────────────────────────────────────────────
SQL["live_change_pct"] = with_(BARS + "," + LIVE_CTX, """
SELECT seq, ticker, current_price, previous_close, change_pct, market_cap, fifty_two_week_high,
       fifty_two_week_low FROM docs""")
_LIVE_OUT = (f"doc_id, ticker, {ts('timestamp')} AS timestamp, current_price, previous_close, change_pct, "
             f"currency, exchange, seq, {d('date')} AS date")
SQL["stream_live_quotes"] = with_(BARS + "," + LIVE_CTX, f"SELECT {_LIVE_OUT} FROM latest")
SQL["stream_latest_per_minute"] = SQL["stream_live_quotes"]
SQL["stream_skipped_quotes"] = """
WITH t AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 7 = 0 THEN 'no ticker' WHEN event_id % 11 = 0 THEN 'no timestamp' END AS reason
           FROM events)
SELECT reason, count(*) AS ticks, count(*) AS observed FROM t WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'written', count(DISTINCT (event_type, date_trunc('minute', ts))), NULL FROM t WHERE reason IS NULL"""
SQL["live_upsert"] = SQL["stream_live_quotes"]
SQL["stream_latest_multi_batch"] = SQL["stream_live_quotes"]
SQL["stream_refresh_multi_batch"] = SQL["stream_live_quotes"]
SQL["live_dirty_quotes"] = with_(BARS + "," + LIVE_CTX + """,
dirty AS (
  SELECT *, CASE WHEN seq % 8 IN (0, 1, 2) THEN NULL WHEN seq % 8 = 3 THEN 0.0::DOUBLE ELSE current_price END AS price,
         CASE WHEN seq % 5 = 3 AND current_price <> 0 THEN CAST(trunc(current_price * 1000000.0::DOUBLE) AS BIGINT) END AS cap
  FROM ticks)""", """
SELECT t.seq, t.ticker, t.price AS current_price, c.previous_close,
       CASE WHEN t.price <> 0 AND c.previous_close <> 0
            THEN round((t.price - c.previous_close) / c.previous_close * 100, 4) END AS change_pct,
       t.cap AS market_cap, CASE WHEN t.seq % 6 = 0 THEN -t.current_price ELSE c.fifty_two_week_low END AS fifty_two_week_low,
       CASE WHEN t.seq % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       CASE WHEN t.seq % 4 = 0 THEN 'XPAR' ELSE '' END AS exchange
FROM dirty t LEFT JOIN ctx c ON t.ticker = c.ticker AND t.date = c.date""")

SQL["ml_fallback"] = with_(_C, """
SELECT game_name, ticker, source, steam_rank, steam_rank_score, peak_ccu, avg_playtime_2weeks, review_ratio,
       twitch_viewers, twitch_rank, twitch_rank_score, stock_open, stock_close, stock_high, stock_low,
       stock_volume, daily_change_pct, daily_range_pct, strftime(date, '%Y-%m-%d') AS date, popularity_score,
       corr_7d_popularity_price, corr_7d_viewers_price, signal, source_is_twitch,
       'NEUTRAL' AS ml_prediction, CAST(0.0 AS DOUBLE) AS ml_confidence, CAST(NULL AS DOUBLE) AS ml_accuracy,
       CAST(NULL AS DOUBLE) AS ml_f1_weighted, CAST(NULL AS DOUBLE) AS ml_f1_macro,
       CAST(NULL AS DOUBLE) AS ml_precision, CAST(NULL AS DOUBLE) AS ml_recall
FROM usage WHERE game_name = (SELECT min(game_name) FROM usage)
  AND date >= (SELECT max(date) FROM usage WHERE game_name = (SELECT min(game_name) FROM usage)) - INTERVAL 6 DAY""")

SQL["unresolved_report"] = with_(BARS + "," + SMAP + "," + TRACKED + f""",
pmap AS (SELECT * FROM (VALUES {PMAP_VALUES}) AS t(ordinal, k, ticker))""", """
SELECT DISTINCT 'publisher_map' AS dimension, ticker FROM pmap
WHERE ticker IS NOT NULL AND ticker NOT IN (SELECT DISTINCT ticker FROM bars)
UNION
SELECT DISTINCT 'stream_map' AS dimension, ticker FROM smap
WHERE ticker IS NOT NULL AND ticker NOT IN (SELECT DISTINCT ticker FROM bars)
UNION
SELECT DISTINCT 'tracked' AS dimension, ticker FROM tracked WHERE ticker NOT IN (SELECT DISTINCT ticker FROM bars)""")
