import datetime as dt
import os

from pyspark.sql import functions as F

from popcorr.operators import serve
from popcorr.plans import formats
from popcorr.sources import layers, schemas
from popcorr.streaming import live


def test_steam_format_edges(spark):
    raw = spark.createDataFrame([
        (1, "1", "a", "d", "p", 0, 0, "", None, None, None, "abc", None, "2024-01-31T08:00:00+02:00", "20240131"),
        (2, "2", "b", "d", "p", None, None, "", None, None, None, None, "X", "2024-01-31T08:00:00.123456+00:00", "20261345"),
        (3, "3", "c", "d", "p", 3, 1, "", 5, 6, 7, "999", "Y", "bad", "20240131"),
    ], schemas.RAW_GAME)
    out = {r.rank: r for r in formats.format_steam(raw).collect()}
    assert out[1].review_ratio is None and out[1].price == 0.0 and out[1].ticker == "UNKNOWN"
    assert out[1].extracted_at == dt.datetime(2024, 1, 31, 6, 0)          # offset honoured, UTC
    assert out[2].positive == 0 and out[2].date is None and out[2].price == 0.0
    assert out[2].extracted_at == dt.datetime(2024, 1, 31, 8, 0, 0, 123456)
    assert out[3].review_ratio == 0.75 and out[3].price == 999.0 and out[3].extracted_at is None
    assert [out[i].rank_score for i in (1, 2, 3)] == [100, 99, 98]


def test_twitch_format_edges(spark):
    raw = spark.createDataFrame([(1, "a", "A", "", None, None, "20240131"), (100, "b", "B", "", 0, None, "20240131"),
                                 (101, "c", "C", "", 1, None, "20240131"), (300, "d", "D", "", 5, None, "20240131")],
                                schemas.RAW_STREAM)
    out = {r.rank: r for r in formats.format_twitch(raw).collect()}
    assert [out[k].viewer_rank_score for k in (1, 100, 101, 300)] == [100, 1, 0, -199]
    assert out[1].top_stream_viewers == 0 and out[1].log_viewers == 0.0 and out[101].log_viewers == 0.0


def test_bars_format_edges_and_empty(spark):
    raw = spark.createDataFrame([
        ("A", "2024-01-02", 0.0, 2.0, 1.0, 1.5, None),
        ("A", "2024-01-03", None, 2.0, 1.0, 1.5, 10),
        ("A", "2024-01-04", -1.0, 1.0, 2.0, 1.5, 10),
        ("A", "not a date", 2.0, 3.0, 1.0, 2.5, 10)], schemas.RAW_BAR)
    out = formats.format_bars(raw).collect()
    assert [r.daily_change_pct for r in out] == [None, None, None, 25.0]
    assert out[0].volume == 0 and out[1].open == 0.0 and out[2].daily_range == -1.0 and out[3].date is None
    empty = formats.format_bars(spark.createDataFrame([], schemas.RAW_BAR))
    assert empty.columns == schemas.BARS_COLUMNS and empty.count() == 0


def test_envelope_roundtrip_and_chunks(spark, tmp_dir):
    recs = spark.range(250).select(F.lit("T").alias("ticker"), F.lit("2024-01-01").alias("date"),
                                   F.col("id").cast("double").alias("open"), F.lit(1.0).alias("high"),
                                   F.lit(0.0).alias("low"), F.lit(0.5).alias("close"), F.col("id").alias("volume"))
    path = os.path.join(tmp_dir, "env")
    layers.write_envelope(recs, path, {"source": "s", "date": "20240101", "tickers": ["T"]}, "records", chunk_rows=100)
    meta = layers.read_envelope_meta(spark, path, schemas.BARS_ENVELOPE, "records").collect()
    assert len(meta) == 3 and sum(m["count"] for m in meta) == 250 and meta[0].tickers == ["T"]
    back = layers.read_envelope(spark, path, schemas.BARS_ENVELOPE, "records")
    assert sorted(r.volume for r in back.collect()) == list(range(250))


def test_layer_overwrites_one_run_date(spark, tmp_dir):
    path = os.path.join(tmp_dir, "layer")
    df = spark.range(5).select(F.col("id").alias("x"))
    layers.write_layer(df, path, "20240101")
    meta = layers.write_layer(df.limit(2), path, "20240102")
    layers.write_layer(df.limit(3), path, "20240102")
    assert meta["row_count"] == 2
    got = {r.run_date: r["count"] for r in layers.read_layer(spark, path).groupBy("run_date").count().collect()}
    assert got == {20240101: 5, 20240102: 3} or got == {"20240101": 5, "20240102": 3}
    missing = layers.read_optional(spark, os.path.join(tmp_dir, "nope"), schemas.TWITCH_FORMATTED)
    assert missing.count() == 0 and missing.columns == schemas.TWITCH_FORMATTED.names


def _usage_rows(spark):
    rows = [("2024-01-02", "Same Prefix Game Name Long Enough A", "T", "steam", 1),
            ("2024-01-02", "Same Prefix Game Name Long Enough B", "T", "steam", 2),
            ("2024-01-02", "Other", None, "twitch", 3)]
    return spark.createDataFrame(rows, "date string, game_name string, ticker string, source string, twitch_rank long")


def test_serving_refresh_collisions_and_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "serving")
    meta = serve.full_refresh(_usage_rows(spark), path, indexed_at="2024-01-31 08:00:00")
    docs = serve.read_serving(spark, path).collect()
    assert meta["indexed_count"] == 2 and meta["collisions"] == 1
    ids = {d.doc_id: d.game_name for d in docs}
    collided = "T_20240102_" + "Same Prefix Game Name Long Enough A".replace(" ", "_")[:30]
    assert ids[collided].endswith("B")                                   # later write wins
    assert "UNKNOWN_20240102_Other" in ids
    meta2 = serve.full_refresh(_usage_rows(spark).limit(0), path)
    assert meta2["written"] is False and serve.read_serving(spark, path).count() == 2
    meta3 = serve.full_refresh(_usage_rows(spark).where("ticker IS NULL"), path)
    assert meta3["written"] and serve.read_serving(spark, path).count() == 1   # a refresh replaces


def _ticks(spark, rows):
    return spark.createDataFrame(rows, "ticker string, timestamp timestamp, current_price double, seq long")


def test_live_upsert_latest_and_idempotent(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 2, 10, 0, 5)
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 10.0, 1, 0.0, 1.5, 150.0),
                                  ("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.0, 1, 0.0, 1.5, 150.0)],
                                 schemas.BARS_FORMATTED)
    ctx = live.bar_context(bars)
    docs = live.quote_docs(_ticks(spark, [("A", t0, 11.0, 1), ("A", t0 + dt.timedelta(seconds=30), 12.0, 2),
                                          ("A", t0 + dt.timedelta(minutes=5), 0.0, 3), (None, t0, 1.0, 4)]), ctx)
    path = os.path.join(tmp_dir, "live")
    live.upsert(docs, path)
    first = sorted(tuple(r) for r in live.read_live(spark, path).select("doc_id", "current_price", "change_pct").collect())
    live.upsert(docs, path)
    live.upsert(docs.limit(0), path)
    again = sorted(tuple(r) for r in live.read_live(spark, path).select("doc_id", "current_price", "change_pct").collect())
    assert first == again
    assert first == [("A_202401021000", 12.0, 20.0), ("A_202401021005", 0.0, None)]


def test_multiline_envelope_and_missing_array(spark, tmp_dir):
    import json
    path = os.path.join(tmp_dir, "raw_games")
    os.makedirs(path)
    env = {"source": "steamspy", "date": "20240131", "count": 2, "extra": {"ignored": True},
           "games": [{"rank": 1, "app_id": "10", "name": "A", "positive": 5, "price": 999},
                     {"rank": 2, "app_id": "11", "name": "B", "unknown_field": 1}]}
    with open(os.path.join(path, "extract.json"), "w") as fh:
        json.dump(env, fh, indent=2, ensure_ascii=False)
    with open(os.path.join(path, "empty.json"), "w") as fh:
        json.dump({"source": "steamspy", "date": "20240131", "count": 0}, fh, indent=2)
    recs = layers.read_envelope(spark, path, schemas.GAMES_ENVELOPE, "games", multi_line=True).collect()
    assert sorted(r.name for r in recs) == ["A", "B"]
    a = [r for r in recs if r.name == "A"][0]
    assert a.price == "999" and a.positive == 5            # number widened to text by the schema


def test_stream_equals_batch(spark, tmp_dir, sf_small):
    """T1-T5 under availableNow give the same table as the batch upsert."""
    from popcorr.plans import inputs
    from popcorr.session import shared_dir
    from popcorr.sources import testbed

    ctx = live.bar_context(inputs.bars(spark, sf_small))
    events = testbed.read(spark, sf_small, "events")
    batch_path = os.path.join(tmp_dir, "live_batch")
    live.upsert(live.quote_docs(testbed.quote_ticks(events), ctx), batch_path)
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_small))
    for start in (live.start_live_refresh, live.start_latest_per_minute):
        table = os.path.join(tmp_dir, start.__name__)
        q = start(testbed.quote_ticks(stream), ctx, table, shared_dir(spark, "ckpt"), available_now=True)
        q.awaitTermination()
        cols = ["doc_id", "current_price", "change_pct", "seq"]
        a = sorted(tuple(r) for r in live.read_live(spark, batch_path).select(*cols).collect())
        b = sorted(tuple(r) for r in live.read_live(spark, table).select(*cols).collect())
        assert a == b and len(a) > 0


def test_live_market_cap_zero_is_null(spark):
    t0 = dt.datetime(2024, 1, 2, 10, 0, 5)
    ctx = spark.createDataFrame([], "ticker string, date date, previous_close double, "
                                    "fifty_two_week_high double, fifty_two_week_low double")
    ticks = _ticks(spark, [("A", t0, 0.0, 1), ("A", t0, 2.5, 2)])
    docs = live.quote_docs(ticks, ctx, market_cap=F.col("current_price") * F.lit(10.0)).collect()
    caps = sorted((r.seq, r.market_cap, r.change_pct, r.currency, r.exchange) for r in docs)
    assert caps == [(1, None, None, "USD", ""), (2, 25, None, "USD", "")]
