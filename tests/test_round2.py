"""Publishing, live quotes over several micro-batches, storage rules, resolution and chunk bounds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from popcorr import session
from popcorr.operators import resolve, serve
from popcorr.plans import combine, enrich, formats
from popcorr.sources import layers, schemas, testbed, versions
from popcorr.streaming import live

T0 = dt.datetime(2024, 1, 2, 10, 0, 5)
NO_CONTEXT = "ticker string, date date, previous_close double, fifty_two_week_high double, fifty_two_week_low double"


def _docs(spark, rows):
    ticks = spark.createDataFrame(rows, "ticker string, timestamp timestamp, current_price double, seq long")
    return live.quote_docs(ticks, spark.createDataFrame([], NO_CONTEXT))


def _prices(spark, path):
    return sorted((r.doc_id, r.current_price) for r in live.read_live(spark, path).collect())


def test_a_failure_before_publishing_leaves_the_old_live_table(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "live")
    live.upsert(_docs(spark, [("A", T0, 1.0, 1)]), path)
    before = _prices(spark, path)
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        live.upsert(_docs(spark, [("A", T0, 2.0, 2), ("B", T0, 3.0, 1)]), path)
    assert _prices(spark, path) == before
    monkeypatch.undo()
    live.upsert(_docs(spark, [("A", T0, 2.0, 2), ("B", T0, 3.0, 1)]), path)       # the replay
    assert _prices(spark, path) == [("A_202401021000", 2.0), ("B_202401021000", 3.0)]


def test_late_ticks_and_old_versions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "live")
    day = dt.timedelta(days=1)
    for seq, (when, price) in enumerate([(T0 + day, 5.0), (T0, 1.0), (T0 + dt.timedelta(seconds=20), 3.0),
                                         (T0 + dt.timedelta(seconds=10), 2.0), (T0 + day, 4.0)]):
        live.upsert(_docs(spark, [("A", when, price, seq)]), path)
    assert _prices(spark, path) == [("A_202401021000", 3.0), ("A_202401031000", 4.0)]
    assert len(versions.children(spark, f"{path}/data")) <= 3 and not versions.children(spark, f"{path}/staged")
    assert len(versions.children(spark, f"{path}/_published")) == versions.KEEP


def test_a_taken_version_number_is_not_overwritten(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "t")
    assert versions.current(spark, root) is None
    assert versions.publish(spark, root, ["a"]) == 1
    monkeypatch.setattr(versions, "_numbers", lambda *a: [])
    with pytest.raises(Exception, match="exist"):
        versions.publish(spark, root, ["b"])
    monkeypatch.undo()
    assert versions.current(spark, root) == ["a"]


def test_a_failure_before_publishing_leaves_the_old_serving_table(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "serving")
    usage = spark.createDataFrame([("2024-01-02", "Game", "T", "steam", 1)],
                                  "date string, game_name string, ticker string, source string, twitch_rank long")
    serve.full_refresh(usage, path)
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        serve.full_refresh(usage.withColumn("game_name", F.lit("Other")), path)
    assert [r.game_name for r in serve.read_serving(spark, path).collect()] == ["Game"]
    monkeypatch.undo()
    for _ in range(4):
        serve.full_refresh(usage, path)
    assert len(versions.children(spark, f"{path}/data")) == versions.KEEP
    with pytest.raises(FileNotFoundError):
        serve.read_serving(spark, os.path.join(tmp_dir, "none"))


def test_dirty_quotes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("A", T0, nan, 1, nan, 10.0, "EUR"), ("A", T0, inf, 2, inf, 10.0, None), ("A", T0, None, 3, None, 10.0, "USD"),
            ("A", T0, 12.0, 4, 1e300, nan, "JPY"), ("A", T0, 12.0, 5, 2.9, 10.0, None), (None, T0, 1.0, 6, 1.0, 1.0, None),
            ("A", None, 1.0, 7, 1.0, 1.0, None)]
    ticks = spark.createDataFrame(rows, "ticker string, timestamp timestamp, current_price double, seq long, market_cap double, "
                                        "previous_close double, currency string")
    got = {r.seq: (r.current_price, r.change_pct, r.market_cap, r.currency) for r in
           live.quote_docs(ticks, spark.createDataFrame([], NO_CONTEXT)).collect()}
    assert got == {1: (None, None, None, "EUR"), 2: (None, None, None, "USD"), 3: (None, None, None, "USD"),
                   4: (12.0, None, None, "JPY"), 5: (12.0, 20.0, 2, "USD")}


def test_nan_bars_become_zero(spark):
    nan = float("nan")
    raw = spark.createDataFrame([("A", "2024-01-02", nan, 2.0, nan, 1.0, nan), ("A", "2024-01-03", 2.0, 4.0, 1.0, 3.0, 7.0)],
                                "ticker string, date string, open double, high double, low double, close double, volume double")
    got = sorted((r.open, r.low, r.volume, r.daily_change_pct) for r in formats.format_bars(raw).collect())
    assert got == [(0.0, 0.0, 0, None), (2.0, 1.0, 7, 50.0)]


def test_a_machine_local_folder_is_refused_off_local_mode(spark, monkeypatch):
    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            _jsc = None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Fake)
    Fake.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Fake)


def test_substring_resolution_against_every_pair(spark):
    names = ["Alpha", "al", "ALPHA BETA", "x", "", "beta", "Gamma Delta", "delta", "öl", "lp"]
    keys = [(0, "alpha", "T0"), (1, "Beta", None), (2, "gamma delta epsilon", "T2"), (3, "ALPHA BETA", "T3"), (4, "Öl", "T4"), (5, "", "T5")]
    want = {}
    for n in names:
        hits = sorted((0 if n == k and t else 1, o, t) for o, k, t in keys
                      if (n == k and t) or k.lower() in n.lower() or n.lower() in k.lower())
        if hits:
            want[n] = hits[0][2]
    got = {r.nm: r.ticker for r in resolve.name_matches(spark.createDataFrame([(n,) for n in names], "nm string"),
                                                        spark.createDataFrame(keys, schemas.PUBLISHER_MAP)).collect()}
    assert got == want


def test_packed_order_and_top_stream(spark):
    lines = [(1, 5, 1, 3.0), (1, 4, 2, 3.0), (1, 4, 1, 3.0), (1, 9, 1, 1.0), (2, 7, 3, 8.0)]
    games = spark.createDataFrame([("1",), ("2",), ("3",)], "game_id string")
    got = {r.game_id: (r.top_viewers, r.top_stream) for r in enrich.top_stream_per_game(
        games, spark.createDataFrame(lines, "l_partkey long, l_orderkey long, l_linenumber int, l_quantity double")).collect()}
    assert got == {"1": (3, "4-1"), "2": (8, "7-3"), "3": (0, None)}
    pairs = [(1, 2**62), (2, 0), (-5, 1), (10**17, 3)]
    rows = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(pairs)], "a long, b long, i int")
    order = [r.i for r in rows.orderBy(testbed.packed_order(F.col("a"), F.col("b"))).collect()]
    assert order == sorted(range(4), key=lambda i: pairs[i])


def test_bars_and_live_do_not_shuffle_events(spark):
    from popcorr import catalog

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key, scans in (("bars_format", 1), ("live_change_pct", 1)):
            plan = catalog.REGISTRY[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "SortAggregate" not in plan and plan.count("events.parquet") == scans, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bound_on_the_largest_group(spark):
    games = spark.createDataFrame([("G", "T"), ("G", "T"), ("H", "T")], "name string, ticker string")
    bars = spark.createDataFrame([("T", i) for i in range(5)], "ticker string, date int")
    streams = spark.createDataFrame([("g",), (" G ",), ("G",), ("h",)], "game_name string")
    assert combine.largest_group(games, bars, streams) == 5 * (2 * 3 + 3)
    assert combine.largest_group(games, bars, None) == 5 * 2


def test_envelope_buckets_follow_the_rows(spark, tmp_dir):
    raw = spark.range(200).select(F.col("id").cast("string").alias("ticker"), F.lit("2024-01-02").alias("date"))
    found = []
    for i in range(2):
        path = os.path.join(tmp_dir, f"e{i}")
        layers.write_envelope(raw.repartition(3 + i), path, {"source": "s", "date": "d"}, "records", chunk_rows=50)
        schema = schemas.BARS_ENVELOPE
        env = layers.read_envelope(spark, path, schema, "records").select("ticker")
        assert env.count() == 200
        found.append({tuple(sorted(x.ticker for x in r.records)) for r in spark.read.schema(schema).json(path).collect()})
    assert found[0] == found[1] and len(found[0]) == 4


def test_an_empty_snapshot_writes_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "layer")
    df = spark.range(3).select(F.col("id").alias("x"))
    assert layers.write_layer(df, path, "20240101", skip_empty=True)["row_count"] == 3
    meta = layers.write_layer(df.limit(0), path, "20240101", skip_empty=True)
    assert meta["row_count"] == 0 and not meta["written"] and spark.read.parquet(path).count() == 3
    assert layers.write_layer(df.where("x > 5"), path, "20240102")["row_count"] == 0
