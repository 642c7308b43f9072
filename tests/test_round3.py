"""Pages by cursor, keyed state of the per-minute stream, counted skips."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from popcorr.session import cut_lineage, path_exists, release, shared_dir
from popcorr.sources import pages
from popcorr.streaming import live


def _pages(spark, rows):
    return spark.createDataFrame(rows, "list string, cursor string, data array<struct<rank:int,game_id:string>>, next_cursor string")


def test_pages_end_where_a_client_would(spark, tmp_dir):
    one = lambda *ranks: [(r, f"g{r}") for r in ranks]
    rows = [("a", None, one(1, 2), "x"), ("a", "x", one(3), "y"), ("a", "y", [], "z"), ("a", "z", one(9), None),       # an empty page
            ("b", None, one(1), None), ("b", "x", one(2), "y"),                                                        # no cursor
            ("c", "p", one(1), None),                                                                                   # no first page
            ("d", None, None, "x"), ("d", "x", one(5), None),                                                           # a page without a list
            *[("e", f"p{k}" if k else None, one(k), f"p{k + 1}") for k in range(9)],                                    # more than the limit
            ("f", None, one(1), "q"), ("f", "q", one(2), "q")]                                                          # a cursor to itself
    path = os.path.join(tmp_dir, "pages")
    pages.write_pages(_pages(spark, rows), path)
    got = pages.follow(pages.read_pages(spark, path, "rank: int, game_id: string"))
    assert sorted((r["list"], r.page, r["rank"]) for r in got.collect()) == [
        ("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("b", 1, 1), *[("e", k + 1, k) for k in range(6)],
        ("f", 1, 1), *[("f", k, 2) for k in range(2, 7)]]
    assert pages.follow(_pages(spark, rows).limit(0)).count() == 0
    assert {r.page for r in pages.follow(_pages(spark, rows), 2).where("list = 'e'").collect()} == {1, 2}


TICK = "ticker string, timestamp timestamp, current_price double, seq long, market_cap long"
T0 = dt.datetime(2024, 1, 2, 10, 0, 5)


def _stream(spark, tmp_dir, batches):
    """A stream of one micro-batch for each list of ticks."""
    src = os.path.join(tmp_dir, "ticks")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TICK).coalesce(1).write.parquet(f"{src}/{i:03d}")
    return spark.readStream.schema(TICK).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(src)


@pytest.fixture()
def context(spark):
    return spark.createDataFrame([], "ticker string, date date, previous_close double, fifty_two_week_high double, fifty_two_week_low double")


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


BATCHES = [[("A", _at(10), 1.0, 1, 12_345_678_901), ("A", _at(20), 2.0, 2, None), ("B", _at(0), 5.0, 3, None), (None, _at(0), 1.0, 4, None)],
           [("A", _at(5), 3.0, 5, None), ("A", _at(70), 4.0, 6, None), ("B", _at(0), 6.0, 7, 12_345_678_901)],             # an earlier tick, a tie
           [("A", _at(30), 7.0, 8, None), ("C", None, 1.0, 9, None)]]                                                   # late, but the last of its minute
LAST = [("A", "1000", 7.0, 8), ("A", "1001", 4.0, 6), ("B", "1000", 6.0, 7)]


@pytest.mark.parametrize("keep_ms", [live.KEEP_MS, 1])
def test_state_keeps_the_last_tick_of_a_minute(spark, tmp_dir, context, keep_ms):
    table = os.path.join(tmp_dir, "live")
    q = live.start_latest_per_minute(_stream(spark, tmp_dir, BATCHES), context, table, shared_dir(spark, "ckpt"), True, keep_ms)
    q.awaitTermination()
    rows = live.read_live(spark, table).collect()
    assert sorted((r.ticker, r.timestamp.strftime("%H%M"), r.current_price, r.seq) for r in rows) == LAST
    assert {r.ticker: r.market_cap for r in rows if r.market_cap} == {"B": 12_345_678_901}                                 # no rounding on the way
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    # state of a minute goes when it has not changed for a while; with a long time it is one row for each minute
    assert held and (max(held) == 3 if keep_ms > 1 else held[-1] < 3)


def test_state_passes_on_only_what_is_later(spark, tmp_dir, context):
    seen = []
    docs = live.newest_of_minute(live.quote_docs(_stream(spark, tmp_dir, BATCHES), context).select(*live.LIVE_COLUMNS))
    q = (docs.writeStream.outputMode("update").option("checkpointLocation", shared_dir(spark, "ckpt"))
         .foreachBatch(lambda df, i: seen.append(sorted(r.seq for r in df.collect()))).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [s for s in seen if s] == [[2, 3], [6, 7], [8]]                        # not 5, which is earlier than 2


def test_skips_are_counted_and_kept(spark, tmp_dir, context):
    table, kept = os.path.join(tmp_dir, "live"), os.path.join(tmp_dir, "kept")
    q = live.start_counted_refresh(_stream(spark, tmp_dir, BATCHES), context, table, kept, shared_dir(spark, "ckpt"), True)
    q.awaitTermination()
    assert live.skipped_counts(q) == {"ticks": 9, "no ticker": 1, "no timestamp": 1}
    from pyspark.sql.types import StructType
    rows = live.read_quarantine(spark, kept, StructType.fromDDL(TICK)).collect()
    assert sorted((r.seq, r.reason) for r in rows) == [(4, "no ticker"), (9, "no timestamp")]
    assert sorted((r.ticker, r.timestamp.strftime("%H%M"), r.current_price, r.seq) for r in live.read_live(spark, table).collect()) == LAST


def test_release_deletes_only_cut_folders(spark, tmp_dir):
    spark.range(5).write.parquet(os.path.join(tmp_dir, "mine"))
    own = cut_lineage(spark.range(5).select((F.col("id") + 1).alias("x")))
    other = spark.read.parquet(os.path.join(tmp_dir, "mine"))
    folder = own.inputFiles()[0].rpartition("/")[0]
    release(own, other)
    assert not path_exists(spark, folder) and other.count() == 5


def test_partition_rows_come_from_footers(spark, tmp_dir):
    from popcorr.sources import layers

    path = os.path.join(tmp_dir, "layer")
    for day, n in (("20240101", 30), ("20240102", 7)):
        layers.write_layer(spark.range(n).repartition(3), path, day)
    assert sorted(map(tuple, layers.partition_rows(spark, path).collect())) == [("20240101", 30), ("20240102", 7)]
    with layers.footers_only(spark):
        plan = layers.count_partitions(spark, path)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    files = layers.partition_inventory(spark, path).collect()
    assert sum(r.rows for r in files) == 37 and len({r.file_path for r in files}) == len(files)


def test_blank_stream_names_do_not_make_a_group_large(spark):
    """Blank names join nothing and are no candidates, so many of them call for no chunked windows."""
    from popcorr.plans import combine
    games = spark.createDataFrame([("A", "t"), ("B", "t"), ("B", "t")], "name string, ticker string")
    bars = spark.createDataFrame([("t", f"2024-01-0{d}") for d in range(1, 6)], "ticker string, date string")
    streams = spark.createDataFrame([("   ",)] * 40 + [("a",), ("b",), ("B",), (" b ",), (None,)], "game_name string")
    # 5 days x (2 equal games x 3 streams of their name + 3 streams of one name)
    assert combine.largest_group(games, bars, streams) == 5 * (2 * 3 + 3)
    assert combine.largest_group(games, bars, None) == 5 * 2
    assert combine.largest_group(games.limit(0), bars.limit(0), streams) == 0


def test_sort_order_check_broadcasts_no_layer(spark, tmp_dir):
    """Rows meet the row before them in a merge join: no layer passes through the driver (F1)."""
    from popcorr import catalog
    k = F.col("id")
    spark.range(40).select(k.alias("l_partkey"), (k * 3 % 7).cast("double").alias("l_quantity"), F.lit("R").alias("l_returnflag"),
                           F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
                           k.cast("double").alias("l_extendedprice")).write.parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    spark.range(40).select(k.alias("p_partkey"), F.lit("name").alias("p_name"), F.lit("Brand#11").alias("p_brand"), F.lit("ECONOMY").alias("p_type"),
                           F.lit(3).alias("p_size")).write.parquet(os.path.join(tmp_dir, "part.parquet"))
    spark.range(40).select(k.alias("event_id"), F.lit("2024-01-02 00:00:00").cast("timestamp").alias("ts"), (k % 5).cast("string").alias("event_type"),
                           k.cast("double").alias("value")).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    out = catalog.REGISTRY["layer_sort_order"](spark, tmp_dir)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and "BroadcastHashJoin" not in plan, plan
    assert {(r["entity"], r["rows"], r["violations"]) for r in out.collect()} == {
        ("steam/TopGames", 40, 0), ("twitch/TopGames", 40, 0), ("yahoo/GamingStocks", 5, 0)}


def test_documents_pass_the_state_unchanged(spark, tmp_dir, context):
    """Documents go through the keyed state as one narrow column and come out as they were."""
    late = dt.datetime(1969, 12, 31, 23, 59, 59, 999_999)
    ticks = [("A", _at(1), 0.1 + 0.2, 2**53 + 1, 2**60 + 1), ("B \"\u00e9\\ ", late, 5e-324, -7, None), ("C", _at(2), None, None, 0), ("C", _at(2), 9.0, None, 1)]
    docs = live.quote_docs(_stream(spark, tmp_dir, [ticks]), context).select(*live.LIVE_COLUMNS)
    seen = []
    out = live.newest_of_minute(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    q = (out.writeStream.outputMode("update").option("checkpointLocation", shared_dir(spark, "ckpt"))
         .foreachBatch(lambda df, i: seen.extend(df.collect())).trigger(availableNow=True).start())
    q.awaitTermination()
    want = live.quote_docs(spark.createDataFrame(ticks, TICK), context).select(*live.LIVE_COLUMNS).collect()
    assert sorted(r for r in seen if r.ticker != "C") == sorted(r for r in want if r.ticker != "C")
    assert len([r for r in seen if r.ticker == "C"]) == 1 and all(r in want for r in seen)


def test_micro_batches_follow_parts_not_files(spark, tmp_dir):
    """Parts of many files are still one micro-batch each."""
    from popcorr import catalog
    k = F.col("id")
    spark.range(0, 90, 1, 3).select(k.alias("event_id"), F.timestamp_seconds(1704186000 + k * 20).cast("timestamp_ntz").alias("ts"), F.lit("t").alias("event_type"),
                                    k.cast("double").alias("value")).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    batches = []
    def start(ticks, ctx, table, ckpt, available_now):
        seen = lambda df, i: (batches.append(df.count()), live.upsert(live.quote_docs(df, ctx), table))
        return ticks.writeStream.foreachBatch(seen).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    assert catalog._multi_batch(spark, tmp_dir, start).count() == 30
    assert len(batches) == catalog.EVENT_PARTS and sum(batches) == 90
    assert catalog.REGISTRY["stream_latest_multi_batch"](spark, tmp_dir).agg(F.sum("seq")).first()[0] == sum(range(2, 90, 3))
