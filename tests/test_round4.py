"""Window tasks that follow the rows, a serving refresh that shuffles ids."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from popcorr.operators import serve
from popcorr.plans import combine
from popcorr.session import cut_lineage
from popcorr.sources import schemas

_D0 = dt.date(2024, 1, 1)
_GAMES = StructType([f for f in schemas.STEAM_FORMATTED if f.name != "run_date"])          # another test adds one in place


def _snapshots(spark, n=60, days=10):
    """``n`` games and their streams, as many stream-only games, two streams of one name; blanks around half of the names."""
    bars = spark.createDataFrame(
        [(t, _D0 + dt.timedelta(i), 10.0, 11.0, 9.0, 10.0 + i, 100, float((i * 7 + k) % 5), 2.0, 20.0)
         for k, t in enumerate("AB") for i in range(days)], schemas.BARS_FORMATTED)
    games = spark.createDataFrame(
        [(i, str(i), f"g{i}", "d", "p", 1, 1, "", 1, 1, 1, 0.0, ("A", "B", "UNKNOWN")[i // 2 % 3], None, _D0, 0.5, 100 - i)
         for i in range(n)], _GAMES)
    streams = spark.createDataFrame(
        [(i, f"s{i}", f" G{i} " if i % 2 else f"G{i}", "", 50 + i, None, _D0, 100 - i, 1.0) for i in range(2 * n)]
        + [(500, "x", "g6", "", 7, None, _D0, 1, 1.0)], schemas.TWITCH_FORMATTED)
    smap = spark.createDataFrame([(f"g{i}", "AB"[i % 2]) for i in range(2 * n)], schemas.STREAM_MAP)
    return tuple(cut_lineage(x) for x in (games, bars, streams, smap))                # written, as layers are


def test_window_tasks_follow_the_rows_and_games_are_dealt_before_they_are_expanded(spark, monkeypatch):
    """Tasks cut by shuffled bytes had more rows to sort the larger the input."""
    monkeypatch.setattr(combine, "TASK_ROWS", 40)
    games, bars, streams, smap = _snapshots(spark)
    size = combine.bounds(games, bars, streams)
    got = combine.combine(games, bars, streams, smap)
    plan = got._jdf.queryExecution().executedPlan().toString()                       # before it runs: nothing adapted yet
    assert "hashpartitioning(game_name" not in plan and plan.count("REPARTITION_BY_NUM") == 2
    rows = sorted(map(tuple, got.collect()), key=repr)
    snapshot = sum(r[3] == "steam" for r in rows)
    assert snapshot <= size.snapshot <= 2 * snapshot and 0 < len(rows) - snapshot <= size.stream_only
    at = got.withColumn("_at", F.spark_partition_id())
    assert at.select("_at").distinct().count() > len(rows) // 80
    assert at.groupBy("game_name", "ticker").agg(F.countDistinct("_at").alias("n")).where("n > 1").count() == 0
    # the same rows as by windows over the whole relation
    whole = combine.correlated(combine.joined(games, bars, streams, smap)).select(got.columns)
    assert rows == sorted(map(tuple, whole.collect()), key=repr)
    assert rows == sorted(map(tuple, combine.combine(games, bars, streams, smap, chunk_rows=7).select(got.columns).collect()), key=repr)


def test_window_tasks(monkeypatch):
    assert [combine.window_tasks(n, 8) for n in (0, 1, 50_000, 10 ** 6, 10 ** 8)] == [1, 1, 3, 8, 500]


def _usage(spark, rows):
    return spark.createDataFrame(rows, "date string, game_name string, ticker string, source string, twitch_rank long")


def test_a_refresh_shuffles_documents_only_where_ids_collide(spark, tmp_dir, monkeypatch):
    """Every document was sorted and shuffled whole to find that no two share an id."""
    asked, of = [], serve.last_write_wins
    monkeypatch.setattr(serve, "last_write_wins", lambda docs, key="doc_id": asked.append(docs.count()) or of(docs, key))
    path = os.path.join(tmp_dir, "serving")
    own = [("2024-01-02", f"Game {i}", "T", "steam", i) for i in range(50)]
    meta = serve.full_refresh(_usage(spark, own), path)
    assert (meta["indexed_count"], meta["collisions"], asked) == (50, 0, [])
    long = "A name that is longer than thirty characters "
    alike = [("2024-01-02", long + x, "T", s, r) for x, s, r in (("A", "twitch", 1), ("B", "steam", 9), ("C", "steam", 2))]
    for few in (serve.BROADCAST_MAX_ROWS, 0):                         # split by a broadcast, or all documents together
        monkeypatch.setattr(serve, "BROADCAST_MAX_ROWS", few)
        asked.clear()
        meta = serve.full_refresh(_usage(spark, own + alike + own[:1]), path)
        docs = {r.doc_id: r.game_name for r in serve.read_serving(spark, path).collect()}
        assert (meta["indexed_count"], meta["collisions"], len(docs), asked) == (51, 3, 51, [5 if few else 54])
        assert docs["T_20240102_" + long.replace(" ", "_")[:30]] == long + "A"        # the last source wins
        assert serve.read_serving(spark, path).count() == 51
