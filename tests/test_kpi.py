import math

from pyspark.sql import functions as F

from popcorr.functions import kpi


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_signal_ladder_boundaries(spark):
    vals = [0.5, 0.499999, 0.2, -0.2, -0.200001, -0.5, -0.500001, None, float("nan"), 1.0, -1.0]
    got = _one(spark, [(v,) for v in vals], "r double", kpi.signal_label("r"))
    assert got == ["STRONG_POSITIVE", "WEAK_POSITIVE", "WEAK_POSITIVE", "NEUTRAL", "WEAK_NEGATIVE",
                   "WEAK_NEGATIVE", "STRONG_NEGATIVE", "NEUTRAL", "NEUTRAL", "STRONG_POSITIVE",
                   "STRONG_NEGATIVE"]


def test_daily_change_guard(spark):
    rows = [(0.0, 5.0), (None, 5.0), (-1.0, 5.0), (10.0, 11.0)]
    got = _one(spark, rows, "open double, close double", kpi.daily_change_pct())
    assert got == [None, None, None, 10.0]


def test_range_pct_uses_rounded_range(spark):
    df = spark.createDataFrame([(3.0, 1.123456789, 1.0)], "open double, high double, low double")
    r = df.select(kpi.daily_range("high", "low").alias("rng"), "open") \
          .select("rng", kpi.daily_range_pct("rng", "open").alias("pct")).first()
    assert r.rng == 0.1235
    assert r.pct == round(0.1235 / 3.0 * 100, 4)


def test_review_ratio_and_rank_score(spark):
    df = spark.createDataFrame([(0, 0, 1), (3, 1, 101), (1, 0, 300)], "p long, n long, rank int")
    got = df.select(kpi.review_ratio("p", "n"), kpi.rank_score("rank")).collect()
    assert [tuple(r) for r in got] == [(None, 100), (0.75, 0), (1.0, -199)]


def test_log_viewers(spark):
    got = _one(spark, [(None,), (0,), (1,), (100,)], "v long", kpi.log_viewers("v"))
    assert got[:3] == [0.0, 0.0, 0.0]
    assert abs(got[3] - math.log(100)) < 1e-12


def test_clean_numeric(spark):
    vals = [float("nan"), float("inf"), float("-inf"), None, 0.0, 2.5]
    got = _one(spark, [(v,) for v in vals], "x double", kpi.clean_numeric("x"))
    assert got == [None, None, None, None, 0.0, 2.5]


def test_doc_id_rules(spark):
    rows = [(None, "2024-01-05", "Half Life"),
            ("TT WO", "2024-01-05", "a b c"),
            ("X", "2024-01-05", "A" * 28 + " B" + "C" * 10)]
    got = _one(spark, rows, "ticker string, date string, game_name string", kpi.doc_id())
    assert got[0] == "UNKNOWN_20240105_Half_Life"
    assert got[1] == "TT_WO_20240105_a_b_c"
    # blanks are replaced first, then the game part is cut to 30 characters
    assert got[2] == "X_20240105_" + ("A" * 28 + "_B")


def test_change_pct(spark):
    rows = [(10.0, 0.0), (0.0, 10.0), (None, 10.0), (10.0, None), (11.0, 10.0)]
    got = _one(spark, rows, "p double, q double", kpi.change_pct("p", "q"))
    assert got == [None, None, None, None, 10.0]


def test_jitter_is_deterministic_and_bounded(spark):
    df = spark.range(2000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("n"),
                                  F.lit("T").alias("t"), F.lit("2024-01-02").cast("date").alias("d"))
    z = df.select(kpi.gaussian(F.col("n"), F.col("t"), F.col("d"), "s").alias("z"))
    a = [r.z for r in z.collect()]
    b = [r.z for r in z.repartition(7).sortWithinPartitions("z").collect()]
    assert sorted(a) == sorted(b)
    mean = sum(a) / len(a)
    var = sum((x - mean) ** 2 for x in a) / len(a)
    assert abs(mean) < 0.1 and 0.85 < var < 1.15
    floor = df.select(kpi.jitter_snapshot_score(F.lit(1), F.lit(-50.0)).alias("s")).first().s
    assert floor == 1.0
    v = df.select(kpi.jitter_viewers(F.lit(3).cast("long"), F.lit(-10.0)).alias("v")).first().v
    assert v == 0


def test_scale_settings():
    from popcorr.session import scale_settings
    small = scale_settings(10 * 1024 ** 2, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_settings(100 * 1024 ** 4, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
