import math

import numpy as np
from pyspark.sql import functions as F

from popcorr.functions.rolling import rolling_pearson, rows_window


def brute(xs, ys, rows=7):
    out = []
    for i in range(len(xs)):
        lo = max(0, i - rows + 1)
        pairs = [(x, y) for x, y in zip(xs[lo:i + 1], ys[lo:i + 1]) if x is not None and y is not None]
        if len(pairs) < 2:
            out.append(None)
            continue
        a = np.array([p[0] for p in pairs], float)
        b = np.array([p[1] for p in pairs], float)
        if a.min() == a.max() or b.min() == b.max():
            out.append(None)
            continue
        out.append(round(float(np.corrcoef(a, b)[0, 1]), 6))
    return out


def run(spark, groups):
    rows = [(g, i, x, y) for g, pts in groups.items() for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "g string, i int, x double, y double")
    w = rows_window(["g"], ["i"])
    got = df.select("g", "i", rolling_pearson("x", "y", w).alias("r")).collect()
    return {g: [r.r for r in sorted([r for r in got if r.g == g], key=lambda r: r.i)] for g in groups}


def test_edge_windows(spark):
    groups = {
        "one": [(1.0, 2.0)],
        "two": [(1.0, 2.0), (2.0, 1.0)],
        "eight": [(float(i), float(i * i % 5)) for i in range(8)],   # row 1 leaves the frame
        "flat_x": [(3.0, float(i)) for i in range(6)],
        "flat_y": [(float(i), 4.0) for i in range(6)],
        "nulls": [(1.0, 1.0), (None, 5.0), (2.0, 3.0), (3.0, None), (4.0, 2.0)],
    }
    got = run(spark, groups)
    for g, pts in groups.items():
        exp = brute([p[0] for p in pts], [p[1] for p in pts])
        assert got[g] == exp, g
    assert got["one"] == [None] and got["flat_x"] == [None] * 6
    assert got["two"][1] == -1.0


def test_random_against_brute_force(spark):
    rng = np.random.default_rng(7)
    groups = {f"g{k}": [(float(rng.integers(0, 5)), float(rng.normal())) for _ in range(int(rng.integers(1, 30)))]
              for k in range(20)}
    got = run(spark, groups)
    for g, pts in groups.items():
        exp = brute([p[0] for p in pts], [p[1] for p in pts])
        for a, b in zip(got[g], exp):
            assert (a is None and b is None) or abs(a - b) <= 1e-6, g


def test_result_in_unit_interval(spark):
    df = spark.range(500).select((F.col("id") % 13).alias("g"), F.col("id").alias("i"),
                                 F.rand(1).alias("x"), F.randn(2).alias("y"))
    w = rows_window(["g"], ["i"])
    rs = [r.r for r in df.select(rolling_pearson("x", "y", w).alias("r")).collect() if r.r is not None]
    assert rs and all(-1.0 <= r <= 1.0 and not math.isnan(r) for r in rs)


def test_frame_counts_rows_not_days(spark):
    # a gap in dates does not widen the frame: 7 rows, whatever the calendar
    rows = [("t", d, float(d % 3), float(d)) for d in [1, 2, 3, 10, 11, 12, 13, 40]]
    df = spark.createDataFrame(rows, "g string, d int, x double, y double")
    w = rows_window(["g"], ["d"])
    got = [r.r for r in df.select("d", rolling_pearson("x", "y", w).alias("r")).orderBy("d").collect()]
    assert got == brute([r[2] for r in rows], [r[3] for r in rows])


def test_duplicate_dates_are_ordered_by_tie_breaker(spark):
    from popcorr.operators.correlate import with_rolling_correlations
    rows = []
    for d in range(12):
        for src, rank in (("steam", 3), ("steam", 1), ("twitch", 2)):
            rows.append(("g", "T", d, src, rank, float((d * 7 + rank) % 5), float((d * 3 + rank) % 4),
                         rank * 10 + d))
    schema = ("game_name string, ticker string, date int, source string, twitch_rank long, "
              "popularity_score double, daily_change_pct double, twitch_viewers long")
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(list(reversed(rows)), schema).repartition(5)
    ra = sorted(tuple(r) for r in with_rolling_correlations(a).collect())
    rb = sorted(tuple(r) for r in with_rolling_correlations(b).collect())
    assert ra == rb


def test_chunked_correlations_equal_plain(spark):
    from popcorr.operators.correlate import with_rolling_correlations, with_rolling_correlations_chunked
    rows = []
    for g, n in (("hot", 90), ("small", 5), ("one", 1)):
        for d in range(n):
            for src, rank in (("steam", 3), ("steam", 1), ("twitch", 2)):
                rows.append((g, "T", d, src, rank, float((d * 7 + rank) % 5), float((d * 3 + rank) % 4),
                             rank * 10 + d))
    schema = ("game_name string, ticker string, date int, source string, twitch_rank long, "
              "popularity_score double, daily_change_pct double, twitch_viewers long")
    df = spark.createDataFrame(rows, schema)
    plain = sorted(tuple(r) for r in with_rolling_correlations(df).collect())
    for chunk in (4, 10, 25):
        got = sorted(tuple(r) for r in with_rolling_correlations_chunked(df, chunk).collect())
        assert got == plain, chunk
