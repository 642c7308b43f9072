import datetime as dt

from pyspark.sql import functions as F

from popcorr.operators import expand
from popcorr.operators.resolve import resolve_ticker
from popcorr.plans import combine
from popcorr.sources import schemas, testbed


def test_first_match_resolution(spark):
    games = spark.createDataFrame([
        ("g1", "Brand#1", "X"),        # exact
        ("g2", "Brand#12", "X"),       # partial, first ordinal (Brand#1)
        ("g3", "Brand#17", "X"),       # exact beats ordinal 0
        ("g4", "Brand#15", "X"),       # exact is case-sensitive -> partial ordinal 0
        ("g5", "Brand#14", "X"),       # exact hit has NULL ticker -> partial ordinal 0
        ("g6", "Brand#3", "ECONOMY"),  # partial hit with NULL ticker; developer not tried
        ("g7", "Brand#4", "ECONOMY"),  # no publisher hit -> developer
        ("g8", "", "PROMO"),           # blank publisher skipped; name inside key
        ("g9", "Brand#6", "LARGE"),    # no hit at all
        ("g10", None, None),
    ], "name string, publisher string, developer string")
    out = {r.name: r.ticker for r in resolve_ticker(games, testbed.publisher_map(spark)).collect()}
    assert out == {"g1": "click", "g2": "click", "g3": "error", "g4": "click", "g5": "click",
                   "g6": None, "g7": "error", "g8": "signup", "g9": None, "g10": None}


def _games(spark, rows):
    return spark.createDataFrame(
        [(i + 1, n, t, 101 - (i + 1)) for i, (n, t) in enumerate(rows)],
        "rank int, name string, ticker string, rank_score int")


def test_expansion_counts_and_unmatched(spark):
    d0 = dt.date(2024, 1, 1)
    cal = spark.createDataFrame([("A", d0 + dt.timedelta(i)) for i in range(5)]
                                + [("B", d0 + dt.timedelta(i)) for i in range(3)], "ticker string, date date")
    games = _games(spark, [("a1", "A"), ("a2", "A"), ("b1", "B"), ("z", "Z"), ("u", "UNKNOWN")])
    out = expand.expand_snapshot(games.withColumn("date", F.lit(None).cast("date")), cal)
    counts = {r.name: r["count"] for r in out.groupBy("name").count().collect()}
    assert counts == {"a1": 5, "a2": 5, "b1": 3}            # sum games x dates(ticker)
    blocking = {r.name_key for r in expand.covered_names(games, cal).collect()}
    assert blocking == {"a1", "a2", "b1"}                   # decided after expansion


def test_nothing_expanded_blocks_all_names(spark):
    cal = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "ticker string, date date")
    games = _games(spark, [("X1", "Z"), ("x2", "UNKNOWN")])
    blocking = {r.name_key for r in expand.covered_names(games, cal).collect()}
    assert blocking == {"x1", "x2"}


def test_stream_only_candidates(spark):
    streams = spark.createDataFrame([
        (1, "  HALF LIFE ", 10), (2, "", 5), (3, "   ", 5), (4, None, 1), (5, "A1", 3), (6, "Unknown Game", 7)],
        "rank int, game_name string, top_stream_viewers long")
    blocking = spark.createDataFrame([("a1",)], "name_key string")
    got = {r.rank: r.name_key for r in expand.stream_only_candidates(streams, blocking).collect()}
    assert got == {1: "half life", 6: "unknown game"}


def test_unknown_ticker_game_returns_through_stream_path(spark):
    d0 = dt.date(2024, 1, 1)
    bars = spark.createDataFrame(
        [("A", d0 + dt.timedelta(i), 10.0, 11.0, 9.0, 10.0 + i, 100, float(i), 2.0, 20.0) for i in range(4)],
        schemas.BARS_FORMATTED)
    games = spark.createDataFrame(
        [(1, "1", "Known", "d", "p", 1, 1, "", 1, 1, 1, 0.0, "A", None, d0, 0.5, 100),
         (2, "2", "Lost Game", "d", "p", 1, 1, "", 1, 1, 1, 0.0, "UNKNOWN", None, d0, 0.5, 99)],
        schemas.STEAM_FORMATTED)
    streams = spark.createDataFrame(
        [(1, "s1", "LOST GAME", "", 50, None, d0, 100, 1.0),
         (2, "s2", "known", "", 70, None, d0, 99, 1.0),
         (3, "s3", "KNOWN", "", 80, None, d0, 98, 1.0)],
        schemas.TWITCH_FORMATTED)
    smap = spark.createDataFrame([("lost game", "A"), ("known", "A")], schemas.STREAM_MAP)
    u = combine.joined(games, bars, streams, smap, jitter=False).collect()
    steam = [r for r in u if r.source == "steam"]
    tw = [r for r in u if r.source == "twitch"]
    # duplicate case-folded stream names fan the snapshot rows out (2 x 4 dates)
    assert len(steam) == 8 and {r.twitch_rank for r in steam} == {2, 3}
    # the UNKNOWN-ticker game vanished from the expansion, so it re-enters as stream-only
    assert len(tw) == 4 and {r.game_name for r in tw} == {"LOST GAME"}


def test_missing_stream_defaults(spark):
    d0 = dt.date(2024, 1, 1)
    bars = spark.createDataFrame([("A", d0, 10.0, 11.0, 9.0, 10.0, 100, 0.0, 2.0, 20.0)], schemas.BARS_FORMATTED)
    games = spark.createDataFrame(
        [(1, "1", "Solo", "d", "p", 0, 0, "", 1, 1, 1, 0.0, "A", None, d0, None, 100)], schemas.STEAM_FORMATTED)
    smap = spark.createDataFrame([], schemas.STREAM_MAP)
    r = combine.joined(games, bars, None, smap, jitter=False).first()
    assert (r.twitch_viewers, r.twitch_rank, r.twitch_rank_score, r.review_ratio) == (0, 999, 0.0, 0.0)


def test_history_mode_uses_real_scores(spark):
    d0 = dt.date(2024, 1, 1)
    bars = spark.createDataFrame(
        [("A", d0 + dt.timedelta(i), 10.0, 11.0, 9.0, 10.0 + i % 3, 100 + i, float(i % 3), 2.0, 20.0)
         for i in range(10)], schemas.BARS_FORMATTED)

    def snap(day, rank, run):
        return (rank, "1", "Game", "d", "p", 1, 1, "", 1, 1, 1, 0.0, "A", None, day, 0.5, 101 - rank, run)

    hist = spark.createDataFrame(
        [snap(d0 + dt.timedelta(2), 5, "20240103"), snap(d0 + dt.timedelta(5), 20, "20240106"),
         snap(d0 + dt.timedelta(9), 1, "20240110")],
        schemas.STEAM_FORMATTED.add("run_date", "string"))
    smap = spark.createDataFrame([], schemas.STREAM_MAP)
    out = {r.date: r.steam_rank_score for r in
           combine.combine_history(hist, bars, None, smap, "20240110").collect()}
    assert len(out) == 10
    assert out[d0 + dt.timedelta(2)] == 96.0 and out[d0 + dt.timedelta(5)] == 81.0
    assert out[d0 + dt.timedelta(9)] == 100.0
    # other days carry the run's snapshot with its deterministic jitter around 100
    others = [v for d, v in out.items() if d not in (d0 + dt.timedelta(2), d0 + dt.timedelta(5))]
    assert all(70.0 < v < 130.0 for v in others)


def test_unresolved_tickers(spark):
    cal = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "ticker string, date date")
    pub = spark.createDataFrame([(0, "x", "A"), (1, "y", "GONE"), (2, "z", None)], schemas.PUBLISHER_MAP)
    smap = spark.createDataFrame([("n", "A"), ("m", "LOST")], schemas.STREAM_MAP)
    got = sorted(tuple(r) for r in expand.unresolved_tickers(cal, publisher_map=pub, stream_map=smap).collect())
    assert got == [("publisher_map", "GONE"), ("stream_map", "LOST")]
