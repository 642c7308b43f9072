import pytest
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.operators import metrics, model
from popcorr.operators.rank import rank_within

CLASSES = ["NEUTRAL", "STRONG_NEGATIVE", "STRONG_POSITIVE", "WEAK_NEGATIVE", "WEAK_POSITIVE"]
# Golden 5x5 confusion matrix (rows = true, columns = predicted, alphabetical order).
GOLDEN = [
    [73, 0, 0, 1, 0],
    [0, 21, 0, 0, 0],
    [0, 0, 21, 0, 0],
    [1, 0, 0, 81, 2],
    [1, 0, 0, 1, 78],
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = []
    for i, a in enumerate(CLASSES):
        for j, p in enumerate(CLASSES):
            rows += [(a, p)] * GOLDEN[i][j]
    return spark.createDataFrame(rows, "signal string, pred string")


def test_golden_scores(golden):
    s = metrics.classification_scores(golden, "signal", "pred").first()
    assert (s.accuracy, s.f1_weighted, s.f1_macro, s.precision_weighted, s.recall_weighted) == \
        (0.9786, 0.9786, 0.985, 0.9786, 0.9786)


def test_golden_report(golden):
    rep = {r.label: r for r in metrics.classification_report(golden, "signal", "pred").collect()}
    assert [rep[c].support for c in CLASSES] == [74, 21, 21, 84, 80]
    # the published per-class report (2 places)
    assert [round(rep[c].precision, 2) for c in CLASSES] == [0.97, 1.0, 1.0, 0.98, 0.97]
    assert [round(rep[c].recall, 2) for c in CLASSES] == [0.99, 1.0, 1.0, 0.96, 0.97]
    assert [round(rep[c].f1, 2) for c in CLASSES] == [0.98, 1.0, 1.0, 0.97, 0.97]
    w = rep["weighted avg"]
    assert w.support == 280 and (round(w.precision, 2), round(w.recall, 2), round(w.f1, 2)) == (0.98, 0.98, 0.98)


def test_golden_confusion_matrix(golden):
    cm = {r.actual: [r[c] for c in CLASSES]
          for r in metrics.confusion_matrix(golden, "signal", "pred", CLASSES).collect()}
    assert [cm[c] for c in CLASSES] == GOLDEN


def test_class_only_predicted_counts_in_macro(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B")], "y string, p string")
    s = metrics.classification_scores(df, "y", "p").first()
    # labels {A, B}: F1(A) = 2/3, F1(B) = 0 -> macro 1/3
    assert s.f1_macro == round(1 / 3, 4) and s.accuracy == 0.5


def test_rank_within_matches_row_number(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("g"),
                                  F.md5(F.col("id").cast("string")).alias("h"))
    # one hot group with most rows
    df = df.withColumn("g", F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("g")))
    got = {r.id: r.pos for r in rank_within(df, "g", ["h", "id"], num_partitions=7).collect()}
    exp = {}
    for g in set(r.g for r in df.collect()):
        ids = sorted([(r.h, r.id) for r in df.where(F.col("g") == g).collect()])
        exp.update({i: pos for pos, (_, i) in enumerate(ids)})
    assert got == exp


@pytest.mark.parametrize("sizes,k", [({"A": 1, "B": 9}, 1), ({"A": 2, "B": 9}, 2), ({"A": 7, "B": 9}, 5)])
def test_folds_are_stratified(spark, sizes, k):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, signal string")
    assert model.n_folds(df) == k
    if k < 2:
        return
    out = model.fold_assignment(df, k, ["id"]).groupBy("signal", "fold").count().collect()
    for c, n in sizes.items():
        per = [r["count"] for r in out if r.signal == c]
        assert sum(per) == n and max(per) - min(per) <= 1


def _usage(spark, n):
    import datetime as dt
    rows = []
    for i in range(n):
        sig = kpi.SIGNAL_CLASSES[i % 5]
        rows.append((dt.date(2024, 1, 1 + i % 28), f"g{i % 7}", "T", "steam", i % 50, float(i % 9),
                     float(i % 5), i, i % 3, i % 11, float(i % 4), float(i % 6), 100 + i, sig))
    return spark.createDataFrame(rows, "date date, game_name string, ticker string, source string, "
                                       "twitch_rank long, popularity_score double, steam_rank_score double, "
                                       "twitch_viewers long, peak_ccu long, avg_playtime_2weeks long, "
                                       "daily_change_pct double, daily_range_pct double, stock_volume long, "
                                       "signal string").withColumn("twitch_rank_score", F.lit(1.0)) \
        .withColumn("source_is_twitch", F.lit(0))


def test_fallback_below_ten_training_rows(spark):
    out = model.train_and_score(_usage(spark, 9), model.ModelConfig(trees=2)).collect()
    assert len(out) == 9
    assert all(r.ml_prediction == "NEUTRAL" and r.ml_confidence == 0.0 and r.ml_accuracy is None for r in out)


def test_train_and_score_ten_rows(spark):
    out = model.train_and_score(_usage(spark, 10), model.ModelConfig(trees=2)).collect()
    assert len(out) == 10                       # 10 training rows: the model trains
    assert out[0].ml_accuracy is not None
    out = model.train_and_score(_usage(spark, 40), model.ModelConfig(trees=2)).collect()
    assert len(out) == 40
    assert all(r.ml_prediction in kpi.SIGNAL_CLASSES for r in out)
    assert all(0.0 < r.ml_confidence <= 1.0 for r in out)
    assert len({r.ml_accuracy for r in out}) == 1 and 0.0 <= out[0].ml_accuracy <= 1.0


def test_random_forest_variant(spark):
    out = model.train_and_score(_usage(spark, 40), model.ModelConfig(estimator="rf", trees=5)).collect()
    assert all(r.ml_prediction in kpi.SIGNAL_CLASSES and 0.0 < r.ml_confidence <= 1.0 for r in out)
