"""Cross-validation, scoring and serving over many rows: each distinct row is scored once, nothing is written twice."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from popcorr import catalog
from popcorr.operators import boosting as B
from popcorr.operators import metrics, model, serve
from popcorr.operators.rank import rank_within
from popcorr.session import COMPILED_BYTES, compiled, cut_lineage

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _usage(spark, n=240):
    """``n`` rows of 4 x 3 distinct features over 40 days."""
    features = [((F.col("id") % 4).cast("double") if i % 2 else (F.col("id") % 3).cast("double")).alias(c)
                for i, c in enumerate(model.FEATURES) if c != "source_is_twitch"]
    return spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"), F.col("id").cast("string").alias("game_name"),
        F.when(F.col("id") % 2 == 0, "steam").otherwise("twitch").alias("source"), F.lit("x" * 20).alias("unused"),
        F.element_at(F.array(F.lit("NEUTRAL"), F.lit("STRONG_POSITIVE"), F.lit("WEAK_NEGATIVE")), (F.col("id") % 3 + 1).cast("int")).alias("signal"), *features)


def _spied(monkeypatch, *modules):
    """(name, columns, rows) of what ``cut_lineage`` of these modules writes."""
    seen = []

    def cut(df, name="cut"):
        out = cut_lineage(df, name)
        seen.append((name, df.columns, out.count()))
        return out

    for m in modules:
        monkeypatch.setattr(m, "cut_lineage", cut)
    return seen


def test_cross_validation_writes_only_what_it_needs_and_counts_pairs(spark, monkeypatch):
    """all columns were shuffled and written for the folds, and every held-out row as a row of its own."""
    from popcorr.operators import rank
    seen, cfg = _spied(monkeypatch, model, rank), model.ModelConfig(trees=2)
    got = model.cross_validate(_usage(spark), ["date", "game_name"], cfg).orderBy("fold").collect()
    written = {name: (columns, n) for name, columns, n in seen}
    assert "unused" not in written["cut"][0] and written["cv_held_out"][1] <= 5 * 9
    assert set(written["rank_within"][0]) == {*model.FEATURES, "signal", "_pid", "_mid"}
    # the same as from the rows themselves
    train = model.training_rows(cut_lineage(model.feature_matrix(_usage(spark))))
    folded = cut_lineage(model.fold_assignment(train, 5, ["date", "game_name"]))
    assert folded.columns == [*train.columns, "fold"]
    told = B.held_out(model.boost(folded, cfg, "fold", 5)[1], model.boost(folded, cfg, "fold", 5)[0])
    assert told.count() == train.count()
    want = [metrics.classification_scores(told.where(F.col("fold") == f), "actual", "predicted").first() for f in range(5)]
    assert [tuple(r)[1:] for r in got] == [tuple(w) for w in want]


def test_ranks_of_some_columns(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 50).alias("o"), F.col("id").alias("v"))
    all_ = rank_within(df, "g", ["o"])
    some = rank_within(df, "g", ["o"], columns=["g", "v"])
    assert some.columns == ["g", "v", "pos"]
    assert sorted(map(tuple, some.collect())) == sorted((r.g, r.v, r.pos) for r in all_.collect())


def _booster(f, rng):
    out = B.empty_booster([f"f{i}" for i in range(f)], list("xyz"), [[0.0, 1.0]] * f, 4, 3, 1)
    out.feature[...], out.cut[...] = rng.integers(0, f, out.feature.shape), rng.integers(0, 2, out.cut.shape)
    out.value[...] = rng.normal(size=out.value.shape)
    return out


@pytest.mark.parametrize("f", (4, 14))
def test_equal_rows_are_scored_once(f, monkeypatch):
    """all trees were walked for every row."""
    rng, sizes, of = np.random.default_rng(3), [], B.margins
    booster, values = _booster(f, rng), list(rng.integers(-1, 3, (f, 5000)).astype(float))
    p = B.softmax(B.margins(B.to_bins(values, booster.cuts), booster.feature, booster.cut, booster.value)[0])
    monkeypatch.setattr(B, "margins", lambda bins, *x: sizes.append(bins.shape[1]) or of(bins, *x))
    best, probability = booster.scores(values)
    assert (best == p.argmax(0)).all() and (probability == p.max(0)).all()
    assert sizes == [3 ** f if f == 4 else 5000]                      # bins of 14 features do not fit one number
    assert [len(x) for x in booster.scores([v[:0] for v in values])] == [0, 0]


def test_predicted_labels(spark):
    booster = _booster(4, np.random.default_rng(1))
    df = spark.range(40).select("id", *[(F.col("id") % (i + 2) - 1).cast("double").alias(f"f{i}") for i in range(4)])
    rows = B.predict(df, booster).orderBy("id").collect()
    best, p = booster.scores([np.array([r[f"f{i}"] for r in rows]) for i in range(4)])
    assert [r["_class"] for r in rows] == [booster.labels[b] for b in best] and [r["_probability"] for r in rows] == p.tolist()


def test_scored_rows_are_written_once(spark, monkeypatch):
    """the scored rows were written again with the metrics, which are constants."""
    seen = _spied(monkeypatch, catalog, model)
    monkeypatch.setattr(catalog, "usage_core", lambda spark, sf: _usage(spark))
    monkeypatch.setattr(catalog, "MODEL_CFG", model.ModelConfig(trees=2))
    monkeypatch.setattr(catalog, "_TRAINED", {})
    monkeypatch.setattr(catalog, "listing", lambda spark, path: path)
    scored, _ = catalog.trained(spark, "/nowhere")
    assert scored.count() == 240 and scored.select(*model.METRIC_COLUMNS.values()).distinct().count() == 1
    assert [n for name, _, n in seen if n == 240] == [240, 240]       # feature matrix, scored rows


def test_wide_rows_are_written_by_compiled_code(spark, tmp_dir, monkeypatch):
    """the serving cast of modelled usage made one method too long for the JVM to compile."""
    before, seen = spark.conf.get(LIMIT), []
    with compiled(spark):
        assert spark.conf.get(LIMIT) == str(COMPILED_BYTES)
    assert spark.conf.get(LIMIT) == before
    frame = type(spark.range(1))
    write = frame.write
    monkeypatch.setattr(frame, "write", property(lambda self: seen.append((len(self.columns), spark.conf.get(LIMIT))) or write.fget(self)))
    usage = spark.createDataFrame([("2024-01-02", "G", "T", "steam", 1)], "date string, game_name string, ticker string, source string, twitch_rank long")
    serve.full_refresh(usage, os.path.join(tmp_dir, "serving"))
    assert max(seen)[1] == str(COMPILED_BYTES) and spark.conf.get(LIMIT) == before
