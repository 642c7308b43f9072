"""Signal classifier as distributed MLlib steps.

M1 feature matrix (10 features, fixed order, NULL -> 0) via VectorAssembler
M2 label index, alphabetical (StringIndexer alphabetAsc)
M3 multi-class boosted trees: one softmax booster on feature histograms
   (``operators.boosting``); RandomForestClassifier is MLlib's multi-class alternative
M4 score every row: predicted label, confidence = max class probability
M5 stratified k folds, k = min(5, smallest class), only when k >= 2
M6 training-set metrics repeated on every row
M7 fallback: fewer than 10 training rows -> NEUTRAL, confidence 0, NULL metrics
M8 feature importances (mean gain of a feature's splits, as a share)

All classes and, in cross-validation, all folds are boosted in the same jobs;
the driver holds trees, histograms of fixed size and one-row metric aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.operators import boosting, metrics, prep
from popcorr.operators.rank import rank_within
from popcorr.session import compiled, cut_lineage, release

# ── fixed values ─────────────────────────────────────────────────────────────
FEATURES = [
    "popularity_score",
    "steam_rank_score",
    "twitch_rank_score",
    "twitch_viewers",
    "peak_ccu",
    "avg_playtime_2weeks",
    "daily_change_pct",
    "daily_range_pct",
    "stock_volume",
    "source_is_twitch",
]
LABEL = "signal"
TRAIN_DAYS = 30
MIN_TRAIN_ROWS = 10
MAX_FOLDS = 5
SEED = 42
DEFAULT_TREES = 150          # boosting rounds of the reference model
LEARNING_RATE = 0.1
MAX_DEPTH = 3
METRIC_COLUMNS = {"accuracy": "ml_accuracy", "f1_weighted": "ml_f1_weighted",
                  "f1_macro": "ml_f1_macro", "precision_weighted": "ml_precision",
                  "recall_weighted": "ml_recall"}


@dataclass
class ModelConfig:
    estimator: str = "gbt"      # "gbt" (boosted trees) or "rf"
    trees: int = DEFAULT_TREES
    learning_rate: float = LEARNING_RATE
    max_depth: int = MAX_DEPTH
    seed: int = SEED


def feature_matrix(df: DataFrame) -> DataFrame:
    """The 10 feature columns as doubles, NULL -> 0 (plus every other column)."""
    if "source_is_twitch" not in df.columns:
        df = df.withColumn("source_is_twitch", (F.col("source") == "twitch").cast("int"))
    return df.select(*[c for c in df.columns if c not in FEATURES],
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])


def label_index(train: DataFrame, label: str = LABEL) -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc",
                         handleInvalid="keep")


def boost(train: DataFrame, cfg: ModelConfig, fold: str | None = None, k: int = 1) -> tuple[boosting.Booster, DataFrame]:
    """The boosted trees of the feature-matrix rows of ``train`` and their training blocks.

    With a ``fold`` column, ``k`` models, each without its own fold.  Rows are reduced to features, label and fold.
    """
    labels = sorted(r[0] for r in train.select(LABEL).distinct().collect())            # the five signals
    number = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(LABEL)) - 1
    rows = train.select(*FEATURES, number.alias("_label"), (F.col(fold) if fold else F.lit(boosting.ALL_LEFT)).alias("_fold"))
    return boosting.train(rows, FEATURES, labels, cfg.trees, cfg.learning_rate, cfg.max_depth, k)


def fit(train: DataFrame, cfg: ModelConfig):
    """The trained booster, or the pipeline of the MLlib alternative (its training rows cached for the fit)."""
    if cfg.estimator != "rf":
        booster, trained = boost(train, cfg)
        release(trained)
        return booster
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=cfg.trees, maxDepth=cfg.max_depth, seed=cfg.seed)
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[label_index(train), VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(cached)
    finally:
        cached.unpersist()


def predict(model, df: DataFrame) -> DataFrame:
    """Adds ``ml_prediction`` and ``ml_confidence`` (max class probability, 4 places)."""
    if isinstance(model, boosting.Booster):
        out = boosting.predict(df, model)
        return (out.withColumn("ml_prediction", F.col("_class")).withColumn("ml_confidence", F.round("_probability", 4))
                   .drop("_class", "_probability"))
    out = model.transform(df)
    out = IndexToString(inputCol="prediction", outputCol="ml_prediction", labels=list(model.stages[0].labels)).transform(out)
    return (out.withColumn("ml_confidence", F.round(F.array_max(vector_to_array("probability")), 4))
               .drop("features", "rawPrediction", "probability", "prediction", "label"))


def training_rows(usage: DataFrame, days: int = TRAIN_DAYS) -> DataFrame:
    return prep.trailing_window(usage, days)


def fallback(df: DataFrame) -> DataFrame:
    """Too few training rows: NEUTRAL, confidence 0.0, metrics NULL."""
    out = (df.withColumn("ml_prediction", F.lit(kpi.SIGNAL_UNDEFINED))
             .withColumn("ml_confidence", F.lit(0.0)))
    for c in METRIC_COLUMNS.values():
        out = out.withColumn(c, F.lit(None).cast("double"))
    return out


def train_and_score(usage: DataFrame, cfg: ModelConfig | None = None) -> DataFrame:
    """Train on the trailing window, score every row, attach training metrics.

    Every row is scored once (materialised as a written table); the training
    metrics are then aggregates over the scored rows of the training window,
    not a second prediction pass.
    """
    return fit_and_score(usage, cfg)[0]


def fit_and_score(usage: DataFrame, cfg: ModelConfig | None = None):
    """(``train_and_score`` rows, a written table with the metrics as constants; the fitted model or None for the fallback)."""
    cfg = cfg or ModelConfig()
    # fit, training-set scoring and full scoring all read it: materialise it
    # once (a written table in the shared folder, nothing pinned in memory)
    with compiled(usage.sparkSession):
        fm = cut_lineage(feature_matrix(usage))
    cutoff = training_cutoff(fm)
    train = fm.where(F.col("date") >= F.lit(cutoff)) if cutoff is not None else fm.limit(0)
    if train.limit(MIN_TRAIN_ROWS).count() < MIN_TRAIN_ROWS:
        return fallback(fm), None
    model = fit(train, cfg)
    scored = cut_lineage(predict(model, fm))
    in_train = scored.where(F.col("date") >= F.lit(cutoff))
    scores = metrics.classification_scores(in_train, LABEL, "ml_prediction").first()
    for k, c in METRIC_COLUMNS.items():
        scored = scored.withColumn(c, F.lit(scores[k]).cast("double"))
    return scored, model


def training_cutoff(df: DataFrame, days: int = TRAIN_DAYS):
    """First date of the trailing training window (one-row aggregate)."""
    import datetime as _dt
    m = prep.latest_date(df)
    return None if m is None else m - _dt.timedelta(days=days - 1)


def fold_assignment(train: DataFrame, k: int, id_cols: list[str], seed: int = SEED,
                    label: str = LABEL, columns: list[str] | None = None) -> DataFrame:
    """fold = (position inside the class under md5(id|seed), id) mod k; of ``train`` only ``columns``, if given, are written."""
    key = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))
    ranked = rank_within(train.withColumn("_h", key), label, ["_h", *id_cols], out="_pos", columns=columns or train.columns)
    return ranked.withColumn("fold", (F.col("_pos") % k).cast("int")).drop("_pos")


def n_folds(train: DataFrame, label: str = LABEL) -> int:
    smallest = train.groupBy(label).count().agg(F.min("count")).first()[0]
    return min(MAX_FOLDS, int(smallest or 0))


def cross_validate(usage: DataFrame, id_cols: list[str], cfg: ModelConfig | None = None) -> DataFrame:
    """Per-fold scores (fold, accuracy, f1_weighted, f1_macro, precision_weighted, recall_weighted)."""
    cfg = cfg or ModelConfig()
    spark = usage.sparkSession
    needed = list(dict.fromkeys([*id_cols, "date", LABEL, *FEATURES]))
    with compiled(spark):
        train = training_rows(cut_lineage(feature_matrix(usage).select(*needed)))
    k = n_folds(train)
    schema = "fold int, accuracy double, f1_weighted double, f1_macro double, " \
             "precision_weighted double, recall_weighted double"
    if k < 2:
        return spark.createDataFrame([], schema)
    folded = cut_lineage(fold_assignment(train, k, id_cols, columns=[*FEATURES, LABEL]), "cv_folds")
    if cfg.estimator != "rf":
        booster, trained = boost(folded, cfg, "fold", k)
        told, weight = cut_lineage(boosting.held_out(trained, booster, counts=True), "cv_held_out"), "n"
        release(trained)
    else:
        told = weight = None
        for f in range(k):
            own = predict(fit(folded.where(F.col("fold") != f), cfg), folded.where(F.col("fold") == f))
            own = own.select("fold", F.col(LABEL).alias("actual"), F.col("ml_prediction").alias("predicted"))
            told = own if told is None else told.unionByName(own)
        told = cut_lineage(told, "cv_held_out")
    scores = [(f, metrics.classification_scores(told.where(F.col("fold") == f), "actual", "predicted", weight=weight).first()) for f in range(k)]
    return spark.createDataFrame([(f, *[float(s[m]) for m in METRIC_COLUMNS]) for f, s in scores], schema)


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population std per metric."""
    return folds.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in METRIC_COLUMNS])).alias("x")) \
        .groupBy(F.col("x.metric").alias("metric")) \
        .agg(F.round(F.avg("x.v"), 4).alias("mean"), F.round(F.stddev_pop("x.v"), 4).alias("std"))


def feature_importance(usage: DataFrame, cfg: ModelConfig | None = None) -> DataFrame:
    """Importance per feature of the model of the training window."""
    cfg = cfg or ModelConfig()
    train = training_rows(cut_lineage(feature_matrix(usage)))
    return usage.sparkSession.createDataFrame(importances(fit(train, cfg)), "feature string, importance double")


def importances(fitted) -> list[tuple[str, float]]:
    """(feature, importance) of a fitted model, in feature order."""
    if isinstance(fitted, boosting.Booster):
        return fitted.importances()
    return [(name, round(float(fitted.stages[-1].featureImportances[i]), 4)) for i, name in enumerate(FEATURES)]
