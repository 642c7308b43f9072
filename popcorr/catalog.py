"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query derives its inputs from the driver tables of ``sf_dir`` (see
``popcorr.sources.testbed``), so its work grows with them.  Results go
through ``present``: dates and timestamps become fixed-format text so that
the Spark result and the DuckDB oracle compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from popcorr.functions import kpi
from popcorr.functions.rolling import rolling_pearson, rows_window
from popcorr.operators import correlate, expand, metrics, model, prep, serve
from popcorr.operators.joins import bounded_broadcast
from popcorr.plans import combine as cmb
from popcorr.plans import enrich, formats, inputs, layered
from popcorr.session import compiled, cut_lineage, listing, shared_dir, table_path
from popcorr.sources import layers, pages, schemas, testbed
from popcorr.streaming import live

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    """Dates are computed in UTC (the pipeline's convention)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ── slice 1: bars, activity correlation, labels ──────────────────────────────
@register("bars_format")
def q_bars_format(spark, sf):
    prepare(spark)
    return present(inputs.bars(spark, sf))


def activity_correlation(bars: DataFrame) -> DataFrame:
    """7-row r(volume, daily change) per ticker over trading days."""
    w = rows_window(["ticker"], ["date"])
    return bars.select(
        "ticker", "date", "volume", "daily_change_pct",
        rolling_pearson("volume", "daily_change_pct", w).alias("corr_7d_activity_price"))


@register("rolling_corr_activity")
def q_rolling_corr_activity(spark, sf):
    prepare(spark)
    return present(activity_correlation(inputs.bars(spark, sf)))


def activity_signals(spark, sf) -> DataFrame:
    return (activity_correlation(inputs.bars(spark, sf))
            .withColumn("signal", kpi.signal_label("corr_7d_activity_price")))


@register("signal_label")
def q_signal_label(spark, sf):
    prepare(spark)
    return present(activity_signals(spark, sf))


# ── slice 2: snapshots ───────────────────────────────────────────────────────
@register("steam_format")
def q_steam_format(spark, sf):
    prepare(spark)
    return present(inputs.games(spark, sf))


@register("twitch_format")
def q_twitch_format(spark, sf):
    """Formatted streams; ``log_viewers`` presented at 10 decimals (engines'
    natural logs may differ in the last bit of a double)."""
    prepare(spark)
    out = inputs.streams(spark, sf)
    return present(out.withColumn("log_viewers", F.round("log_viewers", 10)))


@register("ticker_resolution")
def q_ticker_resolution(spark, sf):
    prepare(spark)
    return inputs.raw_games(spark, sf).select("rank", "name", "publisher", "developer", "ticker")


@register("top_n_rank")
def q_top_n_rank(spark, sf):
    prepare(spark)
    g = inputs.raw_games(spark, sf, n=testbed.TOP_GAMES).select(
        F.lit("games").alias("list"), "rank", F.col("app_id").alias("id"),
        F.col("average_forever").alias("metric"))
    s = inputs.raw_streams(spark, sf, n=testbed.TOP_STREAMS).select(
        F.lit("streams").alias("list"), "rank", F.col("game_id").alias("id"),
        F.lit(None).cast("long").alias("metric"))
    return g.unionByName(s)


# ── slice 4: combine (over the materialised formatted layer) ──────────────
USAGE_CORE_COLUMNS = [*schemas.JOINED_COLUMNS, "popularity_score", "corr_7d_popularity_price",
                      "corr_7d_viewers_price", "signal", "source_is_twitch"]
ROW_KEY = ["date", "game_name", "ticker", "source", "twitch_rank"]


def usage_core(spark, sf, jitter: bool = True, streams_present: bool = True) -> DataFrame:
    return layered.usage_core(spark, sf, jitter=jitter, streams_present=streams_present)


def usage_reused(spark, sf, *columns: str) -> DataFrame:
    """Usage for queries that run several actions on it (a max date, class
    counts, then the result): written once as a reliable checkpoint in the
    shared folder instead of recomputing the combine per action.  Only
    ``columns``, if given, are shuffled and written."""
    usage = usage_core(spark, sf)
    return cut_lineage(usage.select(*columns) if columns else usage)


@register("combine_core")
def q_combine_core(spark, sf):
    prepare(spark)
    return present(usage_core(spark, sf).select(*USAGE_CORE_COLUMNS))


@register("popularity_score")
def q_popularity_score(spark, sf):
    prepare(spark)
    return present(usage_core(spark, sf).select(*ROW_KEY, "popularity_score"))


@register("rolling_corr_popularity")
def q_rolling_corr_popularity(spark, sf):
    prepare(spark)
    return present(usage_core(spark, sf).select(*ROW_KEY, "popularity_score", "daily_change_pct",
                                                "corr_7d_popularity_price"))


@register("rolling_corr_viewers")
def q_rolling_corr_viewers(spark, sf):
    prepare(spark)
    return present(usage_core(spark, sf).select(*ROW_KEY, "twitch_viewers", "daily_change_pct",
                                                "corr_7d_viewers_price"))


@register("signal_distribution")
def q_signal_distribution(spark, sf):
    prepare(spark)
    return usage_core(spark, sf).groupBy("signal").agg(F.count(F.lit(1)).alias("n"))


@register("union_sources")
def q_union_sources(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    return present(cmb.joined(f["games"], f["bars"], f["streams"], f["stream_map"]))


@register("optional_source_absent")
def q_optional_source_absent(spark, sf):
    """Streams missing: the optional source reads as an empty typed frame."""
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    missing = layers.layer_path(f["root"], "formatted", "twitch", "NotWritten")
    streams = layers.read_optional(spark, missing, schemas.TWITCH_FORMATTED)
    return present(cmb.combine(f["games"], f["bars"], streams, f["stream_map"])
                   .select(*USAGE_CORE_COLUMNS))


# ── joins and expansion ─────────────────────────────────────────────────────
@register("ticker_calendar")
def q_ticker_calendar(spark, sf):
    prepare(spark)
    return present(expand.ticker_calendar(inputs.bars(spark, sf)))


@register("expand_snapshot")
def q_expand_snapshot(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    cal = expand.ticker_calendar(f["bars"])
    return present(expand.expand_snapshot(f["games"], cal, jitter=False)
                   .select("name", "ticker", "date", "rank_score"))


@register("expand_snapshot_jitter")
def q_expand_snapshot_jitter(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    cal = expand.ticker_calendar(f["bars"])
    return present(expand.expand_snapshot(f["games"], cal, jitter=True)
                   .select("name", "ticker", "date", "rank_score"))


def _stream_only(f, jitter=True):
    cal = expand.ticker_calendar(f["bars"])
    blocking = expand.covered_names(f["games"], cal)
    cands = expand.stream_only_candidates(f["streams"], blocking)
    return cal, cands


@register("stream_only_candidates")
def q_stream_only_candidates(spark, sf):
    prepare(spark)
    _, cands = _stream_only(layered.formatted_inputs(spark, sf))
    return cands.select("rank", "game_name", "name_key")


@register("stream_ticker_lookup")
def q_stream_ticker_lookup(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    _, cands = _stream_only(f)
    return expand.stream_ticker_lookup(cands, f["stream_map"]).select("rank", "name_key", "ticker")


@register("expand_stream_only")
def q_expand_stream_only(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    cal, cands = _stream_only(f)
    mapped = expand.stream_ticker_lookup(cands, f["stream_map"])
    return present(expand.expand_stream_only(mapped, cal, jitter=True))


@register("join_stream_left")
def q_join_stream_left(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    return (correlate.join_stream_left(cmb.prep_snapshot(f["games"]), f["streams"])
            .select("name", "ticker", "twitch_viewers", "twitch_rank", "twitch_rank_score"))


@register("join_steam_bars")
def q_join_steam_bars(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    market = correlate.market_columns(cmb.prep_bars(f["bars"]))
    left = correlate.join_stream_left(cmb.prep_snapshot(f["games"]), f["streams"])
    return present(correlate.union_sources(correlate.snapshot_branch(left, market)))


@register("join_stream_only_bars")
def q_join_stream_only_bars(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    cal, cands = _stream_only(f)
    market = correlate.market_columns(cmb.prep_bars(f["bars"]))
    rows = expand.expand_stream_only(expand.stream_ticker_lookup(cands, f["stream_map"]), cal)
    return present(correlate.union_sources(correlate.stream_only_branch(rows, market)))


@register("filter_unknown")
def q_filter_unknown(spark, sf):
    prepare(spark)
    return expand.known_tickers(inputs.games(spark, sf)).select("rank", "name", "ticker")


@register("failed_tickers")
def q_failed_tickers(spark, sf):
    prepare(spark)
    return expand.failed_tickers(testbed.tracked(spark), inputs.bars(spark, sf))


@register("unresolved_report")
def q_unresolved_report(spark, sf):
    """Dimension tickers without any bar (games mapped to them vanish)."""
    prepare(spark)
    cal = expand.ticker_calendar(inputs.bars(spark, sf))
    return expand.unresolved_tickers(cal, publisher_map=testbed.publisher_map(spark),
                                     stream_map=inputs.stream_map(spark, sf), tracked=testbed.tracked(spark))


@register("top_stream_per_game")
def q_top_stream_per_game(spark, sf):
    prepare(spark)
    return enrich.top_stream_per_game(inputs.raw_streams(spark, sf),
                                      testbed.read(spark, sf, "lineitem"))


# ── projections / preparation ────────────────────────────────────────────────
def with_holes(raw_games: DataFrame) -> DataFrame:
    """Raw game records in which some keys are missing."""
    part = F.col("app_id").cast("long")
    return raw_games.withColumns({
        "developer": F.when(part % 7 != 0, F.col("developer")), "owners": F.when(part % 5 != 0, F.col("owners")),
        "positive": F.when(part % 9 != 0, F.col("positive"))})


@register("null_defaults")
def q_null_defaults(spark, sf):
    prepare(spark)
    stats = inputs.part_stats(spark, sf)
    s = formats.format_twitch(testbed.raw_streams(stats)).select(
        F.lit("streams").alias("list"), F.col("game_id").alias("id"), F.lit(None).cast("string").alias("developer"),
        F.lit(None).cast("string").alias("owners"), F.col("top_stream_viewers").alias("count_value"))
    g = formats.null_defaults_games(with_holes(testbed.raw_games(stats))).select(
        F.lit("games").alias("list"), F.col("app_id").alias("id"), "developer", "owners", F.col("positive").alias("count_value"))
    return s.unionByName(g)


@register("drop_bad_dates")
def q_drop_bad_dates(spark, sf):
    prepare(spark)
    ev = testbed.read(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("2024-01-"), F.lpad(F.get_json_object("props", "$.k"), 2, "0")).alias("date_text"))
    return present(prep.drop_bad_dates(ev, "date_text"))


@register("prep_zero_fill")
def q_prep_zero_fill(spark, sf):
    prepare(spark)
    return (prep.zero_fill(inputs.games(spark, sf))
            .select("rank", "name", "positive", "negative", "review_ratio", "price"))


@register("prep_all_null_text")
def q_prep_all_null_text(spark, sf):
    prepare(spark)
    raw = with_holes(testbed.raw_games(inputs.part_stats(spark, sf)))
    return prep.fill_all_null_text(raw).select("rank", "name", "developer", "owners", "ticker")


@register("prep_dates")
def q_prep_dates(spark, sf):
    prepare(spark)
    return prep.dates_as_text(inputs.games(spark, sf)).select("rank", "date", "extracted_at")


@register("clean_numeric")
def q_clean_numeric(spark, sf):
    prepare(spark)
    b = inputs.bars(spark, sf)
    grow = F.exp(F.col("volume") * F.lit(1000.0))          # overflows to +Inf
    mixed = F.when(F.col("volume") % 2 == 0, grow).otherwise(F.col("high"))
    raw = b.select("ticker", "date", grow.alias("x_pos"), (-grow).alias("x_neg"),
                   (grow - grow).alias("x_nan"), mixed.alias("x_mix"), F.col("close").alias("x_ok"))
    return present(prep.clean_all_numeric(raw))


@register("train_window_filter")
def q_train_window_filter(spark, sf):
    prepare(spark)
    return present(prep.trailing_window(usage_reused(spark, sf, *ROW_KEY, "signal"), 30).select(*ROW_KEY, "signal"))


@register("bars_history_window")
def q_bars_history_window(spark, sf):
    prepare(spark)
    return present(prep.history_window(inputs.bars(spark, sf), testbed.RUN_DATE, 365))


@register("bars_date_range")
def q_bars_date_range(spark, sf):
    prepare(spark)
    b = inputs.bars(spark, sf)
    return present(b.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                         F.countDistinct("ticker").alias("tickers"), F.count(F.lit(1)).alias("bars")))


@register("parse_timestamps")
def q_parse_timestamps(spark, sf):
    prepare(spark)
    ev = testbed.read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    kind = F.col("event_id") % 3
    text = (F.when(kind == 0, F.concat(F.date_format(F.col("t") + F.expr("INTERVAL 2 HOURS"),
                                                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")))
             .when(kind == 1, F.concat(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
             .otherwise(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return present(ev.select("event_id", text.alias("raw"))
                   .withColumn("parsed", kpi.parse_timestamp("raw")))


# ── serving ─────────────────────────────────────────────────────────────────
SERVE_STAMP = "2024-01-31 08:00:00"


@register("doc_id")
def q_doc_id(spark, sf):
    prepare(spark)
    return present(usage_core(spark, sf).select(
        kpi.doc_id("ticker", "date", "game_name").alias("doc_id"), "game_name", "ticker", "date"))


@register("serving_cast")
def q_serving_cast(spark, sf):
    prepare(spark)
    docs = serve.serving_cast(usage_core(spark, sf), indexed_at=SERVE_STAMP)
    return present(docs.select(*schemas.SERVING.names))


def _served(spark, sf):
    path = shared_dir(spark, "serving")
    meta = serve.full_refresh(usage_core(spark, sf), path, indexed_at=SERVE_STAMP)
    return serve.read_serving(spark, path), meta


@register("serving_full_refresh")
def q_serving_full_refresh(spark, sf):
    prepare(spark)
    docs, _ = _served(spark, sf)
    return present(docs)


@register("serving_count")
def q_serving_count(spark, sf):
    prepare(spark)
    docs, meta = _served(spark, sf)
    return docs.agg(F.count(F.lit(1)).alias("docs"), F.countDistinct("doc_id").alias("ids"),
                    F.lit(meta["collisions"]).cast("long").alias("collisions"))


SAMPLE_DOCS = 3


@register("serving_sample")
def q_serving_sample(spark, sf):
    """A sample of k documents (the limit is the feature), deterministic by id."""
    prepare(spark)
    docs, _ = _served(spark, sf)
    return present(docs.orderBy("doc_id").limit(SAMPLE_DOCS)
                   .select("doc_id", "date", "game_name", "ticker", "signal"))


@register("usage_summary")
def q_usage_summary(spark, sf):
    prepare(spark)
    u = usage_core(spark, sf)
    return u.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("ticker").alias("tickers"),
                 F.countDistinct("game_name").alias("games"),
                 F.countDistinct(kpi.doc_id("ticker", "date", "game_name")).alias("doc_ids"))


# ── evaluation over (signal, viewers signal) ─────────────────────────────────
def _labelled_pairs(spark, sf) -> DataFrame:
    """Training rows with the popularity signal (actual) and the viewers signal (predicted)."""
    u = prep.trailing_window(usage_reused(spark, sf, "date", "signal", "corr_7d_viewers_price"), model.TRAIN_DAYS)
    return u.withColumn("viewers_signal", kpi.signal_label("corr_7d_viewers_price"))


@register("class_counts")
def q_class_counts(spark, sf):
    prepare(spark)
    return metrics.class_counts(_labelled_pairs(spark, sf), "signal", model.MAX_FOLDS)


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    prepare(spark)
    return metrics.confusion_matrix(_labelled_pairs(spark, sf), "signal", "viewers_signal",
                                    kpi.SIGNAL_CLASSES)


@register("classification_scores")
def q_classification_scores(spark, sf):
    prepare(spark)
    return metrics.classification_scores(_labelled_pairs(spark, sf), "signal", "viewers_signal")


@register("classification_report")
def q_classification_report(spark, sf):
    prepare(spark)
    return metrics.classification_report(_labelled_pairs(spark, sf), "signal", "viewers_signal")


@register("cv_folds")
def q_cv_folds(spark, sf):
    prepare(spark)
    train = prep.trailing_window(usage_reused(spark, sf, *ROW_KEY, "signal"), model.TRAIN_DAYS)
    k = model.n_folds(train)
    return present(model.fold_assignment(train, k, ROW_KEY).select(*ROW_KEY, "signal", "fold"))


@register("feature_matrix")
def q_feature_matrix(spark, sf):
    prepare(spark)
    return present(model.feature_matrix(usage_core(spark, sf)).select(*ROW_KEY, *model.FEATURES))


@register("label_index")
def q_label_index(spark, sf):
    prepare(spark)
    train = prep.trailing_window(usage_reused(spark, sf, "date", "signal"), model.TRAIN_DAYS)
    idx = model.label_index(train).fit(train)
    return (idx.transform(train.select("signal").distinct())
               .select("signal", F.col("label").cast("int").alias("label_index")))


# ── model (not SQL-expressible: rows-only check) ─────────────────────────────
MODEL_CFG = model.ModelConfig(estimator="gbt")          # all boosting rounds
_TRAINED: dict[tuple, tuple[DataFrame, list]] = {}


def trained(spark, sf) -> tuple[DataFrame, list]:
    """(scored usage, feature importances) of the one daily training run; the
    scored rows are a written table that all model queries of a session read
    as long as the tables they come from are the same files."""
    key = (spark.sparkContext.applicationId, *[listing(spark, table_path(sf, t)) for t in ("part", "lineitem", "events")])
    if key not in _TRAINED:
        scored, fitted = model.fit_and_score(usage_core(spark, sf), MODEL_CFG)
        _TRAINED[key] = scored, model.importances(fitted) if fitted else []
    return _TRAINED[key]


@register("train_and_score")
def q_train_and_score(spark, sf):
    prepare(spark)
    scored, _ = trained(spark, sf)
    return present(scored.select(*ROW_KEY, "signal", *schemas.ML_COLUMNS))


@register("avg_confidence")
def q_avg_confidence(spark, sf):
    prepare(spark)
    scored, _ = trained(spark, sf)
    return scored.agg(F.round(F.avg("ml_confidence"), 4).alias("avg_confidence"))


@register("cv_summary")
def q_cv_summary(spark, sf):
    prepare(spark)
    return model.cv_summary(model.cross_validate(usage_core(spark, sf), ROW_KEY, MODEL_CFG))


@register("feature_importance")
def q_feature_importance(spark, sf):
    prepare(spark)
    return spark.createDataFrame(trained(spark, sf)[1], "feature string, importance double")


FALLBACK_DAYS = 7


@register("ml_fallback")
def q_ml_fallback(spark, sf):
    """A run of the first game by name over the last week of bars: 1 to 9 rows
    to train on, so the model falls back (NEUTRAL, confidence 0, NULL metrics)."""
    prepare(spark)
    usage = usage_reused(spark, sf)
    first = usage.agg(F.min("game_name")).first()[0]
    week = prep.trailing_window(usage.where(F.col("game_name") == first), FALLBACK_DAYS)
    return cmb.to_usage(model.train_and_score(week, MODEL_CFG))


@register("combine_full")
def q_combine_full(spark, sf):
    """Whole daily flow: formatted layer -> combine -> model -> usage layer (read back)."""
    prepare(spark)
    usage = cmb.to_usage(trained(spark, sf)[0])
    path = layers.layer_path(shared_dir(spark, "lake"), "usage", "correlation", "GameStockCorrelation")
    with compiled(spark):
        layers.write_layer(usage, path, testbed.RUN_DATE, ["ticker", "game_name", "date"], range_sorted=True)
    back = layers.read_layer(spark, path, schemas.USAGE, testbed.RUN_DATE).drop(layers.RUN_DATE_COL)
    return back.select(*USAGE_CORE_COLUMNS, _ml_ok())


@register("model_quality")
def q_model_quality(spark, sf):
    """The trained model against always guessing the most frequent class, and its confidence against its hit rate."""
    prepare(spark)
    scored = prep.trailing_window(trained(spark, sf)[0], model.TRAIN_DAYS)
    hit = F.col("ml_prediction") == F.col(model.LABEL)
    most = scored.groupBy(model.LABEL).count().agg(F.max("count")).first()[0]
    return scored.agg((F.avg(hit.cast("int")) > F.lit(most) / F.count(F.lit(1))).alias("better_than_guessing"),
                      F.count(F.when(F.col("ml_confidence").isNull(), 1)).alias("rows_without_confidence"))


# ── layer I/O ───────────────────────────────────────────────────────────────
ML_OK = "ml_ok"


def _ml_ok() -> F.Column:
    """Whether a row's model columns can be right: a known class, confidence in (0, 1], scores in [0, 1]."""
    ok = F.col("ml_prediction").isin(*kpi.SIGNAL_CLASSES) & (F.col("ml_confidence") > 0) & (F.col("ml_confidence") <= 1)
    for c in model.METRIC_COLUMNS.values():
        ok = ok & F.col(c).between(0, 1)
    return F.coalesce(ok, F.lit(False)).alias(ML_OK)


@register("serving_model")
def q_serving_model(spark, sf):
    """Usage with model -> serving table; the model columns, whose values SQL cannot know, as one check."""
    prepare(spark)
    path = shared_dir(spark, "serving")
    serve.full_refresh(cmb.to_usage(trained(spark, sf)[0]), path, indexed_at=SERVE_STAMP)
    docs = serve.read_serving(spark, path)
    return present(docs.select(*[c for c in schemas.SERVING.names if c not in schemas.ML_COLUMNS], _ml_ok()))


@register("model_metrics_check")
def q_model_metrics_check(spark, sf):
    """The five stored training scores against scores computed again from the stored predictions."""
    prepare(spark)
    scored, _ = trained(spark, sf)
    again = metrics.classification_scores(prep.trailing_window(scored, model.TRAIN_DAYS), model.LABEL, "ml_prediction")
    stored = scored.select(*model.METRIC_COLUMNS.values()).distinct()
    both = stored.crossJoin(again.select(*[F.col(k).alias(f"again_{k}") for k in model.METRIC_COLUMNS]))   # one row each
    return both.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), (F.col(c) == F.col(f"again_{k}")).alias("equal"))
        for k, c in model.METRIC_COLUMNS.items()])).alias("x")).select("x.metric", "x.equal")


HISTORY_DAY = "2024-01-15"


@register("combine_history")
def q_combine_history(spark, sf):
    """A layer with two snapshots: on the earlier one's day its real scores replace the jittered ones."""
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    earlier = f["games"].withColumns({"date": F.to_date(F.lit(HISTORY_DAY)), "rank_score": F.col("rank_score") + 5,
                                      "run_date": F.lit(HISTORY_DAY.replace("-", ""))})
    both = f["games"].withColumn("run_date", F.lit(testbed.RUN_DATE)).unionByName(earlier)
    out = cmb.combine_history(both, f["bars"], f["streams"], f["stream_map"], testbed.RUN_DATE)
    return present(out.select(*USAGE_CORE_COLUMNS))


@register("run_metrics")
def q_run_metrics(spark, sf):
    prepare(spark)
    rows: list = []
    layered.formatted_inputs(spark, sf, with_metrics=rows)
    counts = [F.struct(F.lit(e).alias("entity"), F.lit(d).alias("date"),
                       F.lit(n).cast("long").alias("row_count")) for e, d, n in rows]
    return spark.range(1).select(F.inline(F.array(*counts)))


@register("partition_inventory")
def q_partition_inventory(spark, sf):
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    inv = []
    for _, _, (group, entity), _, _ in layered.SPECS:
        path = layers.layer_path(f["root"], "formatted", group, entity)
        inv.append(layers.partition_rows(spark, path).withColumn("entity", F.lit(f"{group}/{entity}")))
    out = inv[0]
    for x in inv[1:]:
        out = out.unionByName(x)
    return out


def _bars_envelope(spark, sf, chunk_rows=layers.ENVELOPE_CHUNK_ROWS) -> str:
    path = shared_dir(spark, "raw_bars")
    bars = cut_lineage(inputs.raw_bars(spark, sf), "raw_bars")
    failed = [r[0] for r in expand.failed_tickers(testbed.tracked(spark), bars).orderBy("ticker").collect()]   # of the fixed list
    layers.write_envelope(bars, path,
                          {"source": "yahoo_finance", "date": testbed.RUN_DATE,
                           "tickers": testbed.TRACKED_TICKERS, "failed_tickers": failed,
                           "extracted_at": testbed.RUN_EXTRACTED_AT},
                          "records", chunk_rows)
    return path


@register("scan_json_envelope")
def q_scan_json_envelope(spark, sf):
    prepare(spark)
    path = _bars_envelope(spark, sf)
    return layers.read_envelope(spark, path, schemas.BARS_ENVELOPE, "records")


@register("sink_json_envelope")
def q_sink_json_envelope(spark, sf):
    prepare(spark)
    path = _bars_envelope(spark, sf, chunk_rows=40)
    meta = layers.read_envelope_meta(spark, path, schemas.BARS_ENVELOPE, "records")
    return (meta.groupBy("source", "date", F.array_join("failed_tickers", ",").alias("failed_tickers"))
                .agg(F.sum("count").cast("long").alias("records")))


def _from_envelope(spark, records: DataFrame, schema, field: str) -> DataFrame:
    """Raw records written as envelopes and read again: where a format step starts."""
    path = shared_dir(spark, "raw_snapshot")
    layers.write_envelope(records, path, {"source": "testbed", "date": testbed.RUN_DATE}, field)
    return layers.read_envelope(spark, path, schema, field)


@register("games_from_envelope")
def q_games_from_envelope(spark, sf):
    """Raw JSON envelopes of games -> formatted games."""
    prepare(spark)
    raw = _from_envelope(spark, inputs.raw_games(spark, sf), schemas.GAMES_ENVELOPE, "games")
    return present(formats.format_steam(raw))


@register("streams_from_envelope")
def q_streams_from_envelope(spark, sf):
    prepare(spark)
    raw = _from_envelope(spark, inputs.raw_streams(spark, sf), schemas.STREAMS_ENVELOPE, "games")
    return present(formats.format_twitch(raw).withColumn("log_viewers", F.round("log_viewers", 10)))


@register("bars_from_envelope")
def q_bars_from_envelope(spark, sf):
    prepare(spark)
    return present(formats.format_bars(layers.read_envelope(spark, _bars_envelope(spark, sf), schemas.BARS_ENVELOPE, "records")))


@register("layer_sort_order")
def q_layer_sort_order(spark, sf):
    """Per formatted layer: rows, and rows that stand in their file after a row they should precede."""
    prepare(spark)
    f = layered.formatted_inputs(spark, sf)
    out = None
    for _, _, (group, entity), schema, sort in layered.SPECS:
        if sort is None:
            continue
        rows = spark.read.schema(schema).parquet(layers.layer_path(f["root"], "formatted", group, entity)).select(
            F.struct(*sort).alias("k"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
        # a row and the one before it in its file, joined by place rather than by a window over a whole file
        prev = rows.select(F.col("k").alias("p"), "file", (F.col("i") + 1).alias("i"))
        # compressed files look small enough to broadcast, but their rows with paths are not
        one = (rows.join(prev.hint("merge"), ["file", "i"], "left")
                   .agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("p") > F.col("k"), 1)).alias("violations"))
                   .withColumn("entity", F.lit(f"{group}/{entity}")))
        out = one if out is None else out.unionByName(one)
    return out


@register("paged_top_n")
def q_paged_top_n(spark, sf):
    """Pages of the streams' list, followed by cursor: one list with an empty page, one that loses its cursor, one whole."""
    prepare(spark)
    ranked = inputs.raw_streams(spark, sf).select(
        "rank", "game_id", (F.floor((F.col("rank") - 1) / pages.PAGE_RECORDS) + 1).cast("int").alias("page"))
    lists = F.explode(F.array(*[F.lit(x) for x in ("gap", "no_cursor", "whole")]))
    hole = (F.col("list") == "gap") & (F.col("page") == testbed.PAGE_WITHOUT_RECORDS)
    rows = ranked.withColumn("list", lists).withColumns({c: F.when(~hole, F.col(c)) for c in ("rank", "game_id")})
    made = pages.paginate(rows, "page", ["rank", "game_id"])
    lost = (F.col("list") == "no_cursor") & (F.col("cursor") == f"p{testbed.PAGE_WITHOUT_CURSOR}")
    path = shared_dir(spark, "raw_pages")
    pages.write_pages(made.withColumn("next_cursor", F.when(~F.coalesce(lost, F.lit(False)), F.col("next_cursor"))), path)
    return pages.follow(pages.read_pages(spark, path, "rank: int, game_id: string"))


@register("union_batches")
def q_union_batches(spark, sf):
    """Per-ticker record lists (one folder each), concatenated by one multi-path read."""
    prepare(spark)
    root = shared_dir(spark, "per_ticker")
    inputs.raw_bars(spark, sf).write.partitionBy("ticker").json(root)
    back = spark.read.schema(schemas.RAW_BAR).option("basePath", root).json(f"{root}/ticker=*")
    return back.select(*schemas.RAW_BAR.names)


@register("scan_parquet")
def q_scan_parquet(spark, sf):
    prepare(spark)
    return present(layered.formatted_inputs(spark, sf)["bars"])


@register("sink_parquet_roundtrip")
def q_sink_parquet_roundtrip(spark, sf):
    prepare(spark)
    bars = inputs.bars(spark, sf)
    root = shared_dir(spark, "roundtrip")
    out = None
    for codec in ("snappy", "gzip", "none"):
        path = f"{root}/{codec}"
        layers.write_layer(bars, path, testbed.RUN_DATE, ["ticker", "date"], compression=codec)
        back = layers.read_layer(spark, path, schemas.BARS_FORMATTED, testbed.RUN_DATE)
        back = back.drop(layers.RUN_DATE_COL).withColumn("codec", F.lit(codec))
        out = back if out is None else out.unionByName(back)
    return present(out)


@register("empty_bars_schema")
def q_empty_bars_schema(spark, sf):
    """Bars for a run before any data: an empty frame that still has all columns."""
    prepare(spark)
    bars = inputs.bars(spark, sf)
    first_day = prep.earliest_date(bars)
    return present(prep.history_window(bars, first_day.strftime("%Y%m%d"), 365))


@register("bad_record_split")
def q_bad_record_split(spark, sf):
    """Raw stream records as JSON lines; a failed fetch (no viewers) leaves a broken line."""
    prepare(spark)
    raw = inputs.raw_streams(spark, sf)
    js = F.to_json(F.struct(*raw.columns))
    text = F.when(F.col("top_stream_viewers").isNull(), F.substring(js, 1, 25)).otherwise(js)
    path = shared_dir(spark, "raw_lines")
    raw.select(text.alias("value")).write.text(path)
    good, bad = layers.split_bad_records(layers.read_json_records(spark, path, schemas.RAW_STREAM),
                                         ["rank", "game_id"])
    return (good.agg(F.lit("good").alias("status"), F.count(F.lit(1)).alias("n"))
            .unionByName(bad.agg(F.lit("bad").alias("status"), F.count(F.lit(1)).alias("n"))))


# ── live quotes ─────────────────────────────────────────────────────────────
def _ticks(spark, sf) -> DataFrame:
    return testbed.quote_ticks(testbed.read(spark, sf, "events"))


def bar_context(spark, sf) -> DataFrame:
    """The bar context as a small written table, broadcast behind a check of its size: no refresh computes it again."""
    return bounded_broadcast(cut_lineage(live.bar_context(inputs.bars(spark, sf)), "bar_context"))


def _market_cap():
    return F.col("current_price") * F.lit(1_000_000.0)


@register("live_change_pct")
def q_live_change_pct(spark, sf):
    prepare(spark)
    ctx = bar_context(spark, sf)
    docs = live.quote_docs(_ticks(spark, sf), ctx, market_cap=_market_cap())
    return present(docs.select("seq", "ticker", "current_price", "previous_close", "change_pct",
                               "market_cap", "fifty_two_week_high", "fifty_two_week_low"))


LIVE_OUT = ["doc_id", "ticker", "timestamp", "current_price", "previous_close", "change_pct",
            "currency", "exchange", "seq", "date"]


def _events_stream(spark, sf) -> DataFrame:
    ev = (spark.readStream.schema(testbed.read(spark, sf, "events").schema)
          .option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf))
    return testbed.quote_ticks(ev)


@register("stream_live_quotes")
def q_stream_live_quotes(spark, sf):
    prepare(spark)
    ctx = bar_context(spark, sf)
    table, ckpt = shared_dir(spark, "live"), shared_dir(spark, "live_ckpt")
    q = live.start_live_refresh(_events_stream(spark, sf), ctx, table, ckpt, available_now=True)
    q.awaitTermination()
    return present(live.read_live(spark, table).select(*LIVE_OUT))


@register("stream_latest_per_minute")
def q_stream_latest_per_minute(spark, sf):
    prepare(spark)
    ctx = bar_context(spark, sf)
    table, ckpt = shared_dir(spark, "live_min"), shared_dir(spark, "live_min_ckpt")
    q = live.start_latest_per_minute(_events_stream(spark, sf), ctx, table, ckpt, available_now=True)
    q.awaitTermination()
    return present(live.read_live(spark, table).select(*LIVE_OUT))


EVENT_PARTS = 4


def _shuffled_files(spark, sf) -> str:
    """The events in four parts out of time order, each part files of its own."""
    root = shared_dir(spark, "event_files")
    events = testbed.read(spark, sf, "events")
    for i in range(EVENT_PARTS):
        events.where(F.pmod(F.col("event_id") * 7 + 3, F.lit(EVENT_PARTS)) == i).write.parquet(f"{root}/part={i}")
    return root


def _multi_batch(spark, sf, start) -> DataFrame:
    """As many micro-batches as ``_shuffled_files`` has parts, in their order, however many files a part has."""
    prepare(spark)
    root = _shuffled_files(spark, sf)
    files = sum(name.endswith(".parquet") for name, *_ in listing(spark, root))
    stream = (spark.readStream.schema(testbed.read(spark, sf, "events").schema)
              .option("recursiveFileLookup", True).option("maxFilesPerTrigger", -(-files // EVENT_PARTS)).parquet(root))
    table, ckpt = shared_dir(spark, "live_parts"), shared_dir(spark, "live_parts_ckpt")
    start(testbed.quote_ticks(stream), bar_context(spark, sf), table, ckpt, available_now=True).awaitTermination()
    return present(live.read_live(spark, table).select(*LIVE_OUT))


@register("stream_latest_multi_batch")
def q_stream_latest_multi_batch(spark, sf):
    """Events in several micro-batches, out of order: every minute's latest tick is kept."""
    return _multi_batch(spark, sf, live.start_latest_per_minute)


@register("stream_refresh_multi_batch")
def q_stream_refresh_multi_batch(spark, sf):
    return _multi_batch(spark, sf, live.start_live_refresh)


@register("stream_skipped_quotes")
def q_stream_skipped_quotes(spark, sf):
    """Ticks of which some have no ticker or no timestamp: what the stream skipped, by reason, as observed and as kept."""
    prepare(spark)
    table, kept, ckpt = (shared_dir(spark, x) for x in ("live_counted", "live_quarantine", "live_counted_ckpt"))
    k = F.col("seq")
    ticks = _events_stream(spark, sf).withColumns({"ticker": F.when(k % 7 != 0, F.col("ticker")), "timestamp": F.when(k % 11 != 0, F.col("timestamp"))})
    q = live.start_counted_refresh(ticks, bar_context(spark, sf), table, kept, ckpt, available_now=True)
    q.awaitTermination()
    seen = live.skipped_counts(q)
    rows = live.read_quarantine(spark, kept, ticks.schema).groupBy("reason").agg(F.count(F.lit(1)).alias("ticks"))
    observed = F.coalesce(*[F.when(F.col("reason") == r, F.lit(seen[r])) for r in live.SKIP_REASONS]).cast("long")
    written = live.read_live(spark, table).agg(F.lit("written").alias("reason"), F.count(F.lit(1)).alias("ticks"))
    return rows.withColumn("observed", observed).unionByName(written.withColumn("observed", F.lit(None).cast("long")))


@register("live_dirty_quotes")
def q_live_dirty_quotes(spark, sf):
    """Ticks with NaN, infinite, NULL and 0 prices and caps, caps beyond a long, and some with currency or exchange."""
    prepare(spark)
    k, value = F.col("event_id"), F.col("value")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    ticks = testbed.read(spark, sf, "events").select(
        F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("timestamp"), k.alias("seq"),
        F.when(k % 8 == 0, nan).when(k % 8 == 1, inf).when(k % 8 == 2, F.lit(None)).when(k % 8 == 3, F.lit(0.0)).otherwise(value).alias("current_price"),
        F.when(k % 5 == 0, nan).when(k % 5 == 1, F.lit(0.0)).when(k % 5 == 2, F.lit(None)).when(k % 5 == 3, value * 1_000_000.0)
         .otherwise(F.lit(1e300)).alias("market_cap"),
        F.when(k % 3 == 0, F.lit("EUR")).alias("currency"), F.when(k % 4 == 0, F.lit("XPAR")).alias("exchange"),
        F.when(k % 6 == 0, -value).alias("fifty_two_week_low"))
    docs = live.quote_docs(ticks, bar_context(spark, sf))
    return present(docs.select("seq", "ticker", "current_price", "previous_close", "change_pct", "market_cap",
                               "fifty_two_week_low", "currency", "exchange"))


@register("live_upsert")
def q_live_upsert(spark, sf):
    """Upsert the same batch twice, then an empty batch: the table must be unchanged."""
    prepare(spark)
    ctx = bar_context(spark, sf)
    docs = live.quote_docs(_ticks(spark, sf), ctx)
    table = shared_dir(spark, "live_batch")
    live.upsert(docs, table)
    live.upsert(docs, table)
    live.upsert(docs.limit(0), table)
    return present(live.read_live(spark, table).select(*LIVE_OUT))
