"""Named queries: each maps (spark, sf_dir) -> DataFrame over the driver's tables.

Every query reads the whole tables (through the fixture views) and composes
library operators; nothing here is a special-cased shortcut.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.calendar import day_of_week, is_holiday, is_retry, package_flags
from parcelrisk.functions.common import np_round
from parcelrisk.functions.risk import round_prob
from parcelrisk.functions.scorecard import rule_probability
from parcelrisk.functions.weather import derived_weather
from parcelrisk.operators import drift as DR
from parcelrisk.operators import features as FE
from parcelrisk.operators import metrics as M
from parcelrisk.operators import model_tables as MT
from parcelrisk.operators import models as ML
from parcelrisk.operators import quality as Q
from parcelrisk.operators import risk as RK
from parcelrisk.operators import weather as WX
from parcelrisk.operators.split import stratified_split
from parcelrisk.plans import fixtures as X
from parcelrisk.plans import jobs as J
from parcelrisk.session import ensure_checkpoint_dir, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


BUSINESS = list(C.DELIVERY_COLUMNS)
TRACE = list(X.INGEST_ORDER)


# ------------------------------------------------------------------ quality layer
@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf):
    return Q.dedup_deliveries(X.deliveries(spark, sf), order=X.INGEST_ORDER).select(*BUSINESS)


@query("dedup_exact")
def q_dedup_exact(spark, sf):
    return Q.drop_exact_duplicates(X.deliveries(spark, sf, with_ingest_order=False))


@query("dedup_counts")
def q_dedup_counts(spark, sf):
    return Q.dedup_counts(X.deliveries(spark, sf), position=X.INGEST_ORDER)


@query("dedup_exact_repeated")
def q_dedup_exact_repeated(spark, sf):
    return Q.drop_exact_duplicates(X.deliveries_repeated(spark, sf, with_ingest_order=False))


@query("dedup_counts_repeated")
def q_dedup_counts_repeated(spark, sf):
    return Q.dedup_counts(X.deliveries_repeated(spark, sf), position=X.INGEST_ORDER)


@query("cast_flags")
def q_cast_flags(spark, sf):
    d = X.deliveries(spark, sf).select(
        "delivery_id", *TRACE,
        (F.col("product_type") == "signature_required").alias("requires_signature"),
        (F.col("product_type") == "fragile").alias("is_fragile"),
        (F.col("product_type") == "bulky").alias("is_bulky"),
        (F.col("num_previous_attempts") > 0).alias("is_retry"))
    return Q.cast_booleans(d)


@query("critical_null_counts")
def q_critical_null_counts(spark, sf):
    return Q.quality_profile(X.deliveries_gaps(spark, sf))


@query("class_counts")
def q_class_counts(spark, sf):
    d = X.deliveries_gaps(spark, sf)
    return d.groupBy(F.col(C.TARGET).alias("label")).agg(F.count("*").alias("n"))


@query("range_filtered")
def q_range_filtered(spark, sf):
    return Q.apply_range_rules(X.deliveries_dirty(spark, sf))


@query("range_report")
def q_range_report(spark, sf):
    return Q.range_report(X.deliveries_dirty(spark, sf))


@query("weather_consistent")
def q_weather_consistent(spark, sf):
    return Q.apply_weather_rules(X.deliveries_dirty(spark, sf))


@query("silver_audit")
def q_silver_audit(spark, sf):
    return Q.silver_audit(X.deliveries_dirty(spark, sf), order=X.INGEST_ORDER)


@query("silver_clean")
def q_silver_clean(spark, sf):
    return Q.silver(X.deliveries_dirty(spark, sf), order=X.INGEST_ORDER).select(*BUSINESS)


@query("row_contract_violations")
def q_row_contract(spark, sf):
    _, rejected = Q.split_contract(X.deliveries_dirty(spark, sf))
    return rejected.select("delivery_id", *TRACE,
                           F.concat_ws(",", "violations").alias("violations"),
                           F.size("violations").alias("n_violations"))


# ------------------------------------------------------------------ weather layer


@query("weather_parse")
def q_weather_parse(spark, sf):
    return WX.parse_weather(WX.daily_climate_records(X.weather_raw(spark, sf)))


@query("weather_join")
def q_weather_join(spark, sf):
    return WX.enrich_with_weather(X.deliveries(spark, sf), X.weather_daily(spark, sf))


@query("join_coverage")
def q_join_coverage(spark, sf):
    return WX.join_coverage(X.deliveries(spark, sf), X.weather_daily(spark, sf))


@query("derived_weather")
def q_derived_weather(spark, sf):
    w = X.weather_daily(spark, sf)
    return w.withColumns(derived_weather(mode="historical"))


@query("enrichment_validation")
def q_enrichment_validation(spark, sf):
    e = WX.enrich_with_weather(X.deliveries(spark, sf), X.weather_daily(spark, sf))
    return WX.enrichment_validation(e)


@query("zone_weather_means")
def q_zone_weather_means(spark, sf):
    return WX.zone_weather_means(WX.parse_weather(WX.daily_climate_records(X.weather_raw(spark, sf))))


def _conditions(spark, sf):
    return WX.city_conditions(WX.latest_observation(X.observations(spark, sf)), X.stations(spark))


@query("latest_conditions")
def q_latest_conditions(spark, sf):
    return _conditions(spark, sf).select("zone", "station", "weather_rain_raw",
                                         "weather_wind_speed_raw", "weather_temperature_raw")


@query("realtime_weather")
def q_realtime_weather(spark, sf):
    return WX.realtime_features(_conditions(spark, sf))


@query("display_weather")
def q_display_weather(spark, sf):
    return WX.display_weather(_conditions(spark, sf))


def _conditions_with_gap(spark, sf):
    """Current conditions of all cities and of one whose station never reports."""
    more = X.stations(spark).unionAll(spark.createDataFrame([("zaragoza", "9434")], "zone string, station string"))
    return WX.city_conditions(WX.latest_observation(X.observations(spark, sf)), more)


@query("display_weather_gap")
def q_display_weather_gap(spark, sf):
    return WX.display_weather(_conditions_with_gap(spark, sf))


@query("realtime_weather_gap")
def q_realtime_weather_gap(spark, sf):
    return WX.realtime_features(_conditions_with_gap(spark, sf), fallback=True)


@query("weather_override")
def q_weather_override(spark, sf):
    rt = WX.realtime_features(_conditions(spark, sf))
    d = X.deliveries(spark, sf)
    out = WX.override_weather(d, rt, feature_cols=list(WX.WEATHER_COLS))
    return out.select("delivery_id", *TRACE, "zone", *WX.WEATHER_COLS)


# ------------------------------------------------------------------ features & split

FEATURE_EXCLUDE = tuple(C.EXCLUDE_COLS) + tuple(X.INGEST_ORDER)


def engineered(spark, sf):
    return FE.engineer_features(X.deliveries(spark, sf))


@query("features_39")
def q_features_39(spark, sf):
    e = engineered(spark, sf)
    feats = FE.model_features(e, FEATURE_EXCLUDE)
    return e.select("delivery_id", *TRACE, *[np_round(F.col(c).cast("double"), 9).alias(c) for c in feats])


@query("calendar_flags")
def q_calendar_flags(spark, sf):
    d = X.deliveries(spark, sf)
    return d.select("delivery_id", *TRACE, "date", day_of_week("date").alias("day_of_week"),
                    is_holiday("date").alias("is_holiday"),
                    *[v.alias(k) for k, v in package_flags("product_type").items()],
                    is_retry("num_previous_attempts").alias("is_retry"))


@query("zone_failure_rate")
def q_zone_failure_rate(spark, sf):
    return FE.zone_failure_rate(X.deliveries(spark, sf))


@query("top_correlations")
def q_top_correlations(spark, sf):
    d = X.deliveries(spark, sf, with_ingest_order=False)
    return FE.top_correlations(d).select("feature", np_round("corr", 9).alias("corr"),
                                         np_round("abs_corr", 9).alias("abs_corr"))


def _scaler(spark, sf, enriched=False):
    d = X.deliveries(spark, sf)
    if enriched:
        d = WX.enrich_with_weather(d, X.weather_daily(spark, sf))
    e = FE.engineer_features(d)
    feats = FE.model_features(e, FEATURE_EXCLUDE + tuple(f"{c}_synthetic" for c in WX.WEATHER_COLS))
    return FE.scaler_stats(e, feats)


@query("scaler_stats")
def q_scaler_stats(spark, sf):
    return _scaler(spark, sf).select("feature", np_round("mean", 9).alias("mean"), np_round("std", 9).alias("std"))


@query("zscored")
def q_zscored(spark, sf):
    rt = WX.realtime_features(_conditions(spark, sf), scaler_stats=_scaler(spark, sf, enriched=True),
                              fallback=True)
    return rt.select("zone", *[np_round(c, 9).alias(c) for c in rt.columns if c != "zone"])


def clean_deliveries(spark, sf):
    """Deduplicated, range- and weather-checked deliveries (silver without the gate action)."""
    return Q.silver(X.deliveries(spark, sf), order=X.INGEST_ORDER, gate=False)


@query("silver_enriched")
def q_silver_enriched(spark, sf):
    """Silver over enriched rows: derived flags and the original readings stay."""
    enriched = WX.enrich_with_weather(X.deliveries(spark, sf), X.weather_daily(spark, sf))
    return Q.silver(enriched, order=X.INGEST_ORDER, gate=False)


def split_frame(spark, sf):
    return stratified_split(stored(clean_deliveries(spark, sf), "clean"))   # its hashes and the frame both read them


@query("split_exact")
def q_split_exact(spark, sf):
    return split_frame(spark, sf).select("delivery_id", "delivery_failed", "split")


@query("split_sizes")
def q_split_sizes(spark, sf):
    return split_frame(spark, sf).groupBy("split", F.col("delivery_failed").alias("label")).agg(
        F.count("*").alias("n"))


@query("class_weights")
def q_class_weights(spark, sf):
    train = split_frame(spark, sf).filter(F.col("split") == "train")
    return FE.class_weights(train).select("label", "n", np_round("weight", 9).alias("weight"))


# ------------------------------------------------------------------ scoring & metrics
def scored(spark, sf, enriched: bool = False):
    d = clean_deliveries(spark, sf)
    if enriched:
        d = WX.enrich_with_weather(d, X.weather_daily(spark, sf))
    return with_score(d)


def with_score(d):
    return d.withColumns({"score": round_prob(rule_probability()), "label": F.col(C.TARGET)})


@query("rule_scores")
def q_rule_scores(spark, sf):
    return scored(spark, sf).select("delivery_id", *TRACE, "score", "label")


@query("threshold_sweep")
def q_threshold_sweep(spark, sf):
    return M.threshold_sweep(scored(spark, sf))


@query("best_threshold")
def q_best_threshold(spark, sf):
    return M.best_threshold(M.threshold_sweep(scored(spark, sf)))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf)).select(np_round("roc_auc", 4).alias("roc_auc"))


@query("average_precision")
def q_average_precision(spark, sf):
    return M.average_precision(scored(spark, sf)).select(np_round("avg_precision", 4).alias("avg_precision"))


def _confusion(spark, sf):
    return M.confusion_at_best(M.threshold_sweep(scored(spark, sf)))


@query("confusion")
def q_confusion(spark, sf):
    return _confusion(spark, sf).drop("positive_rate")


@query("classification_report")
def q_classification_report(spark, sf):
    return M.classification_report(_confusion(spark, sf))


@query("daily_projection")
def q_daily_projection(spark, sf):
    return M.daily_projection(_confusion(spark, sf))


@query("model_comparison")
def q_model_comparison(spark, sf):
    plain = clean_deliveries(spark, sf).withColumn("_plain", round_prob(rule_probability()))
    both = WX.enrich_with_weather(plain, X.weather_daily(spark, sf)).withColumn("_weather", round_prob(rule_probability()))
    return M.evaluate_together(both, {"rule_scorecard": "_plain", "rule_scorecard_weather": "_weather"}, label=C.TARGET)


# ------------------------------------------------------------------ operations layer

CUTOFF_DATE = "1998-01-01"          # earlier deliveries = previous runs / training period
AS_OF = "2001-10-01 10:00:00"       # "now" for the recent-history rollup


def banded(spark, sf):
    return RK.band(scored(spark, sf), "score")


@query("risk_bands")
def q_risk_bands(spark, sf):
    return banded(spark, sf).select("delivery_id", *TRACE, "prob_fallo", "risk_level", "action")


@query("risk_summary")
def q_risk_summary(spark, sf):
    return RK.risk_summary(banded(spark, sf))


@query("actionable")
def q_actionable(spark, sf):
    return RK.actionable(banded(spark, sf)).select("delivery_id", *TRACE, "prob_fallo", "risk_level")


@query("ranked_panel")
def q_ranked_panel(spark, sf):
    return RK.ranked_panel(banded(spark, sf))


@query("city_risk_map")
def q_city_risk_map(spark, sf):
    return RK.city_risk_map(banded(spark, sf))


@query("city_zone_risk")
def q_city_zone_risk(spark, sf):
    return RK.city_risk_map(banded(spark, sf), grain=("zone", "zone_type"))


@query("alerts")
def q_alerts(spark, sf):
    return RK.alerts(banded(spark, sf))


@query("alert_summary")
def q_alert_summary(spark, sf):
    return RK.alert_summary(RK.alerts(banded(spark, sf)))


def _alerts_and_prior(spark, sf):
    """All alerts and those of earlier deliveries; the banded rows are written once, as both read them."""
    b = stored(banded(spark, sf).select("delivery_id", "date", "zone", "prob_fallo"), "banded")
    return RK.alerts(b), RK.alerts(b.filter(F.col("date") < F.lit(CUTOFF_DATE).cast("date")))


@query("new_alerts")
def q_new_alerts(spark, sf):
    return RK.new_alerts(*_alerts_and_prior(spark, sf))


@query("alert_flags")
def q_alert_flags(spark, sf):
    return RK.flag_already_alerted(*_alerts_and_prior(spark, sf)).select("delivery_id", "already_alerted")


@query("remove_deliveries")
def q_remove_deliveries(spark, sf):
    b = stored(banded(spark, sf).select("delivery_id", *TRACE, "prob_fallo", C.TARGET, "is_retry"), "banded")
    ids = b.filter((F.col(C.TARGET) == 1) & (F.col("is_retry") == 1)).select("delivery_id")
    return RK.remove_ids(b, ids).select("delivery_id", *TRACE, "prob_fallo")


@query("append_predictions")
def q_append_predictions(spark, sf):
    b = banded(spark, sf).select("delivery_id", *TRACE, "date", "prob_fallo", "risk_level")
    before = F.col("date") < F.lit(CUTOFF_DATE).cast("date")
    return RK.append(b.filter(before), b.filter(~before))


@query("manual_delivery_defaults")
def q_manual_delivery_defaults(spark, sf):
    d = X.deliveries(spark, sf)
    out = RK.manual_deliveries(d, with_random_ids=False)
    return out.select("delivery_id", *TRACE, "recipient_failure_rate", "num_previous_attempts",
                      "driver_quality_score", C.TARGET)


def history(spark, sf):
    b = banded(spark, sf)
    return RK.prediction_history(b, run_date=F.col("date"), city=F.col("zone"),
                                 model_version="rule_scorecard_unknown")


@query("prediction_history")
def q_prediction_history(spark, sf):
    return history(spark, sf)


@query("recent_rollup")
def q_recent_rollup(spark, sf):
    return RK.recent_rollup(history(spark, sf), AS_OF, days=7)


# ------------------------------------------------------------------ drift


def _drift_frames(spark, sf):
    d = X.deliveries(spark, sf)
    before = F.col("date") < F.lit(CUTOFF_DATE).cast("date")
    exp = FE.engineer_features(d.filter(before))
    act = FE.engineer_features(d.filter(~before))
    feats = DR.float_features(exp, act, FE.model_features(exp, FEATURE_EXCLUDE))
    return exp, act, feats


def _psi(spark, sf):
    exp, act, feats = _drift_frames(spark, sf)
    return DR.psi_by_feature(exp, act, feats), act


@query("psi_by_feature")
def q_psi_by_feature(spark, sf):
    psi, _ = _psi(spark, sf)
    return psi.select("feature", F.col("psi_rounded").alias("psi"), "severity")


@query("drift_summary")
def q_drift_summary(spark, sf):
    psi, act = _psi(spark, sf)
    return DR.drift_summary(psi, act.agg(F.count("*").alias("n")))


@query("drift_alerts")
def q_drift_alerts(spark, sf):
    psi, act = _psi(spark, sf)
    return DR.drift_alert_rows(psi, CUTOFF_DATE, act.agg(F.count("*").alias("n")))


@query("drift_summary_one_day")
def q_drift_summary_one_day(spark, sf):
    """The latest day's deliveries against all before them: too few for a verdict."""
    d = X.deliveries(spark, sf)
    last = d.agg(F.max("date")).first()[0]
    exp, act = (FE.engineer_features(d.filter(F.col("date") < F.lit(last))), FE.engineer_features(d.filter(F.col("date") == F.lit(last))))
    return DR.check_drift(exp, act, DR.float_features(exp, act, FE.model_features(exp, FEATURE_EXCLUDE)), str(last))[0]


def _seasonal_frames(spark, sf):
    """Expected = first-half-year deliveries, actual = second half (a season shift)."""
    d = X.deliveries(spark, sf)
    first = F.month("date") <= 6
    exp = FE.engineer_features(d.filter(first))
    act = FE.engineer_features(d.filter(~first))
    feats = DR.float_features(exp, act, FE.model_features(exp, FEATURE_EXCLUDE))
    return exp, act, feats


@query("psi_seasonal")
def q_psi_seasonal(spark, sf):
    exp, act, feats = _seasonal_frames(spark, sf)
    return DR.psi_by_feature(exp, act, feats).select("feature", F.col("psi_rounded").alias("psi"), "severity")


@query("drift_alerts_seasonal")
def q_drift_alerts_seasonal(spark, sf):
    exp, act, feats = _seasonal_frames(spark, sf)
    return DR.drift_alert_rows(DR.psi_by_feature(exp, act, feats), CUTOFF_DATE, act.agg(F.count("*").alias("n")))


@query("drift_summary_seasonal")
def q_drift_summary_seasonal(spark, sf):
    exp, act, feats = _seasonal_frames(spark, sf)
    return DR.drift_summary(DR.psi_by_feature(exp, act, feats), act.agg(F.count("*").alias("n")))


# ------------------------------------------------------------------ models, jobs, streaming


def scratch_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a machine-local temp dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/parcelrisk-{name}-{uuid.uuid4().hex[:8]}"


def _training(spark, sf):
    raw = X.deliveries(spark, sf)
    split, feats = J.prepare_training_data(raw, order=X.INGEST_ORDER)
    train = split.filter(F.col("split") == "train")
    return split, feats, train, FE.class_weights(train)


def _fit_eval(spark, sf, name):
    split, feats, train, weights = _training(spark, sf)
    models = ML.train_candidates(train, feats, weights, {name: ML.CANDIDATES[name]}, validation=split.filter(F.col("split") == "val"))
    return J.evaluate_models(models, split.filter(F.col("split") == "test"))


@query("train_logistic_regression")
def q_train_lr(spark, sf):
    return _fit_eval(spark, sf, "logistic_regression")


@query("train_random_forest")
def q_train_rf(spark, sf):
    return _fit_eval(spark, sf, "random_forest")


@query("train_boosted_trees")
def q_train_gbt(spark, sf):
    return _fit_eval(spark, sf, "xgboost")


@query("feature_importance")
def q_feature_importance(spark, sf):
    split, feats, train, weights = _training(spark, sf)
    models = ML.train_candidates(train, feats, weights, {"logistic_regression": ML.CANDIDATES["logistic_regression"]})
    return ML.feature_importance(models["logistic_regression"], feats)


@query("batch_inference")
def q_batch_inference(spark, sf):
    """Train on deliveries before the cutoff, save, then score later deliveries as a day's packages."""
    d = X.deliveries(spark, sf)
    before = F.col("date") < F.lit(CUTOFF_DATE).cast("date")
    split, feats = J.prepare_training_data(d.filter(before))
    train = split.filter(F.col("split") == "train")
    models = ML.train_candidates(train, feats, FE.class_weights(train),
                                 {"logistic_regression": ML.CANDIDATES["logistic_regression"]})
    tuned = J.evaluate_models(models, split.filter(F.col("split") == "val")).first()["best_threshold"]
    out = scratch_dir(spark, "model")
    from parcelrisk.sources import sinks as S
    S.save_model(models["logistic_regression"], out, "logistic_regression", {"feature_cols": feats, "best_threshold": tuned})
    model, meta = S.load_model(f"{out}/best_model")
    packages = d.filter(~before).drop("delivery_failed")
    scored = J.score_packages(model, meta, packages, CUTOFF_DATE, conditions=_conditions(spark, sf))
    return scored.select("delivery_id", *TRACE, "prob_fallo", "risk_level", "action")


def _model_tables(spark, sf, name, **settings):
    """Fits one model, writes it as a table and scores all rows with the model and with the table: per split and label
    how many rows there are, and whether the two ways agree on every one."""
    split, feats, train, weights = _training(spark, sf)
    model = ML.train_candidates(train, feats, weights, {name: {**ML.CANDIDATES[name], **settings}})[name]
    base = scratch_dir(spark, "model-table")
    kind = MT.export_model(spark, model, feats, base)
    by_model = ML.score(model, split).select("delivery_id", "split", F.col(C.TARGET).alias("label"), "prob")
    by_table = MT.score_tables(split, spark.read.parquet(f"{base}/{kind}"), kind, "delivery_id", out="_table")
    same = F.coalesce(F.abs(F.col("prob") - F.col("_table")) <= 1e-9, F.lit(False))
    return (by_model.join(by_table, "delivery_id", "left").groupBy("split", "label")
            .agg(F.count("*").alias("n"), F.bool_and(same).alias("agree")).select(F.lit(kind).alias("kind"), "split", "label", "n", "agree"))


@query("model_table_linear")
def q_model_table_linear(spark, sf):
    return _model_tables(spark, sf, "logistic_regression")


@query("model_table_forest")
def q_model_table_forest(spark, sf):
    return _model_tables(spark, sf, "random_forest", n_estimators=12, max_depth=8)


@query("model_table_boosted")
def q_model_table_boosted(spark, sf):
    return _model_tables(spark, sf, "xgboost", n_estimators=8, max_depth=4)


@query("stored_model_scores")
def q_stored_model_scores(spark, sf):
    """Every delivery's probability by three models that were stored as tables; each reads the deliveries, written once."""
    d = stored(clean_deliveries(spark, sf), "clean")
    linear = MT.score_tables(d, spark.createDataFrame(X.STORED_LINEAR, MT.LINEAR_SCHEMA), MT.LINEAR, "delivery_id", "linear")
    trees = spark.createDataFrame(X.STORED_TREES, MT.TREE_SCHEMA)
    forest, boosted = (MT.score_tables(d, trees, kind, "delivery_id", kind) for kind in (MT.FOREST, MT.BOOSTED))
    return linear.join(forest, "delivery_id").join(boosted, "delivery_id").select(
        "delivery_id", *[np_round(c, 6).alias(c) for c in (MT.LINEAR, MT.FOREST, MT.BOOSTED)])


@query("stored_model_importance")
def q_stored_model_importance(spark, sf):
    """Which features the stored trees rest on, weighed by how many deliveries fall on each side: the nodes' rows are
    counted anew on the deliveries."""
    d = clean_deliveries(spark, sf)
    trees = spark.createDataFrame(X.STORED_TREES, MT.TREE_SCHEMA)
    reached = MT.node_rows(d, trees, "delivery_id")
    return MT.table_importance(trees.drop("n_rows", "mass").join(reached.withColumnRenamed("n_rows", "mass"), ["tree", "node"]), MT.FOREST).select(
        "feature", np_round("importance", 6).alias("importance"))


@query("incremental_scoring")
def q_incremental_scoring(spark, sf):
    """Land the deliveries as CSV files, score them with the stream job, read the result."""
    from parcelrisk.streaming.incremental import read_scored, start_incremental_scoring
    base = scratch_dir(spark, "stream")
    d = X.deliveries(spark, sf)
    # Spark reads compressed files as they are; each of them in one task, and there are as many as tasks that wrote them
    (d.select(*[c for c in BUSINESS], *TRACE).write.option("header", True).option("compression", "gzip").csv(f"{base}/landing"))
    from parcelrisk.sources.files import DELIVERY_SCHEMA
    from pyspark.sql import types as T
    schema = T.StructType(list(DELIVERY_SCHEMA.fields) + [
        T.StructField("src_partkey", T.LongType()), T.StructField("src_suppkey", T.LongType()),
        T.StructField("src_price", T.DoubleType())])

    def scorer(batch):
        return RK.band(batch, rule_probability())

    q = start_incremental_scoring(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", scorer,
                                  schema=schema)
    q.awaitTermination()
    return read_scored(spark, f"{base}/out").select("delivery_id", *TRACE, "prob_fallo", "risk_level", "action")


# ------------------------------------------------------------------ panel joins, top-k, weather parts
@query("panel_with_originals")
def q_panel_with_originals(spark, sf):
    """Predictions joined back to the first original delivery per id (prediction columns win)."""
    first = stored(Q.dedup_deliveries(X.deliveries(spark, sf), order=X.INGEST_ORDER), "first-rows")   # read by both sides
    preds = RK.band(with_score(Q.apply_weather_rules(Q.apply_range_rules(first))), "score").select(
        "delivery_id", "prob_fallo", "risk_level", "action", "shap_reason", F.lit("model").alias("zone"))
    originals = first.select("delivery_id", "zone_type", "weight_kg", *TRACE)
    j = RK.attach_originals(preds, originals, order=TRACE)
    return j.select("delivery_id", "prob_fallo", "risk_level", "zone", "zone_type", "weight_kg", *TRACE)


@query("top_risk_deliveries")
def q_top_risk_deliveries(spark, sf):
    """The 100 riskiest deliveries: a top-k report, where the limit is the feature."""
    return RK.top_k(banded(spark, sf), 100).select("delivery_id", *TRACE, "prob_fallo", "risk_level")


@query("weather_parse_halves")
def q_weather_parse_halves(spark, sf):
    """Half-year landed parts unioned by name, then parsed (same result as one read)."""
    raw = X.weather_raw(spark, sf)
    first = F.col("obs_seq") % 365 < 182
    h1, h2 = raw.filter(first), raw.filter(~first)
    return WX.parse_weather(WX.daily_climate_records(WX.union_parts(h1, h2)))


# ------------------------------------------------------------------ file round trips (sources and sinks)
@query("weather_from_json")
def q_weather_from_json(spark, sf):
    """Station records landed as JSON under station=<code>/ folders, read in one multi-file scan
    (the station comes from the path), normalised and parsed."""
    from parcelrisk.sources.files import read_json_records
    base = scratch_dir(spark, "json")
    X.weather_raw(spark, sf).write.partitionBy("station").json(f"{base}/landed")
    recs = read_json_records(spark, f"{base}/landed", station_from_path=False, arrays=False)
    recs = recs.withColumn("station", F.lpad(F.col("station").cast("string"), 4, "0"))
    recs = recs.withColumn("obs_seq", F.col("obs_seq").cast("int"))
    return WX.parse_weather(WX.daily_climate_records(recs))


def _service_records(spark, sf):
    from parcelrisk.sources.files import read_service_records
    base = scratch_dir(spark, "service")
    X.land_service_replies(spark, sf, base)
    return read_service_records(spark, f"{base}/replies", station=r"station=([^/]+)/")


@query("weather_service_daily")
def q_weather_service_daily(spark, sf):
    """The weather service's replies, landed as arrays without city or sequence, through to daily weather:
    repeated days, a station dated by fecobs in part and a station without readings."""
    return WX.service_weather_daily(_service_records(spark, sf), X.stations(spark))


@query("weather_service_coverage")
def q_weather_service_coverage(spark, sf):
    return WX.station_coverage(_service_records(spark, sf), X.stations(spark))


@query("recent_rollup_stored")
def q_recent_rollup_stored(spark, sf):
    """History appended to a run_date-partitioned table, then rolled up (pruned by run_date)."""
    from parcelrisk.sources import sinks as S
    base = scratch_dir(spark, "history")
    S.append_predictions(history(spark, sf), base, backfill=True)
    return RK.recent_rollup(S.read_history(spark, f"{base}/delivery_predictions"), AS_OF, days=7)


@query("history_appends")
def q_history_appends(spark, sf):
    """History appended in two batches, of which the second is sent again and a third breaks off before its commit:
    per day the rows that the table shows, and those that the manifest counts."""
    from parcelrisk.sources import sinks as S
    base = scratch_dir(spark, "appends")
    table = f"{base}/delivery_predictions"
    rows = stored(history(spark, sf), "history")   # read by each append, twice by one that deals out ranges
    before = F.col("run_date") < F.lit(CUTOFF_DATE).cast("date")
    S.append_predictions(rows.filter(before), base, backfill=True, batch_id="earlier")
    for _ in range(2):
        S.append_predictions(rows.filter(~before), base, backfill=True, batch_id="later")
    rows.limit(10).withColumn("created_at", F.current_timestamp()).write.partitionBy("run_date").parquet(f"{table}/write_id=broken")
    shown = S.read_history(spark, table).groupBy("run_date").agg(F.count("*").alias("n_shown"))
    counted = S.read_manifest(spark, table).groupBy(F.col("value").cast("date").alias("run_date")).agg(F.sum("n_rows").alias("n_counted"))
    return shown.join(counted, "run_date", "full")
