"""End-to-end jobs: training (M8) and daily batch inference (M7).

Each job is a chain of the library's lazy operators; actions happen only at
gates, writes and model fits. Frames read several times (the silver rows, the split,
the scored test set) are written or cut with a reliable checkpoint into the shared
checkpoint folder, so a lost executor recomputes from the checkpoint rather
than from the raw files.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.calendar import default_date
from parcelrisk.functions.risk import model_version
from parcelrisk.operators import drift as DR
from parcelrisk.operators import features as FE
from parcelrisk.operators import metrics as M
from parcelrisk.operators import models as ML
from parcelrisk.operators import quality as Q
from parcelrisk.operators import risk as RK
from parcelrisk.operators import weather as WX
from parcelrisk.operators.split import stratified_split
from parcelrisk.session import cut_lineage, stored
from parcelrisk.sources import files as FS
from parcelrisk.sources import sinks as S

TRACE_EXCLUDE = ("src_partkey", "src_suppkey", "src_price", C.INGEST_POSITION)


def prepare_training_data(raw: DataFrame, exclude=C.EXCLUDE_COLS + TRACE_EXCLUDE,
                          labelled_only: bool = True, order=None):
    """bronze -> silver (gated) -> gold features + exact split; returns (split frame, feature list).

    ``labelled_only`` drops rows without a label first (manually appended
    deliveries have none yet), instead of letting them trip the null gate.
    """
    Q.validate_schema(raw)
    return gold_features(Q.silver(labelled(raw) if labelled_only else raw, order=order), exclude)


def labelled(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(C.TARGET).isNotNull())


def gold_features(clean: DataFrame, exclude=C.EXCLUDE_COLS + TRACE_EXCLUDE):
    """Engineered features of silver rows with the exact split, and the feature list."""
    feats = FE.engineer_features(clean)
    feature_cols = FE.model_features(feats, exclude)
    split = stored(stratified_split(feats), "gold")
    return split, feature_cols


def evaluate_models(models: dict, data: DataFrame, label: str = C.TARGET) -> DataFrame:
    """All models' metrics: every model adds its score to the same rows, which are read once."""
    scores, scored = {}, data
    for i, (name, model) in enumerate(models.items()):
        scores[name] = f"_score_{i}"
        scored = ML.score(model, scored, out=scores[name])
    return M.evaluate_together(scored, scores, label=label)


def training_job(spark: SparkSession, raw: DataFrame, out_dir: str, run_date: str,
                 candidates=None, tune_on: str = "test", stats_on: str = "all",
                 parity_inverse_weight: bool = False, order=None, early_stopping: bool = True) -> dict:
    """Train every enabled candidate, compare on ``tune_on`` ('test' = reference parity,
    'val' = tune on validation), save the best with its metadata, log the run.

    ``stats_on``: scaler statistics over 'all' rows (reference parity) or 'train'.
    ``parity_inverse_weight``: weight the boosted-trees positives by n_pos/n_neg,
    as the reference's positive-class scale does, instead of balanced weights.
    ``early_stopping``: boosting ends when the validation split gains no more; False runs all rounds (reference parity).
    ``order``: columns that say which of a delivery's rows came first; by default the position that the
    bronze snapshot stores.
    """
    run_id = uuid.uuid4().hex
    Q.validate_schema(raw)
    placed = raw if order or C.INGEST_POSITION in raw.columns else raw.withColumn(
        C.INGEST_POSITION, F.monotonically_increasing_id())
    S.write_snapshot(placed, f"{out_dir}/bronze", run_date)
    bronze = (spark.read.parquet(f"{out_dir}/bronze").filter(F.col("run_date") == F.lit(run_date).cast("date"))
              .select(*placed.columns))
    S.log_run(spark, out_dir, run_id, "bronze", {"columns": len(raw.columns), "run_date": run_date})
    training = labelled(bronze)
    clean = stored(Q.silver(training, order=order), "silver")
    S.write_snapshot(clean, f"{out_dir}/silver", run_date)
    audit = Q.silver_audit(training, order=order).first().asDict()
    S.log_run(spark, out_dir, run_id, "silver", {**audit, "rows_without_label": bronze.count() - audit["rows_in"]})
    split, feature_cols = gold_features(clean)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}  # 3 rows
    S.log_run(spark, out_dir, run_id, "gold", {"n_features": len(feature_cols), **sizes})
    _, dropped = Q.feature_columns(split.drop("split"), C.EXCLUDE_COLS + TRACE_EXCLUDE)
    S.log_run(spark, out_dir, run_id, "gold_dropped_non_numeric", {c: "dropped" for c in dropped})
    stats = FE.scaler_stats(split if stats_on == "all" else split.filter(F.col("split") == "train"),
                            feature_cols)
    S.write_table(stats, f"{out_dir}/gold/scaler_stats")
    S.write_table(spark.createDataFrame(list(enumerate(feature_cols)), "pos int, feature string"),
                  f"{out_dir}/gold/feature_cols")
    train = split.filter(F.col("split") == "train")
    weights = FE.class_weights(train)
    models = ML.train_candidates(train, feature_cols, weights, candidates, parity_inverse_weight=parity_inverse_weight,
                                 validation=split.filter(F.col("split") == "val") if early_stopping else None)
    comparison = cut_lineage(evaluate_models(models, split.filter(F.col("split") == tune_on)))
    S.write_table(comparison, f"{out_dir}/reports/model_comparison", csv=True)
    best = comparison.filter("is_best").first().asDict()
    name = best.pop("model")
    meta = {"feature_cols": feature_cols, "best_threshold": best["best_threshold"],
            "scaler_stats": {r["feature"]: {"mean": r["mean"], "std": r["std"]} for r in stats.collect()},
            "metrics": best, "target": C.TARGET, "run_id": run_id, "config": C.snapshot()}
    path = S.save_model(models[name], f"{out_dir}/models", name, meta)
    S.append_model_metrics(spark, f"{out_dir}/history", best, name, run_id, run_date)
    S.log_run(spark, out_dir, run_id, "evaluate", {**best, "model": name})
    return {"run_id": run_id, "model": name, "path": path, "metrics": best}


def score_packages(model, meta: dict, packages: DataFrame, run_date: str,
                   conditions: DataFrame | None = None, city: str | None = None,
                   scale: bool = False, fill_missing: bool = True) -> DataFrame:
    """Cast, default the date, override weather with current conditions, engineer, zero-fill,
    score and band. Pure plan, no action.

    Current conditions are in raw units by default (the models are trained on raw
    units); ``scale=True`` z-scores them with the stored scaler statistics, as the
    reference does.
    """
    feature_cols = meta["feature_cols"]
    df = Q.cast_booleans(packages).withColumn("date", default_date("date", run_date))
    if conditions is not None:
        stats = None
        if scale and meta.get("scaler_stats"):
            rows = [(k, float(v["mean"]), float(v["std"] if v["std"] is not None else 0.0))
                    for k, v in meta["scaler_stats"].items()]      # one row per feature
            stats = packages.sparkSession.createDataFrame(rows, "feature string, mean double, std double")
        df = WX.override_weather(df, WX.realtime_features(conditions, scaler_stats=stats, fallback=True), feature_cols, city)
    eng = FE.engineer_features(df, keep_sources=True)
    if fill_missing:
        eng = FE.zero_fill_missing(eng, feature_cols)
    else:  # strict: a feature that the model needs and the packages lack raises
        FE.require_features(eng, feature_cols)
    scored = ML.score(model, eng, out="prob")
    return RK.band(scored, "prob", threshold=meta.get("best_threshold", C.DEFAULT_THRESHOLD)).drop("prob")


def batch_inference_job(spark: SparkSession, model_dir: str, packages: DataFrame, run_date: str,
                        out_dir: str, conditions: DataFrame | None = None, city: str | None = None,
                        scale: bool = False, fill_missing: bool = True, batch_id: str | None = None) -> dict:
    """Scores the day's packages, writes reports and history.

    ``fill_missing=False`` refuses packages that lack a feature of the model, as the reference does. ``batch_id`` names
    the append to the history: a job that is run again under the same one appends nothing more.
    """
    model, meta = S.load_model(model_dir)
    scored = cut_lineage(score_packages(model, meta, packages, run_date, conditions, city, scale, fill_missing))
    summary = RK.risk_summary(scored).first().asDict()
    S.write_daily_reports(scored, f"{out_dir}/reports", run_date)
    version = f"{meta['model_name']}_{meta.get('saved_at', 'unknown')}"
    hist = RK.prediction_history(scored, run_date, city, version)
    written = S.append_predictions(hist, f"{out_dir}/history", batch_id=batch_id)
    return {"summary": summary, "history_rows": written, "model_version": version}


def daily_inference_job(spark: SparkSession, model_dir: str, folders, run_date: str, out_dir: str, **how) -> dict:
    """M7 as it runs each morning: finds the day's file in the first of the folders that has it, scores and records it.

    The day and the file name the append, so a second run of the day adds no rows. ``how`` is handed to
    ``batch_inference_job``.
    """
    path = FS.find_daily(spark, folders, run_date)
    packages = FS.read_daily(spark, path)
    name = f"{run_date}-{path.rstrip('/').rpartition('/')[2]}"
    batch = how.pop("batch_id", None) or re.sub(r"[^A-Za-z0-9_.-]", "_", name)
    return {**batch_inference_job(spark, model_dir, packages, run_date, out_dir, batch_id=batch, **how), "path": path}


def drift_job(spark: SparkSession, expected: DataFrame, actual: DataFrame, features, run_date: str, out_dir: str) -> dict:
    """A23 as a job: the verdict is logged, the alerts of the day are appended once; with too few rows neither is computed."""
    summary, alerts = DR.check_drift(expected, actual, features, run_date)
    verdict = summary.first().asDict()
    S.log_run(spark, out_dir, run_date, "drift", verdict)
    return {**verdict, "alert_rows": S.append_drift_alerts(alerts, f"{out_dir}/history", batch_id=run_date)}


def version_column(meta: dict):
    return model_version(F.lit(meta["model_name"]), F.lit(meta.get("saved_at")))
