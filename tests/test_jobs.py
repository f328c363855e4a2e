import tempfile

from pyspark.sql import functions as F

from parcelrisk.operators import models as ML
from parcelrisk.plans import jobs as J
from parcelrisk.plans.fixtures import deliveries, observations, stations
from parcelrisk.operators import weather as WX
from conftest import SF_SMALL


def test_training_then_batch_inference(spark):
    out = tempfile.mkdtemp(prefix="pr-job-")
    d = deliveries(spark, SF_SMALL)
    before = F.col("date") < F.lit("1998-01-01").cast("date")
    res = J.training_job(spark, d.filter(before), out, "2024-01-01",
                         candidates={"logistic_regression": ML.CANDIDATES["logistic_regression"]})
    assert res["model"] == "logistic_regression" and 0 <= res["metrics"]["roc_auc"] <= 1
    assert spark.read.parquet(f"{out}/gold/feature_cols").count() == 39
    assert spark.read.parquet(f"{out}/reports/model_comparison").filter("is_best").count() == 1
    stages = {r["stage"] for r in spark.read.parquet(f"{out}/run_log").select("stage").distinct().collect()}
    assert stages == {"bronze", "silver", "gold", "gold_dropped_non_numeric", "evaluate"}
    from parcelrisk.sources.sinks import load_model
    _, meta = load_model(res["path"])
    assert meta["config"]["HIGH_MULTIPLIER"] == 1.3 and len(meta["feature_cols"]) == 39
    conditions = WX.city_conditions(WX.latest_observation(observations(spark, SF_SMALL)), stations(spark))
    packages = d.filter(~before).drop("delivery_failed")
    inf = J.batch_inference_job(spark, res["path"], packages, "2024-01-02", out, conditions=conditions)
    n = packages.count()
    assert inf["summary"]["total"] == n == inf["history_rows"]
    assert inf["model_version"].startswith("logistic_regression_")
    hist = spark.read.parquet(f"{out}/history/delivery_predictions")
    assert hist.filter(F.col("run_date") == "2024-01-02").count() == n
    from parcelrisk.sources.sinks import load_model as _load
    model, meta2 = _load(res["path"])
    scaled = J.score_packages(model, meta2, packages, "2024-01-02", conditions=conditions, scale=True)
    assert scaled.count() == n                       # reference-parity z-scored conditions also score
    risky = spark.read.parquet(f"{out}/reports/high_risk")
    assert risky.filter(~F.col("risk_level").isin("HIGH", "MEDIUM")).count() == 0


def test_parity_switches(spark):
    from parcelrisk.operators import features as FE
    w = FE.class_weights(spark.createDataFrame([(1,)] * 20 + [(0,)] * 80, "delivery_failed int"))
    inv = {r["label"]: r["weight"] for r in ML.inverse_positive_weights(w).collect()}
    assert inv == {1: 20 / 80, 0: 1.0}
    d = deliveries(spark, SF_SMALL).withColumn(
        "delivery_failed", F.when(F.col("src_partkey") % 5 == 0, None).otherwise(F.col("delivery_failed")))
    split, feats = J.prepare_training_data(d)          # unlabelled rows are set aside, no gate error
    assert split.filter(F.col("delivery_failed").isNull()).count() == 0 and len(feats) == 39


def test_plain_and_enriched_frames(spark):
    """Silver, audit and features need no columns beyond the contract's, and keep those that there are."""
    from parcelrisk.operators import features as FE
    from parcelrisk.operators import quality as Q
    from parcelrisk.plans.fixtures import weather_daily
    plain = deliveries(spark, SF_SMALL, with_ingest_order=False)
    assert len(plain.columns) == 23
    silver = Q.silver(plain, gate=False)
    assert silver.columns == plain.columns
    again = Q.silver(plain.repartition(7), gate=False)
    assert silver.exceptAll(again).count() == again.exceptAll(silver).count() == 0
    assert Q.silver_audit(plain).first()["rows_out"] == silver.count()
    enriched = WX.enrich_with_weather(plain, weather_daily(spark, SF_SMALL))
    kept = Q.silver(enriched, gate=False)
    assert set(kept.columns) == set(enriched.columns) and "temp_category" in kept.columns
    assert len(FE.model_features(FE.engineer_features(kept))) > 39


def test_training_on_the_plain_frame_stores_silver_rows(spark):
    out = tempfile.mkdtemp(prefix="pr-job-")
    plain = deliveries(spark, SF_SMALL, with_ingest_order=False).withColumn(
        "delivery_failed", F.when(F.col("hour") == 8, None).otherwise(F.col("delivery_failed")))
    J.training_job(spark, plain, out, "2024-01-01", candidates={"logistic_regression": ML.CANDIDATES["logistic_regression"]})
    silver = spark.read.parquet(f"{out}/silver")
    assert {"zone", "date", "product_type"} <= set(silver.columns) and "hour_sin" not in silver.columns
    log = {r["key"]: r["value"] for r in spark.read.parquet(f"{out}/run_log").filter("stage = 'silver'").collect()}
    assert int(log["rows_out"]) == silver.count()
    assert int(log["rows_without_label"]) == plain.filter("delivery_failed is null").count() > 0


def test_unlabelled_rows_have_no_split(spark):
    from parcelrisk.operators.split import stratified_split
    df = spark.createDataFrame([(f"d{i}", None if i % 7 == 0 else i % 2) for i in range(200)], "delivery_id string, delivery_failed int")
    out = stratified_split(df)
    assert out.count() == 200 and out.filter("split is null").count() == df.filter("delivery_failed is null").count()


def test_history_table_shows_appended_rows(spark):
    from parcelrisk.sources import sinks as S
    base = tempfile.mkdtemp(prefix="pr-hist-")
    spark.sql("DROP TABLE IF EXISTS model_metrics")
    S.ensure_history_tables(spark, base)
    S.append_model_metrics(spark, base, {"roc_auc": 0.7}, "m", "r", "2024-01-01")
    assert spark.table("model_metrics").count() == 1
    for t in S.HISTORY_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_tied_weather_readings_do_not_depend_on_partitioning(spark):
    rows = [("s", "2024-01-01 00:00:00", str(k), "1", "2") for k in range(9)]
    obs = spark.createDataFrame(rows, "station string, obs_ts string, prec string, vv string, ta string")
    assert len({tuple(WX.latest_observation(obs.repartition(n)).first()) for n in (1, 3, 5)}) == 1
    assert spark.range(1).select(WX.derived_weather(mode="realtime", temp=F.lit(None).cast("double"), rain=F.lit(0.0), wind=F.lit(0.0))["temp_category"]).first()[0] is None
