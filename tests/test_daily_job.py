"""The daily job from the landed file to the history, and the drift job's sample gate."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.operators import drift as DR
from parcelrisk.operators import features as FE
from parcelrisk.operators import models as ML
from parcelrisk.operators import risk as RK
from parcelrisk.plans import jobs as J
from parcelrisk.plans.fixtures import deliveries
from parcelrisk.sources import files as FS
from parcelrisk.sources import sinks as S


@pytest.fixture(scope="module")
def plain(spark):
    return deliveries(spark, SF_SMALL, with_ingest_order=False).cache()


@pytest.fixture(scope="module")
def model(spark, plain, tmp_path_factory):
    split, feats = J.prepare_training_data(plain)
    train = split.filter(F.col("split") == "train")
    fitted = ML.train_candidates(train, feats, FE.class_weights(train), {"logistic_regression": {"C": 0.1, "max_iter": 5}})
    base = str(tmp_path_factory.mktemp("model"))
    return S.save_model(fitted["logistic_regression"], base, "logistic_regression", {"feature_cols": feats, "best_threshold": 0.4})


def land(df, folder, run_date, drop=()):
    """The day's CSV under its name, as one file."""
    folder.mkdir(exist_ok=True)
    pdf = df.drop(C.TARGET, *drop).limit(40).toPandas()
    pdf["is_fragile"] = pdf["is_fragile"].astype(bool)
    pdf[sorted(pdf.columns)].to_csv(folder / f"today_packages_{run_date}.csv", index=False)   # another order of columns
    return len(pdf)


def test_the_days_file_is_found_in_order(spark, plain, model, tmp_path):
    first, second, out = tmp_path / "blob", tmp_path / "local", str(tmp_path / "out")
    n = land(plain, second, "2024-05-01")
    folders = [str(first), str(second)]
    with pytest.raises(FileNotFoundError, match="(?s)blob/today_packages_2024-05-02.csv.*local/today_packages_2024-05-02.csv"):
        J.daily_inference_job(spark, model, folders, "2024-05-02", out)
    got = J.daily_inference_job(spark, model, folders, "2024-05-01", out)              # the first folder isn't even there
    assert got["path"].endswith("local/today_packages_2024-05-01.csv") and got["history_rows"] == got["summary"]["total"] == n
    land(plain, first, "2024-05-01")
    assert "/blob/" in FS.find_daily(spark, folders, "2024-05-01")
    again = J.daily_inference_job(spark, model, folders, "2024-05-01", out)            # the same day and file: nothing new
    assert again["history_rows"] == n and S.read_history(spark, f"{out}/history/delivery_predictions").count() == n


def test_a_landed_file_is_read_by_its_header(spark, plain, tmp_path):
    land(plain, tmp_path, "2024-05-01")
    got = FS.read_daily(spark, FS.find_daily(spark, [str(tmp_path)], "2024-05-01"))
    want = {r["delivery_id"]: r for r in plain.collect()}
    kinds = dict(got.dtypes)
    assert kinds["weight_kg"] == "double" and kinds["date"] == "date" and kinds["is_fragile"] == "int"
    for r in got.collect():
        assert r["is_fragile"] in (0, 1) and r["delivery_id"] in want
    (tmp_path / "odd.csv").write_text("hour,extra,weight_kg,is_bulky\n7,x,heavy,True\n,y,1.5,0\n")
    assert [tuple(r) for r in FS.read_daily(spark, str(tmp_path / "odd.csv")).collect()] == [(7, "x", None, 1), (None, "y", 1.5, 0)]


def test_strict_jobs_refuse_missing_features(spark, plain, model, tmp_path):
    land(plain, tmp_path / "in", "2024-05-01", drop=["weight_kg"])
    folders, out = [str(tmp_path / "in")], str(tmp_path / "out")
    with pytest.raises(ValueError, match="missing features.*weight_kg"):
        J.daily_inference_job(spark, model, folders, "2024-05-01", out, fill_missing=False)
    assert J.daily_inference_job(spark, model, folders, "2024-05-01", out)["history_rows"] == 40


def test_drift_says_nothing_on_few_rows(spark, plain, tmp_path, monkeypatch):
    f = FE.engineer_features(plain)
    few = f.limit(50).withColumn("weight_kg", F.lit(1e6))
    feats = ["weight_kg"]
    full = {"status": "ALERT", "n_features": 1, "n_alerts": 1, "features_with_drift": "weight_kg"}
    summary, alerts = DR.check_drift(f, few, feats, "2024-05-01", min_samples=50)
    assert {k: summary.first()[k] for k in full} == full and alerts.count() == 1
    # the gate as a part of the plan
    psi, n = DR.psi_by_feature(f, few, feats), few.agg(F.count("*").alias("n"))
    nothing = ("insufficient_data", None, 0, 0, "")
    assert tuple(DR.drift_summary(psi, n, 51).first()) == nothing and DR.drift_alert_rows(psi, "2024-05-01", n, 51).count() == 0
    assert DR.drift_summary(psi, n, 50).first()["status"] == "ALERT" and DR.drift_alert_rows(psi, "2024-05-01", n, 50).count() == 1
    # and before anything is computed
    monkeypatch.setattr(DR, "psi_by_feature", lambda *a, **k: pytest.fail("computed"))
    assert J.drift_job(spark, f, few, feats, "2024-05-01", str(tmp_path)) == {
        "status": "insufficient_data", "overall_psi": None, "n_features": 0, "n_alerts": 0, "features_with_drift": "", "alert_rows": 0}


def test_drift_alerts_of_a_day_are_appended_once(spark, plain, tmp_path):
    f = FE.engineer_features(plain)
    moved = f.withColumn("weight_kg", F.col("weight_kg") + 1e6)
    for _ in range(2):
        assert J.drift_job(spark, f, moved, ["weight_kg"], "2024-05-01", str(tmp_path))["alert_rows"] == 1
    assert S.read_history(spark, f"{tmp_path}/history/drift_alerts").count() == 1


def test_originals_are_chosen_by_values_without_an_order(spark):
    """Of several rows of an id the same one, however they are dealt."""
    preds = spark.createDataFrame([("a", 0.5)], "delivery_id string, prob_fallo double")
    rows = [("a", "z", 3), ("a", "b", 9), ("a", "b", 1)]
    for order in (rows, rows[::-1]):
        o = spark.createDataFrame(order, "delivery_id string, zone string, hour int").repartition(3)
        assert tuple(RK.attach_originals(preds, o).first()) == ("a", 0.5, "b", 1)
    assert RK.attach_originals(preds, o, order=["hour"]).first()["hour"] == 1


def test_alerts_are_stamped(spark):
    scored = spark.createDataFrame([("a", 0.9, "madrid")], "delivery_id string, prob_fallo double, zone string")
    assert "timestamp" not in RK.alerts(scored).columns and RK.alerts(scored, timestamp="t").first()["timestamp"] == "t"
    assert dt.datetime.fromisoformat(RK.alerts(scored, timestamp="now").first()["timestamp"]).year >= 2024
