import math

import pytest
from pyspark.sql import functions as F

from parcelrisk.functions import risk as R
from parcelrisk.functions.scorecard import rule_probability
from parcelrisk.operators import features as FE
from parcelrisk.operators import risk as RK

GOLDEN = dict(delivery_id="dlv_00000042", date="2024-05-28", hour=10, day_of_week=0, is_holiday=0,
              zone="madrid", zone_type="historic_center", recipient_failure_rate=0.31,
              num_previous_attempts=1, driver_quality_score=0.72, driver_delivery_load=22,
              product_type="fragile", requires_signature=0, is_fragile=1, is_bulky=0, weight_kg=4.5,
              weather_rain=1.0, weather_wind_speed=3.2, weather_temperature=11.0, is_retry=1)


def golden(spark):
    return spark.createDataFrame([tuple(GOLDEN.values())],
                                 "delivery_id string, date string, hour int, day_of_week int, is_holiday int, "
                                 "zone string, zone_type string, recipient_failure_rate double, "
                                 "num_previous_attempts int, driver_quality_score double, "
                                 "driver_delivery_load int, product_type string, requires_signature int, "
                                 "is_fragile int, is_bulky int, weight_kg double, weather_rain double, "
                                 "weather_wind_speed double, weather_temperature double, is_retry int")


def test_scorecard_golden_row(spark):
    p = golden(spark).select(rule_probability().alias("p")).first()["p"]
    assert p == pytest.approx(0.6670782771, abs=1e-10)


def test_engineer_39_features(spark):
    e = FE.engineer_features(golden(spark).withColumn("delivery_failed", F.lit(0))
                             .withColumn("recipient_id", F.lit(7)).withColumn("driver_id", F.lit("d")))
    feats = FE.model_features(e)
    assert len(feats) == 39
    r = e.first()
    assert r["hour_sin"] == pytest.approx(0.5) and r["hour_cos"] == pytest.approx(-0.8660254, abs=1e-7)
    assert r["month"] == 5.0 and r["quarter"] == 2.0
    assert sum(r[c] for c in feats if c.startswith("zone_") and not c.startswith("zone_type")) == 1.0
    assert r["zone_type_historic_center"] == 1.0 and r["product_type_fragile"] == 1.0
    assert r["rfr_x_retry"] == pytest.approx(0.31)
    assert "date" not in e.columns and "zone" not in e.columns


def test_dow_cyclic(spark):
    r = spark.range(1).select(*[v.alias(k) for k, v in FE.cyclic_features(F.lit(0), F.lit(5)).items()]).first()
    assert r["dow_sin"] == pytest.approx(-0.9749279, abs=1e-7)
    assert r["dow_cos"] == pytest.approx(-0.2225209, abs=1e-7)


def test_weekday_monday_is_zero(spark):
    from parcelrisk.functions.calendar import day_of_week, is_holiday
    r = spark.range(1).select(day_of_week(F.lit("2024-05-27").cast("date")).alias("d"),
                              is_holiday(F.lit("2024-12-25").cast("date")).alias("h")).first()
    assert r["d"] == 0 and r["h"] == 1


@pytest.mark.parametrize("p,level,action", [(0.8, "HIGH", "REAGENDAR_SMS"), (0.65, "HIGH", "REAGENDAR_SMS"),
                                            (0.64, "MEDIUM", "CAMBIAR_FRANJA"), (0.55, "MEDIUM", "CAMBIAR_FRANJA"),
                                            (0.5, "MEDIUM", "CAMBIAR_FRANJA"), (0.49, "LOW", "ENTREGA_NORMAL"),
                                            (0.1, "LOW", "ENTREGA_NORMAL")])
def test_risk_bands(spark, p, level, action):
    r = RK.band(spark.createDataFrame([(p,)], "p double"), "p", 0.5).first()
    assert (r["risk_level"], r["action"]) == (level, action)


@pytest.mark.parametrize("p,pct", [(0.6712, 67), (0.705, 70), (0.125, 12)])
def test_sms_percent_half_even(spark, p, pct):
    r = spark.range(1).select(R.sms_message(F.lit("dlv_1"), F.lit("madrid"), F.lit(p)).alias("m")).first()["m"]
    assert f" {pct}% " in r and " Madrid " in r


def test_capitalize_is_not_initcap(spark):
    r = spark.range(1).select(R.capitalize(F.lit("SAN sebastián")).alias("c")).first()["c"]
    assert r == "San sebastián"


def test_alert_threshold(spark):
    df = spark.createDataFrame([("a", 0.70, "madrid"), ("b", 0.6999, "madrid"), ("c", 0.9, None)],
                               "delivery_id string, prob_fallo double, zone string")
    a = {r["delivery_id"]: r["city"] for r in RK.alerts(df).collect()}
    assert a == {"a": "madrid", "c": "desconocida"}
    s = RK.alert_summary(RK.alerts(df)).first()
    assert (s["total_alerts"], s["real"], s["simulated"]) == (2, 0, 2)


@pytest.mark.parametrize("high,total,color", [(5, 10, "#f59e0b"), (51, 100, "#ef4444"), (2, 10, "#22c55e")])
def test_city_map_colour(spark, high, total, color):
    rows = [("madrid", "HIGH")] * high + [("madrid", "LOW")] * (total - high)
    r = RK.city_risk_map(spark.createDataFrame(rows, "zone string, risk_level string")).first()
    assert r["color"] == color
    assert r["radius"] == pytest.approx(max(12, min(36, 12 + 0.6 * total)))


def test_reason_text(spark):
    df = golden(spark).withColumn("shap_reason", F.lit(None).cast("string"))
    r = df.select(R.reason_text().alias("r")).first()["r"]
    assert r == "🌧️ Lluvia · 🔁 Reintento · 🏛️ Centro histórico · ⚠️ Frágil"
    empty = spark.createDataFrame([(0.0, 0, "offices", 0.9, 0.1, 0, 0, None)],
                                  "weather_rain double, is_retry int, zone_type string, driver_quality_score double, "
                                  "recipient_failure_rate double, num_previous_attempts int, is_fragile int, "
                                  "shap_reason string")
    assert empty.select(R.reason_text().alias("r")).first()["r"] == "—"


def test_labels_pass_unknown_and_dash_null(spark):
    df = spark.createDataFrame([("offices",), ("moon",), (None,)], "z string")
    out = [r["l"] for r in df.select(R.label("z", R.ZONE_TYPE_LABELS).alias("l")).collect()]
    assert out == ["Oficinas", "moon", "—"]


def test_recent_rollup_excludes_oldest_day(spark):
    h = spark.createDataFrame([("2024-01-03", "madrid", "LOW", "ENTREGA_NORMAL", 0.1),
                               ("2024-01-10", "madrid", "LOW", "ENTREGA_NORMAL", 0.3)],
                              "run_date string, city string, risk_level string, action string, prob_fallo double")
    h = h.withColumn("run_date", F.to_date("run_date"))
    out = RK.recent_rollup(h, "2024-01-10 09:00:00", days=7).collect()
    assert [str(r["run_date"]) for r in out] == ["2024-01-10"]
    assert out[0]["avg_prob"] == pytest.approx(0.3)


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 75, "delivery_failed int")
    w = {r["label"]: r["weight"] for r in FE.class_weights(df).collect()}
    assert w[1] == pytest.approx(100 / (2 * 25)) and w[0] == pytest.approx(100 / (2 * 75))


def test_scaler_stats_sample_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = FE.scaler_stats(df, ["x"]).first()
    assert r["mean"] == 2.5 and r["std"] == pytest.approx(math.sqrt(5 / 3))
