import math
import re

import pytest
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.operators import quality as Q


def _frame(spark, n=200, seed=42):
    """The reference's unit-test frame: ids, a 0/1 target and standard-normal columns."""
    import numpy as np
    rng = np.random.default_rng(seed)
    cols = ["recipient_failure_rate", "driver_quality_score", "weather_rain", "weather_wind_speed",
            "weather_temperature", "is_holiday", "num_previous_attempts"]
    data = [(f"dlv_{i}", int(rng.integers(0, 2)), *[float(x) for x in rng.standard_normal(len(cols))])
            for i in range(n)]
    return spark.createDataFrame(data, ["delivery_id", "delivery_failed", *cols])


class TestBronze:
    def test_schema_ok(self, spark):
        Q.validate_schema(_frame(spark))

    def test_one_missing(self, spark):
        with pytest.raises(ValueError, match="weather_rain"):
            Q.validate_schema(_frame(spark).drop("weather_rain"))

    def test_several_missing(self, spark):
        with pytest.raises(ValueError) as e:
            Q.validate_schema(_frame(spark).drop("weather_rain", "delivery_failed"))
        assert "weather_rain" in str(e.value) and "delivery_failed" in str(e.value)


class TestSilverGate:
    def test_quality_ok(self, spark):
        Q.validate_quality(_frame(spark))

    def test_null_in_critical_column(self, spark):
        df = _frame(spark).withColumn("weather_rain", F.when(F.col("delivery_id") == "dlv_3", None)
                                      .otherwise(F.col("weather_rain")))
        with pytest.raises(ValueError, match="weather_rain"):
            Q.validate_quality(df)

    def test_nan_counts_as_null(self, spark):
        df = _frame(spark).withColumn("weather_wind_speed", F.when(F.col("delivery_id") == "dlv_3",
                                                                   F.lit(float("nan"))).otherwise(F.col("weather_wind_speed")))
        with pytest.raises(ValueError, match="weather_wind_speed"):
            Q.validate_quality(df)

    def test_one_class(self, spark):
        with pytest.raises(ValueError, match="one class"):
            Q.validate_quality(_frame(spark).withColumn("delivery_failed", F.lit(1)))


RANGE_CASES = [
    ("weather_temperature", -20.0, True), ("weather_temperature", 50.0, True),
    ("weather_temperature", -20.1, False), ("weather_temperature", 50.1, False),
    ("recipient_failure_rate", 0.0, True), ("recipient_failure_rate", 1.0, True),
    ("weight_kg", 0.001, True), ("weight_kg", 0.0, False),
    ("hour", 23, True), ("hour", 24, False),
    ("weather_rain", None, False), ("weather_rain", float("nan"), False),
    ("num_previous_attempts", None, False),
]
BASE = {"weather_temperature": 10.0, "weather_wind_speed": 3.0, "weather_rain": 0.0,
        "recipient_failure_rate": 0.2, "driver_quality_score": 0.7, "weight_kg": 2.0, "hour": 10,
        "num_previous_attempts": 0}
SCHEMA = ("weather_temperature double, weather_wind_speed double, weather_rain double, "
          "recipient_failure_rate double, driver_quality_score double, weight_kg double, hour int, "
          "num_previous_attempts int")


@pytest.mark.parametrize("col,value,kept", RANGE_CASES)
def test_range_boundaries(spark, col, value, kept):
    row = dict(BASE, **{col: value})
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    assert Q.apply_range_rules(df).count() == (1 if kept else 0)


@pytest.mark.parametrize("col,value,kept", [
    ("weather_wind_speed", 40.0, True), ("weather_wind_speed", 40.1, False),
    ("weather_temperature", 45.1, False), ("weather_temperature", 45.0, True),
    ("weather_rain", 200.0, True), ("weather_rain", 200.1, False)])
def test_weather_limits(spark, col, value, kept):
    row = dict(BASE, **{col: value})
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    assert Q.apply_weather_rules(df).count() == (1 if kept else 0)


def test_range_report_counts_each_rule(spark):
    data = [tuple(dict(BASE, hour=24).values()), tuple(dict(BASE, weight_kg=0.0, hour=30).values()),
            tuple(BASE.values())]
    rep = dict((r["column"], r["n_bad"]) for r in Q.range_report(spark.createDataFrame(data, SCHEMA)).collect())
    assert rep == {"hour": 2, "weight_kg": 1}


def test_keep_first_uses_explicit_order(spark):
    df = spark.createDataFrame([("a", 3, "late"), ("a", 1, "first"), ("b", 2, "only"), ("a", 2, "mid")],
                               "k string, o int, v string")
    out = {r["k"]: r["v"] for r in Q.keep_first(df, "k", ["o"]).collect()}
    assert out == {"a": "first", "b": "only"}


def test_dedup_idempotent_and_counts_reconcile(spark):
    from parcelrisk.plans.fixtures import deliveries_dirty
    from conftest import SF_SMALL
    raw = deliveries_dirty(spark, SF_SMALL)
    once = Q.dedup_deliveries(raw)
    twice = Q.dedup_deliveries(once)
    assert once.count() == twice.count() == raw.select("delivery_id").distinct().count()
    a = Q.silver_audit(raw).first()
    assert a["rows_in"] == raw.count()
    assert a["rows_in"] == (a["rows_out"] + a["dropped_row_dups"] + a["dropped_id_dups"]
                            + a["dropped_ranges"] + a["dropped_meteo"])
    assert math.isclose(a["drop_ratio"], (a["rows_in"] - a["rows_out"]) / a["rows_in"])


def test_row_contract_collects_every_violation(spark):
    df = spark.createDataFrame(
        [("d1", 25, 0, 0, "madrid", "offices", 0.1, 0, 0.5, 10, "standard", 0, 0, 0, 0.0, 2.0, 1.0, 15.0, 0),
         ("d2", 10, 0, 0, "paris", "offices", 0.1, 0, 0.5, 10, "standard", 0, 0, 0, 1.0, 0.0, 1.0, 15.0, 0)],
        "delivery_id string, hour int, day_of_week int, is_holiday int, zone string, zone_type string, "
        "recipient_failure_rate double, num_previous_attempts int, driver_quality_score double, "
        "driver_delivery_load int, product_type string, requires_signature int, is_fragile int, is_bulky int, "
        "weight_kg double, weather_rain double, weather_wind_speed double, weather_temperature double, "
        "is_retry int")
    v = {r["delivery_id"]: r["violations"] for r in Q.with_violations(df).collect()}
    assert v["d1"] == ["hour", "weight_kg", "weather_rain"]
    assert v["d2"] == ["zone"]
    ok, bad = Q.split_contract(df)
    assert ok.count() == 0 and bad.count() == 2


def test_cast_booleans(spark):
    df = spark.createDataFrame([(True, 1), (False, 2)], "b boolean, i int")
    out = Q.cast_booleans(df)
    assert dict(out.dtypes)["b"] == "double"
    assert sorted(r["b"] for r in out.collect()) == [0.0, 1.0]


def test_audit_shuffles_the_columns_of_a_row_once(spark):
    """By id only positions and verdicts are shuffled, not the rows that the exact duplicates were found by."""
    from parcelrisk.plans import fixtures as X
    from conftest import SF_SMALL
    plan = Q.first_verdicts(X.deliveries_dirty(spark, SF_SMALL), order=X.INGEST_ORDER)._jdf.queryExecution().executedPlan()
    by_id = re.findall(r"Aggregate\(key=\[delivery_id#\d+\], .*", plan.toString())
    assert by_id and not any(c in line for line in by_id for c in ("zone_type", "recipient_id", "product_type"))


def test_audit_of_rows_that_share_a_position(spark):
    """The first row among several of one position is the one that keep-first chooses, null ids included."""
    rows = [("a", 1, 50.0, 1), ("a", 1, 10.0, 0), ("b", 1, 10.0, 1), ("b", 1, 10.0, 0), ("b", 2, -90.0, 1), ("c", 1, 10.0, 1),
            ("c", 1, 10.0, 1), (None, None, 60.0, 0), (None, None, 10.0, 1), (None, 3, 10.0, None), ("d", 4, 10.0, None),
            ("e", 1, 46.0, 1), ("e", 1, 47.0, 1)]
    df = spark.createDataFrame(rows, "delivery_id string, o int, weather_temperature double, delivery_failed int")
    a = Q.silver_audit(df, order=["o"]).first()
    silver = Q.silver(df, order=["o"], gate=False)
    want = silver.agg(F.count("*").alias("n"), F.sum("delivery_failed").alias("f"), F.avg("delivery_failed").alias("r")).first()
    assert (a["rows_in"], a["rows_out"], a["failures"], a["failure_rate"]) == (13, want["n"], want["f"], want["r"])
    assert (a["dropped_row_dups"], a["dropped_id_dups"]) == (1, 6)
    assert a["dropped_ranges"] + a["dropped_meteo"] == 6 - a["rows_out"]
    none = Q.silver_audit(df.limit(0), order=["o"]).first()
    assert none["rows_out"] == 0 and none["rows_in"] is None and none["failure_rate"] is None
