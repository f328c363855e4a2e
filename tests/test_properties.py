"""Property checks (hypothesis): partition invariance, idempotence, reconciliation."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelrisk.functions.features import one_hot_features
from parcelrisk.operators import drift as DR
from parcelrisk.operators import metrics as M
from parcelrisk.operators import quality as Q

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 50), st.integers(0, 3)),
                   min_size=1, max_size=60)


@SETTINGS
@given(rows_st, st.integers(1, 7))
def test_keep_first_partition_invariant_and_idempotent(spark, rows, parts):
    data = [(k, o * 10 + i, v) for i, (k, o, v) in enumerate(rows)]   # unique order key
    df = spark.createDataFrame(data, "k string, o int, v int")
    a = sorted(tuple(r) for r in Q.keep_first(df, "k", ["o"]).collect())
    b = sorted(tuple(r) for r in Q.keep_first(df.repartition(parts), "k", ["o"]).collect())
    c = sorted(tuple(r) for r in Q.keep_first(Q.keep_first(df, "k", ["o"]), "k", ["o"]).collect())
    want = {}
    for k, o, v in sorted(data, key=lambda r: r[1]):
        want.setdefault(k, (k, o, v))
    assert a == b == c == sorted(want.values())


@SETTINGS
@given(st.lists(st.floats(-5, 5, allow_nan=False), min_size=20, max_size=200))
def test_psi_of_identical_samples_is_zero(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    r = DR.psi_by_feature(df, df, ["x"]).first()
    assert abs(r["psi"]) < 1e-9 and r["severity"] == "OK"


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1)), min_size=2, max_size=80))
def test_auc_is_rank_statistic(spark, pairs):
    ys = [y for _, y in pairs]
    if len(set(ys)) < 2:
        return
    scores = [s / 20 for s, _ in pairs]
    df = spark.createDataFrame([(s, y) for s, y in zip(scores, ys)], "score double, label int")
    got = M.roc_auc(df).first()["roc_auc"]
    pos = [s for s, y in zip(scores, ys) if y == 1]
    neg = [s for s, y in zip(scores, ys) if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


@SETTINGS
@given(st.lists(st.sampled_from(["madrid", "barcelona", "valencia", "sevilla"]), min_size=1, max_size=30))
def test_one_hot_rows_sum_to_one(spark, zones):
    df = spark.createDataFrame([(z,) for z in zones], "zone string")
    oh = one_hot_features([("zone", ("barcelona", "madrid", "sevilla", "valencia"))])
    sums = [r["s"] for r in df.select(sum(oh.values()).alias("s")).collect()]
    assert sums == [1.0] * len(zones)


def test_audit_reconciles_on_dirty_rows(spark):
    rng = np.random.default_rng(5)
    data = [(f"d{rng.integers(0, 40)}", int(i), float(rng.normal(10, 30)), float(rng.normal(5, 20)),
             int(rng.integers(0, 2)))
            for i in range(300)]
    df = spark.createDataFrame(data, "delivery_id string, o int, weather_temperature double, "
                                     "weather_wind_speed double, delivery_failed int")
    a = Q.silver_audit(df, order=["o"]).first()
    assert a["rows_in"] == 300
    assert a["rows_in"] == (a["rows_out"] + a["dropped_row_dups"] + a["dropped_id_dups"]
                            + a["dropped_ranges"] + a["dropped_meteo"])
