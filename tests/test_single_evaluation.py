"""What several steps read is evaluated once: the steps read the written rows, not the tables again."""

import pytest
from pyspark.sql import functions as F

from parcelrisk.operators import quality as Q
from parcelrisk.operators import weather as WX
from parcelrisk.plans import fixtures as X
from parcelrisk.plans import jobs as J
from parcelrisk.plans.catalog import QUERIES, _training

from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["split_exact", "split_sizes", "class_weights", "new_alerts", "alert_flags", "remove_deliveries",
                                  "stored_model_scores", "panel_with_originals"])
def test_shared_rows_are_read_back(spark, name):
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert files and not any("lineitem" in f for f in files)


def test_gated_silver_and_training_frame_read_written_rows(spark):
    gated = Q.silver(X.deliveries(spark, SF_SMALL), order=X.INGEST_ORDER)
    assert "Aggregate" not in plan_of(gated) and "Exchange" not in plan_of(gated)
    plain = Q.silver(X.deliveries(spark, SF_SMALL), order=X.INGEST_ORDER, gate=False)
    assert sorted(map(str, gated.collect())) == sorted(map(str, plain.collect()))
    split = _training(spark, SF_SMALL)[0]
    assert not any("lineitem" in f for f in split.inputFiles())
    assert split.count() == plain.count() == split.filter("split in ('train', 'val', 'test')").count()


def test_training_frame_is_the_same_at_each_reading(spark):
    split, feats = J.prepare_training_data(X.deliveries(spark, SF_SMALL), order=X.INGEST_ORDER)
    sums = [split.agg(F.sum(F.xxhash64(*split.columns).cast("decimal(38,0)")), F.count("*")).first() for _ in range(2)]
    assert sums[0] == sums[1] and len(feats) == 39


def test_small_weather_of_a_large_source_does_not_shuffle_deliveries(spark):
    """The estimate of the source is over Spark's broadcast threshold; the weather itself is a few rows."""
    source = spark.range(3_000_000).select(
        F.expr("date_add(date'2024-01-01', int(id % 5))").alias("date"), F.lit("madrid").alias("zone"),
        F.lit(1.0).alias("weather_rain"), F.lit(2.0).alias("weather_wind_speed"), F.lit(3.0).alias("weather_temperature"))
    d = spark.range(1_000_000).select(
        F.col("id").cast("string").alias("delivery_id"), F.expr("date_add(date'2024-01-01', int(id % 10))").alias("date"),
        F.lit("madrid").alias("zone"), F.lit(9.0).alias("weather_rain"), F.lit(9.0).alias("weather_wind_speed"),
        F.lit(9.0).alias("weather_temperature"))
    out = WX.enrich_with_weather(d, source)
    assert "SortMergeJoin" not in plan_of(out) and "BroadcastHashJoin" in plan_of(out)
    assert out.filter("weather_rain = 1.0").count() == out.filter("weather_rain = 9.0").count() == 500_000
