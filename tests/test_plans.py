"""Physical-plan properties the library relies on for scale (checked with explain output)."""
import tempfile

from pyspark.sql import functions as F

from parcelrisk.operators import metrics as M
from parcelrisk.operators import quality as Q
from parcelrisk.operators import risk as RK
from parcelrisk.operators import weather as WX
from parcelrisk.plans import catalog as K
from parcelrisk.plans import fixtures as X
from parcelrisk.sources import sinks as S
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_combines_map_side(spark):
    p = plan(Q.dedup_deliveries(X.deliveries(spark, SF_SMALL)))
    assert "partial_min" in p, "keep-first must pre-aggregate before the shuffle"
    assert p.index("partial_min") > p.index("Exchange hashpartitioning(delivery_id")  # below it in the tree


def test_scan_reads_only_needed_columns(spark):
    p = plan(X.deliveries(spark, SF_SMALL).select("delivery_id", "weight_kg"))
    scan = [l for l in p.splitlines() if "FileScan parquet" in l and "lineitem" in l][0]
    assert "l_linestatus" not in scan and "l_commitdate" not in scan


def test_weather_side_is_broadcast(spark):
    p = plan(WX.enrich_with_weather(X.deliveries(spark, SF_SMALL), X.weather_daily(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_ranking_metrics_collapse_to_distinct_scores(spark):
    p = plan(M.roc_auc(K.scored(spark, SF_SMALL)))
    assert "partial_sum" in p  # rows are reduced to distinct scores map-side


def test_city_map_is_partial_aggregation(spark):
    p = plan(RK.city_risk_map(K.banded(spark, SF_SMALL)))
    assert "partial_count" in p


def test_history_rollup_prunes_partitions(spark):
    base = tempfile.mkdtemp(prefix="pr-plan-")
    S.append_predictions(K.history(spark, SF_SMALL), base, backfill=True)
    stored = spark.read.parquet(f"{base}/delivery_predictions")
    p = plan(RK.recent_rollup(stored, K.AS_OF, 7))
    assert "PartitionFilters: [isnotnull(run_date" in p and "run_date" in p.split("PartitionFilters")[1]


def test_skewed_key_keeps_partial_aggregation(spark):
    """A third of the rows share one id: the result is still one row per id and exact."""
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = Q.keep_first(hot, "k", ["o"])
    assert out.count() == 20001
    assert out.filter("k = 'hot'").first()["o"] == 0


def test_split_evaluates_its_frame_once(spark):
    """Cuts are selected from written hashes; what is returned reads the base once and only compares hashes."""
    from parcelrisk.operators.split import stratified_split
    from parcelrisk.plans.fixtures import deliveries
    plan = stratified_split(deliveries(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and "Window" not in plan


def test_models_are_compared_in_one_pass(spark):
    """The scored rows are melted to counts once; more models add no reading of them."""
    from parcelrisk.operators import metrics as M
    rows = spark.range(500).selectExpr("id", "pmod(xxhash64(id), 7) / 7.0 as a", "pmod(xxhash64(id, 1), 400) / 400.0 as b",
                                       "cast(pmod(xxhash64(id, 2), 3) = 0 as int) as label")
    plan = M.melted_counts(rows, {"x": "a", "y": "b"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0") == 1
    one_by_one = M.compare_models([(m, M.evaluate(rows.select(c, "label"), c)) for m, c in (("x", "a"), ("y", "b"))])
    together = M.evaluate_together(rows, {"x": "a", "y": "b"})
    assert together.columns == one_by_one.columns
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, one_by_one.collect()))
