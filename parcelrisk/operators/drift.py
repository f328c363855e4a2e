"""Population Stability Index drift monitoring.

All features are handled in one job. Both frames are unpivoted to
(position, value) and collapsed to distinct values with the counts of both
sides (a partial aggregation), dealt by ranges; everything after that scales
with the number of distinct values, not rows.

Quantile edges follow NumPy's linear ``percentile`` exactly: the two order
statistics around ``q * (n - 1)`` are found by prefix sums over the ranges
(``order_statistics``) and blended with NumPy's two-sided lerp. (Spark's ``percentile`` blends as
``(h-p)*lo + (p-l)*hi``, which moves tied edges by an ulp and changes bin
membership on discrete features.) Repeated edges are allowed; a value goes to
the last bin whose left edge is <= value, the last bin is closed, values
outside the edges are dropped - NumPy ``histogram`` semantics. ``Bucketizer``
rejects repeated edges, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelrisk import config as C
from parcelrisk.functions.common import np_round
from parcelrisk.session import cut_lineage


def float_features(expected: DataFrame, actual: DataFrame, feature_cols, limit: int | None = None):
    """Float-typed features present in both frames, in ``feature_cols`` order; ``limit`` takes the first ones only."""
    def is_float(df, c):
        return c in df.columns and isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    cols = [c for c in feature_cols if is_float(expected, c) and is_float(actual, c)]
    return cols[:limit]


def _value_counts(expected: DataFrame, actual: DataFrame, features) -> DataFrame:
    """(pos, value, n_e, n_a) per distinct value of each feature, counted on both sides at once.

    Features go by their position: what is hashed and shuffled is an int, a double and two counts.
    """
    each = F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("pos", "value")
    both = (expected.select(F.lit(1).alias("_e"), each).unionByName(actual.select(F.lit(0).alias("_e"), each)))
    return both.groupBy("pos", "value").agg(F.sum("_e").alias("n_e"), F.sum(F.lit(1) - F.col("_e")).alias("n_a"))


def _ranged(values: DataFrame, key: str) -> DataFrame:
    """Distinct values with counts, dealt by ranges of (key, value) that are numbered in ``_range``, and written: the bounds
    are sampled, so the same deal must be read by all that follows."""
    return cut_lineage(values.repartitionByRange(key, "value").withColumn("_range", F.spark_partition_id()))


def order_statistics(values: DataFrame, ranks: DataFrame, key: str = "feature", count: str = "cnt") -> DataFrame:
    """Exact k-th smallest values, without a per-feature window over all values.

    ``values``: (key, value, count) distinct values with multiplicities. ``ranks``: (key, idx, ...) 0-based target ranks
    (extra columns are kept). The values lie in ranges; totals per key and range, a small table, give each range's
    first rank, and running sums inside a range do the rest, one range per task.
    """
    v = values if "_range" in values.columns else _ranged(values.filter(F.col("value").isNotNull()), key)
    per = v.groupBy(key, "_range").agg(F.sum(count).alias("_n"))                      # ranges and keys, no values
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = per.select(key, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(key, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = (v.join(F.broadcast(first), [key, "_range"])
              .withColumn("_e", F.col("_first") + F.sum(count).over(inside)).withColumn("_s", F.col("_e") - F.col(count))
              .select(key, "value", "_s", "_e"))
    hit = placed.alias("p").join(F.broadcast(ranks.alias("r")), (F.col(f"r.{key}") == F.col(f"p.{key}"))   # a few ranks per key
                                 & (F.col("r.idx") >= F.col("p._s")) & (F.col("r.idx") < F.col("p._e")))
    return hit.select("r.*", F.col("p.value").alias("value"))


def quantile_edges(counts: DataFrame, buckets: int = C.PSI_BUCKETS, eps: float = C.PSI_EPS) -> DataFrame:
    """(pos, n, edges) from the expected side of ranged value counts."""
    ev = counts.filter((F.col("n_e") > 0) & F.col("value").isNotNull())
    n = ev.groupBy("pos").agg(F.sum("n_e").alias("n"))
    spark = counts.sparkSession
    qs = spark.createDataFrame([(i, (i * (100.0 / buckets)) / 100.0) for i in range(buckets + 1)], "qi int, q double")
    ranks = (n.crossJoin(F.broadcast(qs))  # features x (buckets + 1) rows
             .withColumn("_vi", F.col("q") * (F.col("n") - 1)).withColumn("_t", F.col("_vi") - F.floor("_vi")))
    wanted = ranks.select("pos", "n", "qi", "_t", F.explode(F.array(
        F.struct(F.lit(0).alias("_hi"), F.floor("_vi").alias("idx")), F.struct(F.lit(1).alias("_hi"), F.ceil("_vi").alias("idx")))).alias("w"))
    stats = order_statistics(ev, wanted.select("pos", "n", "qi", "_t", "w._hi", "w.idx"), "pos", "n_e")
    pts = stats.groupBy("pos", "n", "qi", "_t").agg(F.max(F.when(F.col("_hi") == 0, F.col("value"))).alias("v_lo"),
                                                    F.max(F.when(F.col("_hi") == 1, F.col("value"))).alias("v_hi"))
    diff = F.col("v_hi") - F.col("v_lo")
    lerp = F.when(F.col("_t") >= 0.5, F.col("v_hi") - diff * (F.lit(1.0) - F.col("_t"))) \
        .otherwise(F.col("v_lo") + diff * F.col("_t"))
    edge = (F.when(F.col("qi") == 0, lerp - F.lit(eps))
            .when(F.col("qi") == buckets, lerp + F.lit(eps)).otherwise(lerp))
    pts = pts.withColumn("edge", edge)
    return pts.groupBy("pos", "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("qi", "edge"))), lambda s: s["edge"]).alias("edges"))


def psi_by_feature(expected: DataFrame, actual: DataFrame, features, buckets: int = C.PSI_BUCKETS,
                   eps: float = C.PSI_EPS, warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT) -> DataFrame:
    """(pos, feature, psi, psi_rounded, severity) for every feature, one job."""
    features = list(features)
    # one row per feature and distinct value, with the counts of both sides; read by the branches below
    vc = _ranged(_value_counts(expected, actual, features), "pos")
    edges = quantile_edges(vc, buckets, eps)
    e, v = F.col("edges"), F.col("value")
    inside = (v >= e[0]) & (v <= e[buckets])
    at = F.least(F.size(F.filter(e, lambda x: x <= v)) - 1, F.lit(buckets - 1))   # one of a few edges
    per_bin = (vc.join(F.broadcast(edges.select("pos", "edges")), "pos")           # a row per feature
               .groupBy("pos", F.when(inside, at).alias("bin")).agg(F.sum("n_e").alias("ce"), F.sum("n_a").alias("ca")))
    every = Window.partitionBy("pos")                                              # buckets + 1 rows per feature
    binned = per_bin.withColumns({"le": F.sum("ce").over(every), "la": F.sum("ca").over(every)})
    grid = edges.select("pos", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bin"))
    totals = binned.groupBy("pos").agg(F.max("le").alias("le"), F.max("la").alias("la"))
    t = (grid.join(F.broadcast(binned.select("pos", "bin", "ce", "ca")), ["pos", "bin"], "left").join(F.broadcast(totals), "pos"))
    ep = F.coalesce(F.col("ce"), F.lit(0)) / (F.col("le") + F.lit(eps))
    ap = F.coalesce(F.col("ca"), F.lit(0)) / (F.col("la") + F.lit(eps))
    ep = F.when(ep == 0, F.lit(eps)).otherwise(ep)
    ap = F.when(ap == 0, F.lit(eps)).otherwise(ap)
    term = (ap - ep) * F.log(ap / ep)
    psi = t.groupBy("pos").agg(F.sum(term).alias("psi"))
    sev = (F.when(F.col("psi") < warn, F.lit("OK")).when(F.col("psi") < alert, F.lit("WARN"))
           .otherwise(F.lit("ALERT")))
    names = F.array(*[F.lit(f) for f in features])
    return psi.select("pos", F.get(names, F.col("pos")).alias("feature"), "psi", np_round("psi", 4).alias("psi_rounded"), sev.alias("severity"))


def drift_summary(psi: DataFrame, n_current: DataFrame | None = None,
                  min_samples: int = C.MIN_SAMPLES_FOR_DRIFT) -> DataFrame:
    """One row: status, mean rounded PSI (4 dp), feature count, ALERT features in order.

    ``n_current`` (a one-row frame with ``n``) applies the minimum-sample gate: below it there is a status, and nothing
    is said about features.
    """
    s = psi.agg(
        F.count("*").alias("n_features"),
        np_round(F.avg("psi_rounded"), 4).alias("overall_psi"),
        F.count_if(F.col("severity") == "ALERT").alias("n_alerts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("severity") == "ALERT", F.struct("pos", "feature")))), lambda x: x["feature"]), ",")
        .alias("features_with_drift"))
    s = s.withColumn("status", F.when(F.col("n_alerts") > 0, F.lit("ALERT")).otherwise(F.lit("OK")))
    if n_current is not None:
        s = s.crossJoin(n_current.select((F.col("n") >= min_samples).alias("_enough")))  # one row
        nothing = {"status": F.lit("insufficient_data"), "overall_psi": F.lit(None), "n_features": F.lit(0), "n_alerts": F.lit(0),
                   "features_with_drift": F.lit("")}
        s = s.withColumns({c: F.when(F.col("_enough"), F.col(c)).otherwise(v) for c, v in nothing.items()})
    return s.select("status", "overall_psi", "n_features", "n_alerts", "features_with_drift")


def drift_alert_rows(psi: DataFrame, alert_date: str, n_current: DataFrame | None = None,
                     min_samples: int = C.MIN_SAMPLES_FOR_DRIFT) -> DataFrame:
    """History rows for features whose severity is not OK (S12); none below the minimum sample (``n_current`` as above)."""
    if n_current is not None:
        psi = psi.join(F.broadcast(n_current.filter(F.col("n") >= min_samples).select("n")), how="cross")  # one row or none
    return psi.filter(F.col("severity") != "OK").select(
        F.to_date(F.lit(alert_date)).alias("alert_date"), F.col("feature").alias("feature_name"),
        F.col("psi_rounded").alias("psi_value"), "severity")


def check_drift(expected: DataFrame, actual: DataFrame, features, alert_date: str,
                min_samples: int = C.MIN_SAMPLES_FOR_DRIFT) -> tuple[DataFrame, DataFrame]:
    """(summary, alert rows). The current rows are counted first; below the minimum no PSI is computed at all."""
    n = actual.agg(F.count("*").alias("n"))
    spark = expected.sparkSession
    if n.first()["n"] < min_samples:
        none = spark.createDataFrame([], "pos int, feature string, psi double, psi_rounded double, severity string")
        return drift_summary(none, spark.createDataFrame([(0,)], "n long"), max(1, min_samples)), drift_alert_rows(none, alert_date)
    psi = cut_lineage(psi_by_feature(expected, actual, features))   # a row per feature, read by both
    return drift_summary(psi), drift_alert_rows(psi, alert_date)
