"""Gold layer: feature engineering, feature selection, scaler stats, class
weights and exploratory aggregates (F1-F4, P6, P9, A5, A6, A10, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.features import (ONE_HOT_DOMAINS, cyclic_features, date_features,
                                           interaction_features, one_hot_features)
from parcelrisk.operators.quality import feature_columns


def engineer_features(df: DataFrame, keep_sources: bool = False) -> DataFrame:
    """Cyclic hour/weekday, month/quarter (date dropped), fixed-vocabulary one-hot
    (source columns dropped), five interactions. Originals are kept.

    Column order follows the reference: surviving originals, cyclic, date,
    one-hot, interactions. Pure projection: one codegen stage, no shuffle.
    ``keep_sources`` keeps date/zone/zone_type/product_type (scoring keeps them
    for the reports; the model reads only the feature list).
    """
    cols = {**cyclic_features()}
    if "date" in df.columns:
        cols.update(date_features())
    cols.update(one_hot_features([(c, v) for c, v in ONE_HOT_DOMAINS if c in df.columns]))
    cols.update(interaction_features())
    dropped = set() if keep_sources else {"date"} | {c for c, _ in ONE_HOT_DOMAINS}
    keep = [F.col(c) for c in df.columns if c not in dropped]
    return df.select(*keep, *[v.alias(k) for k, v in cols.items()])


def model_features(df: DataFrame, exclude=C.EXCLUDE_COLS) -> list[str]:
    """Numeric columns other than ids/target, in column order (non-numeric dropped)."""
    keep, _ = feature_columns(df, exclude)
    return keep


def zero_fill_missing(df: DataFrame, feature_cols) -> DataFrame:
    """Add 0.0 for every expected feature the batch lacks."""
    missing = [c for c in feature_cols if c not in df.columns]
    return df.withColumns({c: F.lit(0.0) for c in missing}) if missing else df


def require_features(df: DataFrame, feature_cols) -> None:
    """Raise naming the first five missing features (P10)."""
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing[:5]}...")


# ------------------------------------------------------------------ A10
def scaler_stats(df: DataFrame, feature_cols) -> DataFrame:
    """(feature, mean, std) with the sample standard deviation, one aggregation pass."""
    aggs = []
    for c in feature_cols:
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"m__{c}"), F.stddev_samp(v).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `m__{c}`, `s__{c}`" for c in feature_cols)
    return wide.selectExpr(f"stack({len(feature_cols)}, {pairs}) AS (feature, mean, std)")


# ------------------------------------------------------------------ A11
def class_weights(labels: DataFrame, label: str = C.TARGET) -> DataFrame:
    """Balanced weights n / (k * n_c) per class (one grouped pass + a k-row window)."""
    from pyspark.sql import Window
    counts = labels.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    every = Window.partitionBy()  # k rows (number of classes)
    return counts.select(
        "label", "n",
        (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"))


# ------------------------------------------------------------------ A5 / A6
def zone_failure_rate(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    return df.groupBy("zone").agg(F.count("*").alias("deliveries"),
                                  F.avg(F.col(target).cast("double")).alias("failure_rate"))


def top_correlations(df: DataFrame, target: str = C.TARGET, k: int = 5) -> DataFrame:
    """Top-k |Pearson r| of numeric columns with the target: one aggregation + unpivot."""
    numeric, _ = feature_columns(df, exclude=(target,))
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                    for c in numeric])
    long = wide.unpivot([], numeric, "feature", "corr")
    return (long.filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
            .withColumn("abs_corr", F.abs("corr"))
            .orderBy(F.desc("abs_corr"), "feature").limit(k))
