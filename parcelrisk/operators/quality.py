"""Quality layer: schema gate, boolean casts, dedup, null/class gate, range
and weather rules, row contract and the silver audit (S3, P1-P6, P11, A1-A4,
A25, W2).

Rules are data (``config.RANGE_RULES``) turned into boolean columns; the
filter is a single conjunction so Catalyst fuses it into one codegen stage,
and reports are one aggregation pass, not one action per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelrisk import config as C
from parcelrisk.functions.common import is_missing
from parcelrisk.session import stored


# ---------------------------------------------------------------- S3 / P1 / P6
def validate_schema(df: DataFrame, required=C.REQUIRED_COLUMNS) -> None:
    """Raise listing every required column that is absent (driver-side, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {missing}")


def cast_booleans(df: DataFrame) -> DataFrame:
    """Every boolean column -> double 1.0/0.0."""
    bools = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    if not bools:
        return df
    return df.withColumns({c: F.col(c).cast("double") for c in bools})


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


def feature_columns(df: DataFrame, exclude=C.EXCLUDE_COLS) -> tuple[list[str], list[str]]:
    """(numeric feature columns in schema order, dropped non-numeric columns)."""
    keep, dropped = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (keep if isinstance(f.dataType, _NUMERIC) else dropped).append(f.name)
    return keep, dropped


# ---------------------------------------------------------------- P2 / P3 / A25
def quality_profile(df: DataFrame, target: str = C.TARGET, critical=C.CRITICAL_COLS) -> DataFrame:
    """One row: NULL/NaN count per critical column, distinct target classes, failures."""
    aggs = [F.count_if(is_missing(c) if _is_fractional(df, c) else F.col(c).isNull())
            .alias(f"nulls_{c}") for c in critical if c in df.columns]
    aggs += [
        F.count_distinct(F.col(target)).alias("n_classes"),
        F.count("*").alias("n_rows"),
        F.sum(F.col(target)).cast("long").alias("failures"),
        F.avg(F.col(target).cast("double")).alias("failure_rate"),
    ]
    return df.agg(*aggs)


def _is_fractional(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def validate_quality(df: DataFrame, target: str = C.TARGET, critical=C.CRITICAL_COLS) -> dict:
    """Gate: raise if a critical column has NULL/NaN or the target has < 2 classes.

    One aggregation job; returns the profile as a dict for the run log.
    """
    row = quality_profile(df, target, critical).first().asDict()
    bad = {c: row[f"nulls_{c}"] for c in critical if row.get(f"nulls_{c}")}
    if bad:
        raise ValueError(f"nulls in critical columns: {bad}")
    if row["n_classes"] < 2:
        raise ValueError(f"target '{target}' has only one class")
    return row


# ---------------------------------------------------------------- P4 / P5 / A4
def range_conditions(df: DataFrame, rules=C.RANGE_RULES) -> dict[str, Column]:
    """column -> 'value is inside its bounds' (NULL and NaN are outside)."""
    out = {}
    for c, lo, hi in rules:
        if c not in df.columns:
            continue
        cond = ~F.isnan(F.col(c).cast("double"))
        if lo is not None:
            cond = cond & (F.col(c) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(c) <= F.lit(hi))
        out[c] = F.coalesce(cond, F.lit(False))
    return out


def weather_conditions(df: DataFrame, limits=C.WEATHER_HARD_LIMITS) -> dict[str, Column]:
    return {c: F.coalesce(~F.isnan(F.col(c).cast("double")) & (F.col(c) <= F.lit(hi)), F.lit(False))
            for c, hi in limits if c in df.columns}


def _all(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def apply_range_rules(df: DataFrame, rules=C.RANGE_RULES) -> DataFrame:
    return df.filter(_all(range_conditions(df, rules).values()))


def apply_weather_rules(df: DataFrame, limits=C.WEATHER_HARD_LIMITS) -> DataFrame:
    return df.filter(_all(weather_conditions(df, limits).values()))


def range_report(df: DataFrame, rules=C.RANGE_RULES) -> DataFrame:
    """(column, n_bad) for every ruled column with at least one violation: one pass + unpivot."""
    conds = range_conditions(df, rules)
    wide = df.agg(*[F.count_if(~ok).alias(c) for c, ok in conds.items()])
    long = wide.unpivot([], list(conds), "column", "n_bad")
    return long.filter(F.col("n_bad") > 0)


# ---------------------------------------------------------------- A1 / A2 / W2
def keep_first(df: DataFrame, key, order) -> DataFrame:
    """One row per key: the first by the explicit ``order`` columns.

    Expressed as ``min(struct(order..., row...))`` per key, so the work is a
    partial (map-side) aggregation followed by one shuffle: a key holding a
    third of all rows is reduced to one row per map task before it moves.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    out = df.groupBy(*key).agg(packed)
    return out.select(*[F.col(k) for k in key],
                      *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)


def drop_exact_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Exact duplicate rows removed; NULL == NULL and NaN == NaN as in pandas."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def ingest_order(df: DataFrame, key: str, order=None) -> list[str]:
    """The columns that say which row came first: those given, else the ingest position that the
    bronze step stores, else all other columns, so that the choice never depends on partitioning."""
    if order:
        return list(order)
    return [C.INGEST_POSITION] if C.INGEST_POSITION in df.columns else [c for c in df.columns if c != key]


def dedup_deliveries(df: DataFrame, key: str = "delivery_id", order=None) -> DataFrame:
    """Exact-duplicate removal then keep-first per delivery id, in one aggregation. Keeps every column.

    Keep-first over the raw rows returns the same business values as doing the
    two steps in sequence, because exact duplicates carry identical values.
    """
    return keep_first(df, key, ingest_order(df, key, order))


def dedup_counts(df: DataFrame, key: str = "delivery_id", position=()) -> DataFrame:
    """rows_in, exact-duplicate rows and repeated-id rows, from one grouped pass.

    ``position``: columns that only say where a row came from and don't make it another one.
    """
    cols = [c for c in df.columns if c not in position and c != C.INGEST_POSITION]
    groups = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    per_id = groups.groupBy(key).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_distinct"))
    return per_id.agg(
        F.sum("_rows").cast("long").alias("rows_in"),
        (F.sum("_rows") - F.sum("_distinct")).cast("long").alias("dropped_row_dups"),
        (F.sum("_distinct") - F.count("*")).cast("long").alias("dropped_id_dups"),
        F.count("*").cast("long").alias("rows_after_dedup"),
    )


# ---------------------------------------------------------------- A3
def silver(df: DataFrame, key: str = "delivery_id", order=None, gate: bool = True,
           target: str = C.TARGET) -> DataFrame:
    """cast -> dedup -> (gate) -> ranges -> weather; without the gate as one lazy plan, with it the deduplicated rows
    are written once, and the gate and all that follows read them."""
    df = dedup_deliveries(cast_booleans(df), key, order)
    if gate:
        df = stored(df, "deduplicated")
        validate_quality(df, target)
    return apply_weather_rules(apply_range_rules(df))


def with_drop_reason(df: DataFrame) -> DataFrame:
    """Tag each deduplicated row with the first rule that drops it (NULL = kept)."""
    r = _all(range_conditions(df).values())
    w = _all(weather_conditions(df).values())
    return df.withColumn("drop_reason", F.when(~r, F.lit("range")).when(~w, F.lit("meteo")))


def first_verdicts(raw: DataFrame, key: str = "delivery_id", order=None, target: str = C.TARGET) -> DataFrame:
    """Per id: its raw and distinct rows, the drop reason and target of its first row, and whether that row is in doubt.

    Exact-duplicate groups (map-side combined) are the only rows that are shuffled with all their columns. The rules tag
    each distinct row where it is found, and what is shuffled by id (map-side combined) is a position and a verdict. Where
    rows of one id share the first position but not the verdict, ``_tied`` says that their other columns must decide.
    """
    position = [c for c in (order or (C.INGEST_POSITION,)) if c in raw.columns]
    biz = [c for c in raw.columns if c not in position]
    exact = cast_booleans(raw).groupBy(*biz).agg(F.count("*").alias("_n"),
                                                 F.min(F.struct(*ingest_order(raw, key, order))).alias("_o"))
    verdict = F.xxhash64("drop_reason", target)
    per_id = with_drop_reason(exact).groupBy(key).agg(
        F.sum("_n").alias("_rows"), F.count("*").alias("_distinct"),
        F.min(F.struct("_o", verdict.alias("_v"), "drop_reason", target)).alias("_low"),
        F.min(F.struct("_o", F.bitwise_not(verdict).alias("_v"))).alias("_high"))
    return per_id.select(key, "_rows", "_distinct", "_low.drop_reason", f"_low.{target}",
                         (F.col("_low._v") != F.bitwise_not("_high._v")).alias("_tied"))


def _verdict_counts(target: str) -> list[Column]:
    """Sums over first rows that can be added up."""
    kept = F.col("drop_reason").isNull()
    return [F.count_if(F.col("drop_reason") == "range").alias("_ranges"), F.count_if(F.col("drop_reason") == "meteo").alias("_meteo"),
            F.count_if(kept).alias("_kept"), F.sum(F.when(kept, F.col(target))).alias("_failures"),
            F.sum(F.when(kept, F.col(target).cast("double"))).alias("_rate"), F.count(F.when(kept, F.col(target))).alias("_known")]


def silver_audit(raw: DataFrame, key: str = "delivery_id", order=None,
                 target: str = C.TARGET) -> DataFrame:
    """One-row audit: rows in/out, drops by cause, drop ratio, failure rate and count.

    One pass over the raw rows gives the first verdict per id. Its sums are written down: a row for all ids whose first
    row is clear, and one per id where it is not. Only the rows of the latter, if any, are read again, and their first
    row is chosen by all columns, as ``keep_first`` does.
    """
    position = [c for c in (order or (C.INGEST_POSITION,)) if c in raw.columns]
    ids = [F.count("*").alias("_ids"), F.sum("_rows").alias("_rows"), F.sum("_distinct").alias("_distinct")]
    sums = stored(first_verdicts(raw, key, order, target)
                  .groupBy("_tied", F.when(F.col("_tied"), F.col(key)).alias("_key")).agg(*ids, *_verdict_counts(target)), "audit")
    tied = sums.filter("_tied")
    if not tied.isEmpty():
        of_tied = raw.join(tied.select("_key"), raw[key].eqNullSafe(F.col("_key")), "left_semi")
        firsts = with_drop_reason(dedup_deliveries(cast_booleans(of_tied), key, order).drop(*position))
        sums = (sums.filter(~F.col("_tied")).drop("_tied", "_key")
                .unionByName(tied.select("_ids", "_rows", "_distinct"), allowMissingColumns=True)
                .unionByName(firsts.agg(*_verdict_counts(target)), allowMissingColumns=True))
    a = sums.agg(
        F.sum("_rows").cast("long").alias("rows_in"),
        (F.sum("_rows") - F.sum("_distinct")).cast("long").alias("dropped_row_dups"),
        (F.sum("_distinct") - F.sum("_ids")).cast("long").alias("dropped_id_dups"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n)
          for c, n in (("_ranges", "dropped_ranges"), ("_meteo", "dropped_meteo"), ("_kept", "rows_out"))],
        F.sum("_failures").cast("long").alias("failures"),
        F.try_divide(F.sum("_rate"), F.sum("_known")).alias("failure_rate"))
    return a.select(
        "rows_in", "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("dropped_total"),
        "dropped_row_dups", "dropped_id_dups", "dropped_ranges", "dropped_meteo",
        ((F.col("rows_in") - F.col("rows_out")) / F.col("rows_in").cast("double")).alias("drop_ratio"),
        "failure_rate", "failures",
    )


# ---------------------------------------------------------------- P11
def _int_in(c: str, lo=None, hi=None) -> Column:
    v = F.col(c).cast("double")
    ok = v.isNotNull() & ~F.isnan(v) & (v == F.floor(v))
    if lo is not None:
        ok = ok & (v >= lo)
    if hi is not None:
        ok = ok & (v <= hi)
    return F.coalesce(ok, F.lit(False))


def _float_in(c: str, lo=None, hi=None, lo_strict=False) -> Column:
    v = F.col(c).cast("double")
    ok = v.isNotNull() & ~F.isnan(v)
    if lo is not None:
        ok = ok & ((v > lo) if lo_strict else (v >= lo))
    if hi is not None:
        ok = ok & (v <= hi)
    return F.coalesce(ok, F.lit(False))


def _domain(c: str, values) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


def contract_conditions() -> list[tuple[str, Column]]:
    """(field, ok) for the API row contract, in field order."""
    return [
        ("delivery_id", F.col("delivery_id").isNotNull()),
        ("hour", _int_in("hour", 0, 23)),
        ("day_of_week", _int_in("day_of_week", 0, 6)),
        ("is_holiday", _int_in("is_holiday", 0, 1)),
        ("zone", _domain("zone", C.ZONES)),
        ("zone_type", _domain("zone_type", C.ZONE_TYPES)),
        ("recipient_failure_rate", _float_in("recipient_failure_rate", 0.0, 1.0)),
        ("num_previous_attempts", _int_in("num_previous_attempts", 0)),
        ("driver_quality_score", _float_in("driver_quality_score", 0.0, 1.0)),
        ("driver_delivery_load", _int_in("driver_delivery_load", 0)),
        ("product_type", _domain("product_type", C.PRODUCT_TYPES)),
        ("requires_signature", _int_in("requires_signature", 0, 1)),
        ("is_fragile", _int_in("is_fragile", 0, 1)),
        ("is_bulky", _int_in("is_bulky", 0, 1)),
        ("weight_kg", _float_in("weight_kg", 0.0, lo_strict=True)),
        ("weather_rain", _int_in("weather_rain", 0, 1)),
        ("weather_wind_speed", _float_in("weather_wind_speed")),
        ("weather_temperature", _float_in("weather_temperature")),
        ("is_retry", _int_in("is_retry", 0, 1)),
    ]


def apply_contract_defaults(df: DataFrame) -> DataFrame:
    """Defaults for optional fields: rain 0, wind 0.0, temperature 15.0."""
    return df.withColumns({
        "weather_rain": F.coalesce(F.col("weather_rain"), F.lit(0.0)),
        "weather_wind_speed": F.coalesce(F.col("weather_wind_speed"), F.lit(0.0)),
        "weather_temperature": F.coalesce(F.col("weather_temperature"), F.lit(C.MISSING_TEMPERATURE)),
    })


def with_violations(df: DataFrame) -> DataFrame:
    """Adds ``violations`` (array of failing field names) - rejects are kept, not thrown."""
    df = apply_contract_defaults(df)
    arr = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in contract_conditions()]))
    return df.withColumn("violations", arr)


def split_contract(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = with_violations(df)
    ok = F.size("violations") == 0
    return tagged.filter(ok).drop("violations"), tagged.filter(~ok)
