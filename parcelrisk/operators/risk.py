"""Operations layer: risk bands, summaries, ranked work list, city map,
alerts, panel edits and prediction history (F16-F21, F26, F28, A12-A14,
A24, S10, S17, P12, P13, J5, J7, W6, T1, U3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions import risk as R
from parcelrisk.functions.common import np_round
from parcelrisk.operators.quality import ingest_order, keep_first
from parcelrisk.operators.ranking import global_row_number

PREDICTION_COLS = ("prob_fallo", "risk_level", "action", "shap_reason")


# ------------------------------------------------------------------ F16 / F17 / M9
def band(df: DataFrame, prob: str | Column, threshold=C.DEFAULT_THRESHOLD,
         high_multiplier: float = C.HIGH_MULTIPLIER) -> DataFrame:
    """prob_fallo (4 dp, half-even), risk_level, action and an empty shap_reason.

    The band is taken from the probability itself; only what is shown is rounded.
    """
    level = R.risk_level(prob, threshold, high_multiplier)
    return (df.withColumns({"prob_fallo": R.round_prob(prob), "risk_level": level})
            .withColumn("action", R.risk_action("risk_level"))
            .withColumn("shap_reason", F.lit(None).cast("string")))


# ------------------------------------------------------------------ A13 / P12
def risk_summary(scored: DataFrame) -> DataFrame:
    lv = F.col("risk_level")
    s = scored.agg(F.count("*").alias("total"), F.count_if(lv == "HIGH").alias("high"),
                   F.count_if(lv == "MEDIUM").alias("medium"), F.count_if(lv == "LOW").alias("low"))
    return s.select("total", "high", "medium", "low",
                    *[F.try_divide(F.col(c).cast("double"), F.col("total")).alias(f"{c}_share")
                      for c in ("high", "medium", "low")])


def actionable(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("risk_level").isin("HIGH", "MEDIUM"))


# ------------------------------------------------------------------ A14
def city_risk_map(scored: DataFrame, grain=("zone",), default_zone: str = "madrid") -> DataFrame:
    """Per city (or finer grain): totals by band, HIGH share, colour band and marker radius."""
    lv = F.col("risk_level")
    keyed = scored.withColumn("zone", F.coalesce(F.col("zone"), F.lit(default_zone)))
    g = keyed.groupBy(*grain).agg(F.count("*").alias("total"), F.count_if(lv == "HIGH").alias("high"),
                                  F.count_if(lv == "MEDIUM").alias("medium"),
                                  F.count_if(lv == "LOW").alias("low"))
    share = F.when(F.col("total") > 0, F.col("high") / F.col("total").cast("double")).otherwise(F.lit(0.0))
    return g.select(
        *grain, "total", "high", "medium", "low", share.alias("high_share"),
        F.when(share > 0.5, F.lit(C.MAP_RED)).when(share > 0.2, F.lit(C.MAP_AMBER))
         .otherwise(F.lit(C.MAP_GREEN)).alias("color"),
        F.greatest(F.lit(12.0), F.least(F.lit(36.0), F.lit(12.0) + F.col("total") * F.lit(0.6))).alias("radius"))


# ------------------------------------------------------------------ J5 / W6 / T1 / F20 / F21 / F28
def attach_originals(predictions: DataFrame, originals: DataFrame, key: str = "delivery_id",
                     order=None) -> DataFrame:
    """Predictions left-joined to their original delivery, the first of an id by ``order``, by the ingest position or by
    all of its values; prediction columns win over same-named original columns."""
    o = keep_first(originals, key, ingest_order(originals, key, order))
    pcols = set(predictions.columns)
    o = o.select(key, *[c for c in o.columns if c != key and c not in pcols])
    return predictions.join(o, key, "left")


def ranked_panel(scored: DataFrame) -> DataFrame:
    """The operator's work list: rank by probability (ties by id) and display fields."""
    # only the columns the panel shows are ranked (and checkpointed by the ranking)
    needed = ["delivery_id", "prob_fallo", "risk_level", "action", "shap_reason", "zone", "zone_type",
              "product_type", "weather_rain", "is_retry", "driver_quality_score", "recipient_failure_rate",
              "num_previous_attempts", "is_fragile"]
    ranked = global_row_number(scored.select(*[c for c in needed if c in scored.columns]),
                               [F.desc("prob_fallo"), F.asc("delivery_id")])
    return ranked.select(
        "rank", "delivery_id",
        R.capitalize(F.coalesce(F.col("zone"), F.lit(R.EMPTY_LABEL))).alias("city"),
        R.label("zone_type", R.ZONE_TYPE_LABELS).alias("zone_type_label"),
        R.label("product_type", R.PRODUCT_LABELS).alias("product_label"),
        R.risk_badge("risk_level").alias("badge"),
        np_round(F.col("prob_fallo") * F.lit(100.0), 1).alias("pct"),
        R.reason_text("shap_reason").alias("reason"),
        R.label("action", R.ACTION_LABELS).alias("action_label"),
        (F.col("risk_level") == "HIGH").alias("sms_eligible"))


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """The k riskiest deliveries (a top-k report: the limit is the feature)."""
    return scored.orderBy(F.desc("prob_fallo"), F.asc("delivery_id")).limit(k)


# ------------------------------------------------------------------ F18 / F19 / A24 / J7
def alerts(scored: DataFrame, threshold: float = C.SMS_THRESHOLD, city: str | None = None,
           phone: str = C.DEFAULT_PHONE, webhook_configured: bool = False,
           timestamp: str | None = None) -> DataFrame:
    """Alert rows for deliveries with prob >= threshold (message delivery is not done here).

    ``timestamp`` is when the alerts were raised; "now" takes the time of the query's start.
    """
    c = F.coalesce(F.col("zone"), F.lit(city) if city else F.lit(None).cast("string"), F.lit(C.UNKNOWN_CITY))
    detail = ("sent through the configured webhook" if webhook_configured
              else "simulated: no webhook configured")
    out = scored.filter(F.col("prob_fallo") >= F.lit(threshold)).select(
        F.lit(True).alias("sent"), F.lit(not webhook_configured).alias("simulated"),
        "delivery_id", F.lit(phone).alias("phone"),
        R.sms_message("delivery_id", c, "prob_fallo").alias("message"),
        F.lit(detail).alias("detail"), c.alias("city"), "prob_fallo")
    if timestamp is not None:
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
        out = out.withColumn("timestamp", now if timestamp == "now" else F.lit(timestamp))
    return out


def alert_summary(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.agg(F.count("*").alias("total_alerts"),
                          F.count_if(~F.col("simulated")).alias("real"),
                          F.count_if(F.col("simulated")).alias("simulated"))


def flag_already_alerted(df: DataFrame, sent_ids: DataFrame, key: str = "delivery_id") -> DataFrame:
    ids = sent_ids.select(key).distinct().withColumn("already_alerted", F.lit(True))
    return df.join(ids, key, "left").withColumn(
        "already_alerted", F.coalesce(F.col("already_alerted"), F.lit(False)))


def new_alerts(alert_rows: DataFrame, sent_ids: DataFrame, key: str = "delivery_id") -> DataFrame:
    return alert_rows.join(sent_ids.select(key), key, "left_anti")


# ------------------------------------------------------------------ P13 / U3
def remove_ids(panel: DataFrame, ids: DataFrame, key: str = "delivery_id") -> DataFrame:
    return panel.join(ids.select(key), key, "left_anti")


def replace_rows(panel: DataFrame, replacements: DataFrame, key: str = "delivery_id") -> DataFrame:
    return remove_ids(panel, replacements, key).unionByName(replacements)


def append(panel: DataFrame, new_rows: DataFrame) -> DataFrame:
    return panel.unionByName(new_rows, allowMissingColumns=True)


# ------------------------------------------------------------------ S17
def manual_deliveries(requests: DataFrame, with_random_ids: bool = True) -> DataFrame:
    """Defaults of a manually entered delivery: rate 0.2, score 0.75, attempts from
    is_retry, generated recipient/driver ids, no label yet."""
    def gen(prefix):
        return F.concat(F.lit(prefix), F.upper(F.substring(F.regexp_replace(F.uuid(), "-", ""), 1, 6)))
    out = requests.withColumns({
        "recipient_failure_rate": F.lit(C.MANUAL_RECIPIENT_RATE),
        "num_previous_attempts": F.when(F.col("is_retry").cast("double") != 0, F.lit(1)).otherwise(F.lit(0)),
        "driver_quality_score": F.lit(C.MANUAL_DRIVER_SCORE),
        C.TARGET: F.lit(None).cast("int"),
    })
    if with_random_ids:
        out = out.withColumns({"recipient_id": gen("RCP-MANUAL-"), "driver_id": gen("DRV-MANUAL-")})
    return out


# ------------------------------------------------------------------ S10 / A12 / F26
def prediction_history(scored: DataFrame, run_date: Column | str, city: Column | str | None = None,
                       model_version: str = "unknown") -> DataFrame:
    """Rows of the prediction history table; missing prediction columns -> no rows."""
    if any(c not in scored.columns for c in ("prob_fallo", "risk_level", "action")):
        return scored.sparkSession.createDataFrame([], HISTORY_SCHEMA)
    rd = run_date if isinstance(run_date, Column) else F.to_date(F.lit(run_date))
    ct = city if isinstance(city, Column) else (F.lit(city) if city else F.col("zone"))
    return scored.select(rd.alias("run_date"), F.coalesce(F.col("delivery_id"), F.lit("")).alias("delivery_id"),
                         ct.alias("city"), F.col("prob_fallo").cast("double").alias("prob_fallo"),
                         F.col("risk_level").cast("string").alias("risk_level"),
                         F.col("action").cast("string").alias("action"),
                         F.lit(model_version).alias("model_version"))


HISTORY_SCHEMA = ("run_date date, delivery_id string, city string, prob_fallo double, "
                  "risk_level string, action string, model_version string")


def recent_rollup(history: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Last ``days`` of history by run_date/city/band/action, newest first.

    ``run_date >= as_of - days`` compares the date (midnight) with a timestamp,
    so the oldest day is excluded unless ``as_of`` is itself midnight. A filter
    on the partition column: partition pruning skips older run_date folders.
    """
    cutoff = F.to_timestamp(F.lit(as_of)) - F.expr(f"INTERVAL {int(days)} DAYS")
    return (history.filter(F.col("run_date").cast("timestamp") >= cutoff)
            .groupBy("run_date", "city", "risk_level", "action")
            # probabilities are 4-dp fixed point: average the integer ten-thousandths exactly
            .agg(F.count("*").alias("total"),
                 F.sum(F.rint(F.col("prob_fallo") * 10000).cast("long")).alias("_s"))
            .withColumn("avg_prob", F.col("_s") / F.col("total") / F.lit(10000.0)).drop("_s")
            .orderBy(F.desc("run_date")))
