"""Rule scorecard (F25): a logistic baseline scorer over 16 delivery fields.

Used to score deliveries when no trained model is available and as the
deterministic score behind the metric queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: scorecard weights ------------------------------------------
INTERCEPT = -2.8
RAIN_WEIGHT = 1.1
WIND_STRONG = (10.0, 0.5)      # wind > 10 -> +0.5
WIND_MODERATE = (7.0, 0.2)     # else wind > 7 -> +0.2
FROST = (2.0, 0.6)             # abs(temp) < 2 -> +0.6
HEAT = (35.0, 0.3)             # else temp > 35 -> +0.3
ZONE_TYPE_EFFECT = (("historic_center", 0.9), ("residential", 0.0),
                    ("offices", -0.1), ("industrial", -0.5))
HOUR_EFFECT = (((13, 14), 0.5), ((8, 9), -0.2), ((17, 18), -0.1))
DOW_EFFECT = (((0,), 0.3), ((4,), 0.2), ((5, 6), -0.3))
HOLIDAY_WEIGHT = 0.4
RECIPIENT_RATE_WEIGHT = 2.5
DRIVER_SCORE_WEIGHT = 1.5       # subtracted
DRIVER_LOAD = (40, 0.4)         # load > 40 -> +0.4
RETRY_WEIGHT = 0.7
PRODUCT_EFFECT = (("fragile", 0.3), ("bulky", 0.4), ("high_value", 0.2),
                  ("signature_required", 0.5), ("standard", 0.0))
SIGNATURE_WEIGHT = 0.2
BULKY_WEIGHT = 0.1
HEAVY = (20.0, 0.2)             # weight > 20 -> +0.2
ATTEMPT_WEIGHT = 0.5


def _lookup(c: Column, table) -> Column:
    expr = None
    for key, w in table:
        cond = c.isin(*key) if isinstance(key, tuple) else (c == key)
        expr = F.when(cond, F.lit(w)) if expr is None else expr.when(cond, F.lit(w))
    return expr.otherwise(F.lit(0.0))


def _truthy(c: Column) -> Column:
    return F.coalesce(c.cast("double") != 0, F.lit(False))


def rule_logit() -> Column:
    """Sum of rule contributions, accumulated left to right in a fixed order."""
    rain, wind, temp = F.col("weather_rain"), F.col("weather_wind_speed"), F.col("weather_temperature")
    terms = [
        rain * F.lit(RAIN_WEIGHT),
        F.when(wind > WIND_STRONG[0], F.lit(WIND_STRONG[1]))
         .when(wind > WIND_MODERATE[0], F.lit(WIND_MODERATE[1])).otherwise(F.lit(0.0)),
        F.when(F.abs(temp) < FROST[0], F.lit(FROST[1]))
         .when(temp > HEAT[0], F.lit(HEAT[1])).otherwise(F.lit(0.0)),
        _lookup(F.col("zone_type"), ZONE_TYPE_EFFECT),
        _lookup(F.col("hour"), HOUR_EFFECT),
        _lookup(F.col("day_of_week"), DOW_EFFECT),
        F.when(_truthy(F.col("is_holiday")), F.lit(HOLIDAY_WEIGHT)).otherwise(F.lit(0.0)),
        F.col("recipient_failure_rate") * F.lit(RECIPIENT_RATE_WEIGHT),
        -(F.col("driver_quality_score") * F.lit(DRIVER_SCORE_WEIGHT)),
        F.when(F.col("driver_delivery_load") > DRIVER_LOAD[0], F.lit(DRIVER_LOAD[1])).otherwise(F.lit(0.0)),
        F.when(_truthy(F.col("is_retry")), F.lit(RETRY_WEIGHT)).otherwise(F.lit(0.0)),
        _lookup(F.col("product_type"), PRODUCT_EFFECT),
        F.when(_truthy(F.col("requires_signature")), F.lit(SIGNATURE_WEIGHT)).otherwise(F.lit(0.0)),
        F.when(_truthy(F.col("is_bulky")), F.lit(BULKY_WEIGHT)).otherwise(F.lit(0.0)),
        F.when(F.col("weight_kg") > HEAVY[0], F.lit(HEAVY[1])).otherwise(F.lit(0.0)),
        F.col("num_previous_attempts") * F.lit(ATTEMPT_WEIGHT),
    ]
    z = F.lit(INTERCEPT)
    for t in terms:
        z = z + t
    return z


def rule_probability() -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-rule_logit()))
