"""Feature engineering expressions.

The category vocabularies are closed, so one-hot columns come from a fixed
list (sorted as pandas ``get_dummies`` sorts them): every batch gets the same
feature set, and categories absent from a batch are simply 0.0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.common import col_, dflag

ONE_HOT_DOMAINS = (
    ("zone", tuple(sorted(C.ZONES))),
    ("zone_type", tuple(sorted(C.ZONE_TYPES))),
    ("product_type", tuple(sorted(C.PRODUCT_TYPES))),
)
INTERACTIONS = (
    ("load_x_rain", "driver_delivery_load", "weather_rain"),
    ("fragile_x_bulky", "is_fragile", "is_bulky"),
    ("score_x_rfr", "driver_quality_score", "recipient_failure_rate"),
    ("score_x_load", "driver_quality_score", "driver_delivery_load"),
    ("rfr_x_retry", "recipient_failure_rate", "is_retry"),
)


def cyclic(c: str | Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*c/period."""
    angle = F.lit(2 * math.pi) * col_(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclic_features(hour="hour", dow="day_of_week") -> dict[str, Column]:
    hs, hc = cyclic(hour, 24)
    ds, dc = cyclic(dow, 7)
    return {"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc}


def date_features(date="date") -> dict[str, Column]:
    d = col_(date).cast("date")
    return {"month": F.month(d).cast("double"), "quarter": F.quarter(d).cast("double")}


def one_hot(column: str, values) -> dict[str, Column]:
    """``<column>_<value>`` = 1.0 / 0.0; NULL or unknown -> all zeros."""
    c = F.col(column)
    return {f"{column}_{v}": dflag(c == v) for v in values}


def one_hot_features(domains=ONE_HOT_DOMAINS) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for column, values in domains:
        out.update(one_hot(column, values))
    return out


def interaction_features() -> dict[str, Column]:
    return {name: F.col(a) * F.col(b) for name, a, b in INTERACTIONS}
