"""Calendar and package-flag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelrisk.config import HOLIDAYS_MM_DD
from parcelrisk.functions.common import col_, flag


def day_of_week(date: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(date))


def is_holiday(date: str | Column, holidays=HOLIDAYS_MM_DD) -> Column:
    """1 when the month-day falls in the fixed holiday set."""
    return flag(F.date_format(col_(date), "MM-dd").isin(list(holidays)))


def package_flags(product_type: str | Column) -> dict[str, Column]:
    """requires_signature / is_fragile / is_bulky derived from the product type."""
    pt = col_(product_type)
    return {
        "requires_signature": flag(pt == "signature_required"),
        "is_fragile": flag(pt == "fragile"),
        "is_bulky": flag(pt == "bulky"),
    }


def is_retry(attempts: str | Column) -> Column:
    return flag(col_(attempts) > 0)


def default_date(date: str | Column, run_date: str) -> Column:
    """Missing delivery date -> the run date (a parameter, so reruns are deterministic)."""
    return F.coalesce(col_(date).cast("date"), F.to_date(F.lit(run_date)))
