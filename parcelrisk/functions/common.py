"""Small expression helpers shared by every layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c: str | Column, digits: int = 0) -> Column:
    """Half-even rounding of the binary value, as NumPy/pandas ``round`` does.

    ``rint(x * 10^d) / 10^d``: Spark's ``round``/``bround`` round the decimal
    string form instead, which differs on values such as 2.675.
    """
    c = col_(c)
    if digits == 0:
        return F.rint(c)
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int; NULL counts as false (pandas comparison semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def dflag(cond: Column) -> Column:
    """Boolean condition -> 1.0/0.0 double; NULL counts as false."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))


def is_missing(c: str | Column) -> Column:
    """NULL or NaN (pandas ``isnull`` on float columns)."""
    c = col_(c)
    return c.isNull() | F.isnan(c)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when the denominator is 0 or NULL (sklearn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def lenient_double(c: str | Column, default: float = 0.0) -> Column:
    """Missing or unparseable -> default (the observation reader's ``safe_float``)."""
    return F.coalesce(col_(c).try_cast("double"), F.lit(float(default)))

