"""Weather parsing and derived weather flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.common import col_, dflag, flag


def parse_decimal_comma(s: str | Column) -> Column:
    """'12,4' -> 12.4; '', 'Ip', '-', NULL and junk -> NULL (never throws under ANSI)."""
    return F.regexp_replace(F.trim(col_(s)), ",", ".").try_cast("double")


def parse_rain(prec: str | Column) -> Column:
    """Daily rain in mm: trace 'Ip' -> 0.1, missing/junk -> 0.0."""
    p = col_(prec)
    return (F.when(p.isin("Ip", "Ip "), F.lit(C.TRACE_RAIN_MM))
            .otherwise(F.coalesce(parse_decimal_comma(p), F.lit(0.0))))


def parse_date(s: str | Column) -> Column:
    """Coerced date parse: invalid -> NULL."""
    return F.try_to_date(col_(s))


def temp_category(temp: str | Column, closed: str = "right") -> Column:
    """Temperature band 0..3.

    closed="right": bins (-999,5], (5,15], (15,25], (25,999]; outside/NULL -> NULL
    (the training-time rule). closed="left": <5, <15, <25, else (real-time rule).
    """
    t = col_(temp)
    e1, e2, e3 = C.TEMP_CATEGORY_EDGES
    lo, hi = C.TEMP_CATEGORY_SPAN
    if closed == "right":
        return (F.when((t > lo) & (t <= e1), F.lit(0))
                .when((t > e1) & (t <= e2), F.lit(1))
                .when((t > e2) & (t <= e3), F.lit(2))
                .when((t > e3) & (t <= hi), F.lit(3)))
    return (F.when(t < e1, F.lit(0.0)).when(t < e2, F.lit(1.0))
            .when(t < e3, F.lit(2.0)).when(t.isNotNull(), F.lit(3.0)))


def wind_chill(temp: str | Column, wind_ms: str | Column) -> Column:
    """Feels-like temperature (km/h form) below 10 C, else the temperature."""
    t, v = col_(temp), col_(wind_ms)
    p = F.pow(v * F.lit(3.6), F.lit(0.16))
    chill = F.lit(13.12) + F.lit(0.6215) * t - F.lit(11.37) * p + F.lit(0.3965) * t * p
    return F.when(t < 10, chill).otherwise(t)


def derived_weather(rain: str | Column = "weather_rain",
                    wind: str | Column = "weather_wind_speed",
                    temp: str | Column = "weather_temperature",
                    mode: str = "historical") -> dict[str, Column]:
    """strong_wind, adverse_weather, temp_category (+ feels_like_cold historically).

    historical: adverse = rain > 2 mm or strong wind; right-closed temperature bins; int flags.
    realtime:   adverse = rain > 5 mm only; left-closed bins; double flags.
    """
    r, w, t = col_(rain), col_(wind), col_(temp)
    # NaN compares greater than everything in Spark but fails every comparison in pandas
    r = F.when(~F.isnan(r), r)
    w = F.when(~F.isnan(w), w)
    t = F.when(~F.isnan(t), t)
    if mode == "historical":
        strong = w > C.STRONG_WIND_MS
        return {
            "strong_wind": flag(strong),
            "adverse_weather": flag((r > C.ADVERSE_RAIN_MM_HISTORICAL) | strong),
            "temp_category": temp_category(t, "right"),
            "feels_like_cold": flag(wind_chill(t, w) < 0),
        }
    if mode == "realtime":
        return {
            "strong_wind": dflag(w > C.STRONG_WIND_MS),
            "adverse_weather": dflag(r > C.ADVERSE_RAIN_MM_REALTIME),
            "temp_category": temp_category(t, "left"),
        }
    raise ValueError(f"unknown weather mode {mode!r}")


def zscore(c: str | Column, mean: Column, std: Column) -> Column:
    """(v - mean) / std, 0.0 when std <= 0."""
    v = col_(c)
    return F.when(std > 0, (v - mean) / std).otherwise(F.lit(0.0))
