"""Weather layer: parse landed station records, enrich deliveries, validate
(F5-F15, W1, W3, J1-J4, A7-A9, T5, P7, P15, P16, U1, U2).

Weather tables are keyed by (date, zone) or by station, so their size is
bounded by calendar days x cities, independent of delivery volume. That is
the proven bound behind the broadcast joins here; windows are only ever
partitioned over these small tables, never over raw deliveries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.operators.quality import keep_first
from parcelrisk.functions.common import lenient_double, np_round
from parcelrisk.session import stored
from parcelrisk.functions.weather import (derived_weather, parse_date,
                                          parse_decimal_comma, parse_rain, zscore)

WEATHER_COLS = ("weather_rain", "weather_wind_speed", "weather_temperature")
DERIVED_COLS = ("strong_wind", "adverse_weather", "temp_category", "feels_like_cold")


# ------------------------------------------------------------------ S7 / U1 / U2
def union_parts(*parts: DataFrame) -> DataFrame:
    """Union-all of weather parts (half-years, cities); missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def daily_climate_records(raw: DataFrame, station_col: str = "station") -> DataFrame:
    """Normalise landed daily-climate records.

    ``fecha`` falls back to the first 10 characters of ``fecobs``; only the
    known fields that exist are kept; duplicate (station, fecha) keep the
    first by ``obs_seq`` when present.
    """
    cols = set(raw.columns)
    fecha = F.col("fecha") if "fecha" in cols else F.lit(None).cast("string")
    if "fecobs" in cols:
        fecha = F.coalesce(fecha, F.substring("fecobs", 1, 10))
    keep = [F.col(c) for c in (station_col, "zone", "obs_seq") if c in cols]
    keep += [fecha.alias("fecha")]
    keep += [F.col(c).cast("string").alias(c) for c in ("prec", "velmedia", "tmed") if c in cols]
    df = raw.select(*keep)
    if "obs_seq" in df.columns:
        w = Window.partitionBy(station_col, "fecha").orderBy("obs_seq")
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return keep_first(df, [station_col, "fecha"], [c for c in df.columns if c not in (station_col, "fecha")])


def check_stations(stations: DataFrame) -> DataFrame:
    """The (zone, station) dimension, or an error if a station stands for two cities, or a city or a code is missing."""
    bad = [r["station"] for r in stations.groupBy("station").agg(
        F.count("*").alias("n"), F.count("zone").alias("zones")).filter("n > 1 or zones < n or station is null").collect()]
    if bad:  # a row per station of the dimension
        raise ValueError(f"stations without one city each: {sorted(map(str, bad))}")
    return stations.select("zone", "station")


def service_climate(records: DataFrame, stations: DataFrame) -> DataFrame:
    """Records from ``sources.files.read_service_records`` as (zone, station, file, pos, fecha, prec, velmedia, tmed).

    The city comes from the station dimension; records of stations that it doesn't know raise. A file without any
    ``fecha`` is dated by the first 10 characters of ``fecobs``. Of the records of one day the first to arrive counts, within
    a file and between files of a station. Where no file of a station has temperatures at all, the fixed one stands in.
    """
    known = check_stations(stations)
    seen = records.select("station").distinct()
    strange = [r["station"] for r in seen.join(known, "station", "left_anti").collect()]  # station codes
    if strange:
        raise ValueError(f"records of unknown stations: {sorted(map(str, strange))}")
    dated = (records.join(known, "station")
             .withColumn("fecha", F.when(F.col("has_fecha"), F.col("fecha")).otherwise(F.substring("fecobs", 1, 10)))
             .filter(F.col("has_fecha") | F.col("has_fecobs")))
    # of a day the first record of the station, of what is no day the first record of the file
    of = [F.col("station"), F.col("fecha"), F.when(parse_date("fecha").isNull(), F.col("file"))]
    first = (dated.withColumn("_rn", F.row_number().over(Window.partitionBy(*of).orderBy("file", "pos")))
             .filter("_rn = 1"))
    no_temperature = ~F.max("has_tmed").over(Window.partitionBy("station"))
    return first.withColumn("tmed", F.when(no_temperature, F.lit(str(C.MISSING_TEMPERATURE))).otherwise(F.col("tmed"))).select(
        "zone", "station", "file", "pos", "fecha", "prec", "velmedia", "tmed")


def service_weather_daily(records: DataFrame, stations: DataFrame) -> DataFrame:
    """The service's records as daily weather (date, zone, rain, wind, temperature), read in order of arrival."""
    return parse_weather(service_climate(records, stations), order_col=("file", "pos"))


def station_coverage(records: DataFrame, stations: DataFrame) -> DataFrame:
    """Per city of the dimension: files, records, days and the span of valid dates; zeros where nothing arrived."""
    climate = service_climate(records, stations).withColumn("date", parse_date("fecha"))
    days = climate.groupBy("station").agg(F.count_distinct("date").alias("days"), F.min("date").alias("first_day"),
                                          F.max("date").alias("last_day"))
    landed = records.groupBy("station").agg(F.count_distinct("file").alias("files"), F.count("*").alias("records"))
    out = check_stations(stations).join(landed, "station", "left").join(days, "station", "left")
    return out.select("zone", "station", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "records", "days")],
                      "first_day", "last_day")


# ------------------------------------------------------------------ F8-F12, W1, W3, P16
def parse_weather(raw: DataFrame, zone_col: str = "zone", order_col: str | tuple[str, ...] = "obs_seq") -> DataFrame:
    """Station strings -> (date, zone, weather_rain, weather_wind_speed, weather_temperature).

    Rain: 'Ip' -> 0.1, missing -> 0, 1 dp. Wind: missing -> 0, a city whose
    mean wind exceeds 20 is in km/h and is divided by 3.6, 2 dp. Temperature:
    forward-filled in file order (``order_col``) within the city, 1 dp.
    Rows with an invalid date or no temperature yet are dropped afterwards,
    exactly as the reference's pandas pipeline orders these steps.
    """
    cols = set(raw.columns)
    city = Window.partitionBy(zone_col)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    upto = city.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rain = parse_rain("prec") if "prec" in cols else F.lit(0.0)
    wind0 = F.coalesce(parse_decimal_comma("velmedia"), F.lit(0.0)) if "velmedia" in cols else F.lit(0.0)
    temp0 = parse_decimal_comma("tmed") if "tmed" in cols else F.lit(C.MISSING_TEMPERATURE)
    df = raw.select(
        F.col(zone_col).alias("zone"), *order,
        parse_date("fecha").alias("date"),
        rain.alias("_rain"), wind0.alias("_wind"), temp0.alias("_temp"))
    df = df.withColumns({
        "_wind": F.when(F.avg("_wind").over(city) > C.WIND_KMH_MEAN_CUTOFF, F.col("_wind") / F.lit(3.6))
                  .otherwise(F.col("_wind")),
        "_temp": F.last("_temp", ignorenulls=True).over(upto),
    })
    df = df.filter(F.col("date").isNotNull() & F.col("_temp").isNotNull())
    return df.select(
        "date", "zone",
        np_round("_rain", 1).alias("weather_rain"),
        np_round("_wind", 2).alias("weather_wind_speed"),
        np_round("_temp", 1).alias("weather_temperature"))


# ------------------------------------------------------------------ J1 / J2 / P15 / F5 / F6
def enrich_with_weather(deliveries: DataFrame, weather: DataFrame,
                        keys=("date", "zone"), keep_coverage: bool = False) -> DataFrame:
    """Left join daily weather on (date, zone); unmatched rows keep their own values.

    Originals are kept as ``<col>_synthetic``; derived weather flags are added;
    columns are ordered originals, weather, derived, synthetic. Of several weather
    rows of a key the smallest one counts. The weather, a row per key, is written first: by the size of its files
    Spark broadcasts it if it is small, where an estimate from its source would shuffle and sort all deliveries.
    """
    keys = list(keys)
    w = stored(keep_first(weather.select(*keys, *[F.col(c).alias(f"_w_{c}") for c in WEATHER_COLS]), keys,
                          [f"_w_{c}" for c in WEATHER_COLS]), "weather-by-key")
    originals = [c for c in deliveries.columns if c not in WEATHER_COLS]
    present = [c for c in WEATHER_COLS if c in deliveries.columns]
    d = deliveries.withColumns({f"{c}_synthetic": F.col(c) for c in present})
    j = d.join(w, keys, "left")
    if keep_coverage:
        j = j.withColumn("_matched", F.col("_w_weather_rain").isNotNull())
    j = j.withColumns({c: (F.coalesce(F.col(f"_w_{c}"), F.col(c)) if c in present else F.col(f"_w_{c}"))
                       for c in WEATHER_COLS})
    j = j.withColumns(derived_weather(mode="historical"))
    extra = ["_matched"] if keep_coverage else []
    return j.select(*originals, *WEATHER_COLS, *DERIVED_COLS,
                    *[f"{c}_synthetic" for c in present], *extra)


def join_coverage(deliveries: DataFrame, weather: DataFrame, keys=("date", "zone")) -> DataFrame:
    """total / matched / missing and shares of the weather join."""
    j = enrich_with_weather(deliveries, weather, keys, keep_coverage=True)
    return j.agg(F.count("*").alias("total"),
                 F.count_if("_matched").alias("matched")).select(
        "total", "matched", (F.col("total") - F.col("matched")).alias("missing"),
        (F.col("matched") / F.col("total")).alias("matched_share"),
        ((F.col("total") - F.col("matched")) / F.col("total")).alias("missing_share"))


# ------------------------------------------------------------------ A9
VALIDATION_RANGES = (("weather_rain", 0, 200), ("weather_wind_speed", 0, 50),
                     ("weather_temperature", -20, 50))


def enrichment_validation(enriched: DataFrame, target: str = C.TARGET) -> DataFrame:
    """One row: nulls and out-of-range counts per weather column, weather/failure
    correlations (+ rain sign warning) and the shares of the derived flags."""
    aggs = [F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"nulls_{c}") for c in WEATHER_COLS]
    aggs += [F.count_if(~F.isnan(c) & ((F.col(c) < lo) | (F.col(c) > hi))).alias(f"out_of_range_{c}")
             for c, lo, hi in VALIDATION_RANGES]
    # temperatures outside the category span (or missing) get no category: counted, not raised
    aggs += [F.count_if(F.col("temp_category").isNull()).alias("nulls_temp_category")]
    # correlations are reported to 4 decimals, as the reference prints them
    aggs += [np_round(F.corr("weather_rain", F.col(target).cast("double")), 4).alias("corr_rain_failure"),
             np_round(F.corr("weather_wind_speed", F.col(target).cast("double")), 4).alias("corr_wind_failure"),
             F.avg("adverse_weather").alias("share_adverse_weather"),
             F.avg("strong_wind").alias("share_strong_wind"),
             F.avg("feels_like_cold").alias("share_feels_like_cold")]
    return enriched.agg(*aggs).withColumn("rain_sign_warning", F.col("corr_rain_failure") < 0)


# ------------------------------------------------------------------ A7
def zone_weather_means(weather: DataFrame, digits: int = 2) -> DataFrame:
    return weather.groupBy("zone").agg(*[np_round(F.avg(c), digits).alias(c) for c in WEATHER_COLS])


# ------------------------------------------------------------------ S9 / T5 / F27 / J3
def latest_observation(obs: DataFrame, station_col: str = "station", ts_col: str = "obs_ts") -> DataFrame:
    """Latest record per station; prec/vv/ta parsed leniently (missing/junk -> 0.0).

    The maximum is a partial aggregation: each map task forwards one row per station.
    """
    last = F.max(F.struct(ts_col, "prec", "vv", "ta")).alias("_o")  # readings break ties of time
    return (obs.groupBy(station_col).agg(last)
            .select(station_col, F.col(f"_o.{ts_col}").alias(ts_col),
                    lenient_double("_o.prec").alias("weather_rain_raw"),
                    lenient_double("_o.vv").alias("weather_wind_speed_raw"),
                    lenient_double("_o.ta").alias("weather_temperature_raw")))


def city_conditions(latest: DataFrame, stations: DataFrame, strict: bool = False) -> DataFrame:
    """Attach stations' latest raw readings to cities (4-row dimension, broadcast).

    With ``strict`` an unknown city (no station) raises, like the reference lookup.
    """
    j = F.broadcast(stations).join(latest, "station", "left")
    if strict:
        missing = [r["zone"] for r in j.filter(F.col("station").isNull()).select("zone").collect()]
        if missing:
            raise ValueError(f"cities without a station: {missing}")
    return j


# ------------------------------------------------------------------ F7 / F13 / F14
def realtime_features(conditions: DataFrame, scaler_stats: DataFrame | None = None,
                      fallback: bool = False) -> DataFrame:
    """Per city: raw weather + real-time flags; optionally z-scored by scaler stats.

    ``fallback`` gives the all-zeros model-path row for cities with no reading.
    """
    rain, wind, temp = (F.col("weather_rain_raw"), F.col("weather_wind_speed_raw"),
                        F.col("weather_temperature_raw"))
    flags = derived_weather(rain, wind, temp, mode="realtime")
    df = conditions.select("zone", rain.alias("weather_rain"), wind.alias("weather_wind_speed"),
                           temp.alias("weather_temperature"),
                           *[v.alias(k) for k, v in flags.items()],
                           F.col("weather_rain_raw").isNull().alias("_missing"))
    feats = ["weather_rain", "weather_wind_speed", "weather_temperature",
             "strong_wind", "adverse_weather", "temp_category"]
    if scaler_stats is not None:
        df = scale_features(df, scaler_stats, feats)
    if fallback:
        df = df.withColumns({c: F.when(F.col("_missing"), F.lit(0.0)).otherwise(F.col(c)) for c in feats})
    return df.drop("_missing")


def scale_features(df: DataFrame, scaler_stats: DataFrame, features) -> DataFrame:
    """Z-score the listed features that have stats; std <= 0 -> 0; others untouched.

    Stats are one row per feature (a few dozen rows), pivoted to a single row
    and broadcast; attaching a one-row table does not shuffle ``df``.
    """
    feats = [f for f in features if f in df.columns]
    wide = (scaler_stats.filter(F.col("feature").isin(feats))
            .groupBy().pivot("feature", feats).agg(F.first(F.struct("mean", "std"))))
    wide = wide.select(*[F.col(f).alias(f"__s_{f}") for f in feats])
    j = df.crossJoin(F.broadcast(wide))  # exactly one row on the right
    return j.select(*[
        F.when(F.col(f"__s_{c}").isNull(), F.col(c))
         .otherwise(zscore(c, F.col(f"__s_{c}.mean"), F.col(f"__s_{c}.std"))).alias(c)
        if c in feats else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ F15
def display_weather(conditions: DataFrame) -> DataFrame:
    """Per city display values: rain flag (> 5 mm), 1-dp readings, source tag, fallback."""
    r0, w0, t0 = C.DISPLAY_FALLBACK
    has = F.col("weather_rain_raw").isNotNull()
    rain = F.when(has, F.col("weather_rain_raw")).otherwise(F.lit(r0))
    wind = F.when(has, F.col("weather_wind_speed_raw")).otherwise(F.lit(w0))
    temp = F.when(has, F.col("weather_temperature_raw")).otherwise(F.lit(t0))
    return conditions.select(
        F.col("zone").alias("city"),
        F.when(rain > C.ADVERSE_RAIN_MM_REALTIME, F.lit(1)).otherwise(F.lit(0)).alias("weather_rain"),
        np_round(rain, 1).alias("weather_rain_mm"),
        np_round(wind, 1).alias("weather_wind_speed"),
        np_round(temp, 1).alias("weather_temperature"),
        F.when(has, F.lit("aemet")).otherwise(F.lit("fallback")).alias("source"))


# ------------------------------------------------------------------ P7 / J4
def override_weather(deliveries: DataFrame, city_features: DataFrame, feature_cols,
                     city: str | None = None) -> DataFrame:
    """Replace weather features with current conditions.

    Default: per row, by the delivery's own zone (broadcast join on a <= #cities
    table). ``city=`` reproduces the reference, which applies one city's
    conditions to every row. Only features in (weather ∩ feature_cols ∩ columns)
    are touched.
    """
    wcols = [c for c in city_features.columns if c != "zone"]
    touched = [c for c in wcols if c in feature_cols and c in deliveries.columns]
    if not touched:
        return deliveries
    cf = city_features.select("zone", *[F.col(c).alias(f"_cw_{c}") for c in touched])
    if city is not None:
        cf = cf.filter(F.col("zone") == city).drop("zone")
        j = deliveries.crossJoin(F.broadcast(cf))  # at most one row
    else:
        j = deliveries.join(F.broadcast(cf), "zone", "left")
    return j.select(*[F.coalesce(F.col(f"_cw_{c}"), F.col(c)).alias(c) if c in touched else F.col(c)
                      for c in deliveries.columns])
