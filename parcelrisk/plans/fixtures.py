"""Delivery-shaped views derived from the driver's tables.

``deliveries`` = lineitem ⋈ orders ⋈ supplier, one row per line item, mapped
onto the 23-column delivery contract. Everything is a lazy DataFrame, so the
scans only read the columns each query needs and the joins are planned by
Catalyst (lineitem ⋈ orders is a large-large join and stays a shuffle join;
supplier is a dimension that AQE broadcasts when its measured size allows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.calendar import day_of_week, is_holiday, is_retry, package_flags
from parcelrisk.functions.common import flag
from parcelrisk.sources.tables import read_table

# --- fixed values: mapping of the driver's tables onto deliveries ----------------
ZONE_BY_MOD4 = ("madrid", "barcelona", "valencia", "sevilla")
ZONE_TYPE_BY_MOD4 = ("residential", "historic_center", "offices", "industrial")
# o_orderpriority leading digit 1..5
PRODUCT_BY_PRIORITY = ("standard", "fragile", "bulky", "high_value", "signature_required")
# columns that fix the ingest ("first row") order of raw deliveries
INGEST_ORDER = ("src_partkey", "src_suppkey", "src_price")
# the stations' weather arrives in km/h for this city (exercises unit detection)
KMH_CITY = "barcelona"


def _pick(values, idx0: Column) -> Column:
    """values[idx0] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx0 + 1).cast("int"))


def deliveries(spark: SparkSession, sf_dir: str, with_ingest_order: bool = True) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(s, l.l_suppkey == s.s_suppkey)

    date = F.col("l_shipdate").cast("date")
    attempts = ((F.col("l_linenumber") - 1) % 4).cast("int")
    product = _pick(PRODUCT_BY_PRIORITY, F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    j = j.select(
        F.concat(F.lit("dlv_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("delivery_id"),
        date.alias("date"),
        (F.lit(8) + F.col("l_partkey") % 11).cast("int").alias("hour"),
        day_of_week(date).alias("day_of_week"),
        is_holiday(date).alias("is_holiday"),
        _pick(ZONE_BY_MOD4, F.col("l_suppkey") % 4).alias("zone"),
        _pick(ZONE_TYPE_BY_MOD4, F.col("l_partkey") % 4).alias("zone_type"),
        F.col("o_custkey").alias("recipient_id"),
        (F.col("l_discount") * F.lit(10.0)).alias("recipient_failure_rate"),
        attempts.alias("num_previous_attempts"),
        F.concat(F.lit("driver_"), F.col("l_suppkey").cast("string")).alias("driver_id"),
        ((F.col("s_acctbal") + F.lit(1000.0)) / F.lit(11000.0)).alias("driver_quality_score"),
        (F.lit(5) + F.col("l_partkey") % 55).cast("int").alias("driver_delivery_load"),
        product.alias("product_type"),
        F.col("l_quantity").alias("weight_kg"),
        F.when(F.col("l_linenumber") % 5 == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("weather_rain"),
        (F.col("l_tax") * F.lit(100.0)).alias("weather_wind_speed"),
        (F.col("l_quantity") - F.lit(10.0)).alias("weather_temperature"),
        flag(F.col("l_returnflag") == "R").alias("delivery_failed"),
        F.col("l_partkey").alias("src_partkey"),
        F.col("l_suppkey").alias("src_suppkey"),
        F.col("l_extendedprice").alias("src_price"),
    )
    flags = package_flags("product_type")
    j = j.withColumns({**flags, "is_retry": is_retry("num_previous_attempts")})
    cols = list(C.DELIVERY_COLUMNS) + (list(INGEST_ORDER) if with_ingest_order else [])
    return j.select(*cols)


def deliveries_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with injected range/weather violations, NULL and NaN in ruled columns.

    Critical columns only receive out-of-range values (never NULL/NaN), so the
    null gate passes and the range rules decide.
    """
    d = deliveries(spark, sf_dir)
    pk = F.col("src_partkey")
    return d.withColumns({
        "weather_temperature": F.when(pk % 97 == 0, F.lit(55.0))
            .when(pk % 89 == 0, F.lit(47.0)).otherwise(F.col("weather_temperature")),
        "weather_wind_speed": F.when(pk % 79 == 0, F.lit(41.0)).otherwise(F.col("weather_wind_speed")),
        "weight_kg": F.when(pk % 73 == 0, F.lit(0.0))
            .when(pk % 61 == 0, F.lit(float("nan"))).otherwise(F.col("weight_kg")),
        "hour": F.when(pk % 71 == 0, F.lit(24)).otherwise(F.col("hour")),
        "num_previous_attempts": F.when(pk % 67 == 0, F.lit(None).cast("int"))
            .otherwise(F.col("num_previous_attempts")),
        "recipient_failure_rate": F.when(pk % 59 == 0, F.lit(1.5))
            .otherwise(F.col("recipient_failure_rate")),
        "weather_rain": F.when(pk % 53 == 0, F.lit(250.0)).otherwise(F.col("weather_rain")),
    })


def deliveries_repeated(spark: SparkSession, sf_dir: str, with_ingest_order: bool = True) -> DataFrame:
    """Deliveries of which some came twice, word for word, as of a file that was landed again."""
    d = deliveries(spark, sf_dir)
    cols = d.columns if with_ingest_order else [c for c in d.columns if c not in INGEST_ORDER]
    copies = F.when(F.col("src_partkey") % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.withColumn("_copy", F.explode(copies)).select(*cols)


def deliveries_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with NULL/NaN in critical columns (trips the null gate)."""
    d = deliveries(spark, sf_dir)
    pk = F.col("src_partkey")
    return d.withColumns({
        "weather_rain": F.when(pk % 101 == 0, F.lit(None).cast("double")).otherwise(F.col("weather_rain")),
        "weather_wind_speed": F.when(pk % 103 == 0, F.lit(float("nan"))).otherwise(F.col("weather_wind_speed")),
        "delivery_failed": F.when(pk % 107 == 0, F.lit(None).cast("int")).otherwise(F.col("delivery_failed")),
    })


def _order_weather_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderdate", "o_custkey", "o_totalprice")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("date"),
                      _pick(ZONE_BY_MOD4, F.col("o_custkey") % 4).alias("zone"))
             .agg(F.min("o_totalprice").alias("min_tp"), F.max("o_totalprice").alias("max_tp")))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per (date, zone), derived from orders. Small: days x 4 zones."""
    b = _order_weather_base(spark, sf_dir)
    rain10 = F.greatest(F.floor(F.col("min_tp") * 10) % 300 - 200, F.lit(0))
    return b.select(
        "date", "zone",
        (rain10 / F.lit(10.0)).alias("weather_rain"),
        ((F.floor("max_tp") % 150) / F.lit(10.0)).alias("weather_wind_speed"),
        ((F.floor(F.col("max_tp") * 10) % 450) / F.lit(10.0) - F.lit(5.0)).alias("weather_temperature"),
    )


def _comma_text(tenths: Column) -> Column:
    """Integer tenths -> '12,4' / '-2,0' (decimal comma)."""
    a = F.abs(tenths)
    return F.concat(F.when(tenths < 0, F.lit("-")).otherwise(F.lit("")),
                    F.floor(a / 10).cast("string"), F.lit(","), (a % 10).cast("string"))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station daily-climate records as strings, the way the weather service lands them.

    Decimal commas, 'Ip' trace rain, '-' and junk, NULL temperatures, invalid
    dates, and one city reporting wind in km/h. ``obs_seq`` is the file order.
    """
    b = _order_weather_base(spark, sf_dir)
    st = F.create_map(*[F.lit(x) for kv in C.STATIONS for x in kv])
    m10 = F.floor(F.col("min_tp") * 10)
    x10 = F.floor(F.col("max_tp") * 10)
    rain10 = F.greatest(m10 % 300 - 200, F.lit(0))
    wind10 = F.floor("max_tp") % 150
    temp10 = x10 % 450 - 50
    kmh100 = wind10 * 36  # km/h with two decimals, as integer hundredths
    wind_kmh_text = F.concat(F.floor(kmh100 / 100).cast("string"), F.lit(","),
                             F.lpad((kmh100 % 100).cast("string"), 2, "0"))
    return b.select(
        st[F.col("zone")].alias("station"),
        F.col("zone"),
        F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).alias("obs_seq"),
        F.when(x10 % 211 == 0, F.lit("bad")).otherwise(F.col("date").cast("string")).alias("fecha"),
        F.when(m10 % 17 == 0, F.lit("Ip")).when(m10 % 19 == 0, F.lit("-"))
         .when(m10 % 23 == 0, F.lit(None).cast("string")).otherwise(_comma_text(rain10)).alias("prec"),
        F.when(x10 % 29 == 0, F.lit("x"))
         .when(F.col("zone") == KMH_CITY, wind_kmh_text).otherwise(_comma_text(wind10)).alias("velmedia"),
        F.when(x10 % 7 == 0, F.lit(None).cast("string")).otherwise(_comma_text(temp10)).alias("tmed"),
    )


def land_service_replies(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The raw station records as the weather service replies: an array of records per station and half-year.

    Every thirteenth day comes twice, the second time with other readings; one city's second half-years are dated by
    ``fecobs`` only; Sevilla's replies are empty. Files lie under station=<code>/period=<half-year>/.
    """
    raw = weather_raw(spark, sf_dir).filter(F.col("zone") != "sevilla")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("obs_seq"))
    half = F.concat(F.year(day), F.when(F.month(day) <= 6, F.lit("a")).otherwise(F.lit("b")))
    by_time = (F.col("zone") == "valencia") & (F.month(day) > 6)
    record = F.struct(F.when(~by_time, F.col("fecha")).alias("fecha"), F.when(by_time, F.concat("fecha", F.lit("T06:00:00"))).alias("fecobs"),
                      "prec", "velmedia", "tmed")
    again = F.struct(record["fecha"].alias("fecha"), record["fecobs"].alias("fecobs"), F.lit("99,9").alias("prec"),
                     F.lit("88,8").alias("velmedia"), F.lit("77,7").alias("tmed"))
    twice = F.when(F.col("obs_seq") % 13 == 0, F.array(record, again)).otherwise(F.array(record))
    replies = (raw.select("station", half.alias("period"), "obs_seq", F.posexplode(twice).alias("k", "r"))
               .groupBy("station", "period")
               .agg(F.array_sort(F.collect_list(F.struct("obs_seq", "k", "r"))).alias("rs"))   # half a year of days
               .select("station", "period", F.to_json(F.transform("rs", lambda x: x["r"])).alias("value")))
    none = spark.createDataFrame([(dict(C.STATIONS)["sevilla"], "1992a", "[]")], "station string, period string, value string")
    replies.unionAll(none).write.partitionBy("station", "period").text(f"{base}/replies")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current station observations (station, obs_ts, prec, vv, ta as text) from events."""
    e = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    st = F.element_at(F.array(*[F.lit(s) for _, s in C.STATIONS]), (F.col("user_id") % 4 + 1).cast("int"))
    v100 = F.floor(F.col("value") * 100)
    return e.select(
        st.alias("station"),
        F.col("ts").cast("timestamp").alias("obs_ts"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
         .otherwise(F.concat(F.floor((v100 % 900) / 100).cast("string"), F.lit("."),
                             F.lpad((v100 % 100).cast("string"), 2, "0"))).alias("prec"),
        F.concat(F.floor((v100 % 1500) / 100).cast("string"), F.lit("."),
                 F.lpad((v100 % 10).cast("string"), 1, "0")).alias("vv"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
         .otherwise((F.floor(F.col("value")) % 40 - 5).cast("string")).alias("ta"),
    )


# --- fixed values: models that were stored as tables (see ``operators.model_tables``) ---------------
STORED_LINEAR = [
    (-1, "(intercept)", 0.0, 1.0, -1.2), (0, "recipient_failure_rate", 0.5, 0.3, 0.8), (1, "driver_quality_score", 0.5, 0.3, -0.4),
    (2, "weather_rain", 0.2, 0.4, 0.15), (3, "weight_kg", 25.0, 14.0, 0.25), (4, "num_previous_attempts", 1.0, 1.0, 0.3),
    (5, "is_retry", 1.0, 0.0, 9.0)]
STORED_TREES = [
    (0, 1.0, 0, "recipient_failure_rate", 0.45, 1, 2, 0.4, 0.02, 100, 100.0), (0, 1.0, 1, None, None, None, None, 0.25, None, 60, 60.0),
    (0, 1.0, 2, "weight_kg", 30.0, 3, 4, 0.5, 0.01, 40, 40.0), (0, 1.0, 3, None, None, None, None, 0.5, None, 25, 25.0),
    (0, 1.0, 4, None, None, None, None, 0.875, None, 15, 15.0),
    (1, 0.5, 0, "hour", 12.0, 1, 2, 0.3, 0.02, 100, 100.0), (1, 0.5, 1, "driver_quality_score", 0.2, 3, 4, 0.3, 0.01, 50, 50.0),
    (1, 0.5, 2, None, None, None, None, 0.125, None, 50, 50.0), (1, 0.5, 3, None, None, None, None, 0.75, None, 10, 10.0),
    (1, 0.5, 4, None, None, None, None, 0.375, None, 40, 40.0), (2, 2.0, 0, None, None, None, None, 0.0625, None, 100, 100.0)]


def stations(spark: SparkSession) -> DataFrame:
    """City -> station dimension (4 rows, fixed)."""
    return spark.createDataFrame(list(C.STATIONS), "zone string, station string")
