import pytest
from pyspark.sql import functions as F

from parcelrisk.functions.weather import derived_weather, temp_category, wind_chill
from parcelrisk.operators import weather as WX

RAW_SCHEMA = "zone string, obs_seq int, fecha string, prec string, velmedia string, tmed string"


def test_parse_table(spark):
    raw = spark.createDataFrame([
        ("madrid", 1, "2024-01-01", "0,0", "3,5", None),      # leading null temperature -> dropped
        ("madrid", 2, "2024-01-02", "Ip", "2,2", "5,0"),
        ("madrid", 3, "2024-01-03", "-", None, None),         # rain 0, wind 0, temp forward-filled
        ("madrid", 4, "2024-01-04", "12,4", "x", "-2,0"),
        ("madrid", 5, "bad", "1,0", "1,0", "9,0"),            # invalid date -> dropped
    ], RAW_SCHEMA)
    out = {str(r["date"]): (r["weather_rain"], r["weather_wind_speed"], r["weather_temperature"])
           for r in WX.parse_weather(raw).collect()}
    assert out == {"2024-01-02": (0.1, 2.2, 5.0), "2024-01-03": (0.0, 0.0, 5.0),
                   "2024-01-04": (12.4, 0.0, -2.0)}


def test_ffill_runs_before_invalid_dates_are_dropped(spark):
    raw = spark.createDataFrame([
        ("madrid", 1, "2024-01-01", "0", "1", "4,0"),
        ("madrid", 2, "bad", "0", "1", "7,5"),
        ("madrid", 3, "2024-01-03", "0", "1", None)], RAW_SCHEMA)
    out = {str(r["date"]): r["weather_temperature"] for r in WX.parse_weather(raw).collect()}
    assert out == {"2024-01-01": 4.0, "2024-01-03": 7.5}


def test_kmh_city_is_converted(spark):
    raw = spark.createDataFrame([("sevilla", i, f"2024-01-0{i}", "0", v, "10,0")
                                 for i, v in ((1, "36,0"), (2, "18,0"))] +
                                [("madrid", 1, "2024-01-01", "0", "36,0", "10,0")], RAW_SCHEMA)
    raw = raw.unionByName(spark.createDataFrame([("madrid", 2, "2024-01-02", "0", "1,0", "10,0")], RAW_SCHEMA))
    out = {(r["zone"], str(r["date"])): r["weather_wind_speed"] for r in WX.parse_weather(raw).collect()}
    assert out[("sevilla", "2024-01-01")] == 10.0 and out[("sevilla", "2024-01-02")] == 5.0
    assert out[("madrid", "2024-01-01")] == 36.0   # mean 18.5 <= 20: already m/s


@pytest.mark.parametrize("t,right,left", [(5.0, 0, 1.0), (5.01, 1, 1.0), (15.0, 1, 2.0), (25.0, 2, 3.0),
                                          (-999.0, None, 0.0), (30.0, 3, 3.0)])
def test_temp_category_closures(spark, t, right, left):
    r = spark.range(1).select(temp_category(F.lit(t), "right").alias("r"),
                              temp_category(F.lit(t), "left").alias("l")).first()
    assert r["r"] == right and r["l"] == left


def test_derived_flags_boundaries(spark):
    df = spark.createDataFrame([(2.0, 10.0, 20.0), (2.1, 3.0, 20.0), (0.0, 10.1, 20.0)],
                               "weather_rain double, weather_wind_speed double, weather_temperature double")
    out = df.select(*[v.alias(k) for k, v in derived_weather().items()]).collect()
    assert [(r["strong_wind"], r["adverse_weather"]) for r in out] == [(0, 0), (0, 1), (1, 1)]
    rt = spark.createDataFrame([(5.0, 1.0, 0.0)], "weather_rain double, weather_wind_speed double, "
                               "weather_temperature double")
    r = rt.select(*[v.alias(k) for k, v in derived_weather(mode="realtime").items()]).first()
    assert r["adverse_weather"] == 0.0 and r["strong_wind"] == 0.0


@pytest.mark.parametrize("t,v,expected,cold", [(-2, 5, -7.4375, 1), (3, 8, -2.4445, 1), (1, 2, -1.3079, 1),
                                               (5, 0, 16.2275, 0), (10, 15, 10.0, 0)])
def test_feels_like(spark, t, v, expected, cold):
    df = spark.createDataFrame([(float(t), float(v))], "weather_temperature double, weather_wind_speed double")
    r = df.select(wind_chill("weather_temperature", "weather_wind_speed").alias("fl"),
                  derived_weather(F.lit(0.0))["feels_like_cold"].alias("c")).first()
    assert round(r["fl"], 4) == pytest.approx(expected, abs=1e-4)
    assert r["c"] == cold


def test_enrich_fallback_and_columns(spark):
    d = spark.createDataFrame([("a", "2024-01-01", "madrid", 1.0, 3.0, 10.0),
                               ("b", "2024-01-02", "madrid", 0.0, 4.0, 11.0)],
                              "delivery_id string, date string, zone string, weather_rain double, "
                              "weather_wind_speed double, weather_temperature double")
    w = spark.createDataFrame([("2024-01-01", "madrid", 7.5, 12.0, 1.0)],
                              "date string, zone string, weather_rain double, weather_wind_speed double, "
                              "weather_temperature double")
    e = WX.enrich_with_weather(d, w)
    assert e.columns[:2] == ["delivery_id", "date"]
    assert e.columns[-3:] == ["weather_rain_synthetic", "weather_wind_speed_synthetic",
                              "weather_temperature_synthetic"]
    got = {r["delivery_id"]: (r["weather_rain"], r["strong_wind"], r["adverse_weather"]) for r in e.collect()}
    assert got == {"a": (7.5, 1, 1), "b": (0.0, 0, 0)}
    cov = WX.join_coverage(d, w).first()
    assert (cov["total"], cov["matched"], cov["missing"]) == (2, 1, 1)


def test_weather_override_touches_only_named_columns(spark):
    d = spark.createDataFrame([("a", "madrid", 0.0, 3.0, 10.0, 7)],
                              "delivery_id string, zone string, weather_rain double, weather_wind_speed double, "
                              "weather_temperature double, hour int")
    cf = spark.createDataFrame([("madrid", 9.0, 1.0, 2.0)],
                               "zone string, weather_rain double, weather_wind_speed double, strong_wind double")
    out = WX.override_weather(d, cf, feature_cols=["weather_rain", "strong_wind", "hour"]).first()
    assert out["weather_rain"] == 9.0          # named, present -> overridden
    assert out["weather_wind_speed"] == 3.0    # not in feature_cols -> untouched
    assert out["hour"] == 7 and "strong_wind" not in out.asDict()  # absent column is not added
    one = WX.override_weather(d.withColumn("zone", F.lit("sevilla")), cf, ["weather_rain"], city="madrid").first()
    assert one["weather_rain"] == 9.0          # single-city mode applies madrid to every row


def test_display_fallback_and_strict_station_lookup(spark):
    stations = spark.createDataFrame([("madrid", "3195"), ("bilbao", "1082")], "zone string, station string")
    obs = spark.createDataFrame([("3195", "2024-01-01 08:00:00", "6.24", "3.1", "n/a"),
                                 ("3195", "2024-01-01 09:00:00", "0.0", "x", "12.26")],
                                "station string, obs_ts string, prec string, vv string, ta string")
    obs = obs.withColumn("obs_ts", F.to_timestamp("obs_ts"))
    cond = WX.city_conditions(WX.latest_observation(obs), stations)
    got = {r["city"]: r for r in WX.display_weather(cond).collect()}
    m = got["madrid"]   # latest reading: rain 0.0, wind 'x' -> 0.0, temperature 12.26 -> 12.3
    assert (m["weather_rain"], m["weather_rain_mm"], m["weather_wind_speed"], m["weather_temperature"],
            m["source"]) == (0, 0.0, 0.0, 12.3, "aemet")
    b = got["bilbao"]   # no station readings -> display fallback
    assert (b["weather_rain_mm"], b["weather_wind_speed"], b["weather_temperature"], b["source"]) == \
        (0.0, 2.0, 18.0, "fallback")
    rt = {r["zone"]: r for r in WX.realtime_features(cond, fallback=True).collect()}
    assert rt["bilbao"]["weather_temperature"] == 0.0 and rt["madrid"]["weather_temperature"] == 12.26
    unknown = spark.createDataFrame([("paris", None)], "zone string, station string")
    with pytest.raises(ValueError, match="paris"):
        WX.city_conditions(WX.latest_observation(obs), unknown, strict=True)
