"""The weather service's replies: arrays of records without city or sequence, through to daily weather."""

import datetime as dt
import json

import pytest

from parcelrisk.operators import weather as WX
from parcelrisk.sources.files import read_service_records

STATIONS = [("madrid", "3195"), ("barcelona", "0076"), ("valencia", "8416"), ("sevilla", "5783")]


@pytest.fixture
def land(spark, tmp_path):
    """Writes replies (file name -> value) and reads them as records."""
    def go(**files):
        for name, value in files.items():
            (tmp_path / f"{name.removeprefix('s')}.json").write_text(value if isinstance(value, str) else json.dumps(value))
        return read_service_records(spark, str(tmp_path))
    return go


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(STATIONS, "zone string, station string")


def day(d, prec="0,0", velmedia="1,0", tmed="10,0", **more):
    return {"fecha": d, "prec": prec, "velmedia": velmedia, "tmed": tmed, "indicativo": "x", **more}


def daily(records, stations):
    return sorted((str(r["date"]), r["zone"], r["weather_rain"], r["weather_wind_speed"], r["weather_temperature"])
                  for r in WX.service_weather_daily(records, stations).collect())


def test_arrays_go_through_in_order_of_arrival(land, stations):
    """The first of a repeated day counts, and temperatures are carried on in the order of files and of places in them."""
    records = land(**{
        "s3195_2024-01-01": [day("2024-01-02", tmed="5,5"), day("2024-01-01", tmed=None), day("2024-01-02", prec="9,9", tmed="7,0")],
        "s3195_2024-07-01": [day("2024-07-01", tmed=None, prec="Ip"), day("2024-01-01", prec="8,8")]})
    assert daily(records, stations) == [("2024-01-01", "madrid", 0.0, 1.0, 5.5), ("2024-01-02", "madrid", 0.0, 1.0, 5.5),
                                        ("2024-07-01", "madrid", 0.1, 1.0, 5.5)]


def test_dates_fall_back_to_the_time_of_observation_by_file(land, stations):
    """Only where a file has no fecha at all; a missing fecha among others is no date."""
    def timed(d):
        r = day(None)
        del r["fecha"]
        return {**r, "fecobs": f"{d}T06:00:00"}
    records = land(**{"s0076_2024-01-01": [timed("2024-01-01"), timed("2024-01-01"), timed("2024-01-02")],
                      "s0076_2024-07-01": [day("2024-07-01"), {**timed("2024-07-02"), "fecha": None}],
                      "s0076_2025-01-01": [{"prec": "1,0", "tmed": "3,0"}]})
    assert [r[0] for r in daily(records, stations)] == ["2024-01-01", "2024-01-02", "2024-07-01"]


def test_fields_that_a_station_never_has(land, stations):
    """Without temperatures the fixed one, without wind and rain none; numbers may stand without quotes."""
    records = land(s8416_a=[{"fecha": "2024-01-01", "prec": 1.26}], s5783_a=[{"fecha": "2024-01-01", "tmed": 7, "velmedia": 50}])
    assert daily(records, stations) == [("2024-01-01", "sevilla", 0.0, 13.89, 7.0), ("2024-01-01", "valencia", 1.3, 0.0, 15.0)]


def test_replies_that_are_no_records(land, stations):
    records = land(s3195_a='{"descripcion": "No hay datos", "estado": 404}', s0076_a="[]", s8416_a="[{oops", s5783_a=[day("2024-02-30"), day("2024-03-01")])
    assert daily(records, stations) == [("2024-03-01", "sevilla", 0.0, 1.0, 10.0)]


def test_coverage_shows_stations_without_readings(land, stations):
    records = land(**{"s3195_a": [day("2024-01-01"), day("2024-01-01"), day("bad"), day("2024-01-03")], "s3195_b": [day("2024-07-01")], "s0076_a": "[]"})
    got = {r["zone"]: tuple(r)[2:] for r in WX.station_coverage(records, stations).collect()}
    assert got["madrid"] == (2, 5, 3, dt.date(2024, 1, 1), dt.date(2024, 7, 1))
    assert got["barcelona"] == got["valencia"] == got["sevilla"] == (0, 0, 0, None, None)


def test_station_dimension_is_checked(spark, land, stations):
    records = land(s9999_a=[day("2024-01-01")])
    with pytest.raises(ValueError, match="unknown stations.*9999"):
        WX.service_weather_daily(records, stations)
    twice = stations.unionAll(spark.createDataFrame([("toledo", "3195")], stations.schema))
    with pytest.raises(ValueError, match="3195"):
        WX.check_stations(twice)
    with pytest.raises(ValueError, match="None"):
        WX.check_stations(spark.createDataFrame([("madrid", None)], stations.schema))


def test_daily_weather_joins_deliveries(spark, land, stations):
    records = land(s3195_a=[day("2024-01-01", prec="3,0", velmedia="2,0", tmed="4,0")])
    deliveries = spark.createDataFrame([(1, dt.date(2024, 1, 1), "madrid", 0.0, 0.0, 20.0), (2, dt.date(2024, 1, 1), "sevilla", 0.5, 1.0, 21.0)],
                                       "delivery_id long, date date, zone string, weather_rain double, weather_wind_speed double, weather_temperature double")
    got = {r["delivery_id"]: (r["weather_rain"], r["weather_temperature"], r["adverse_weather"])
           for r in WX.enrich_with_weather(deliveries, WX.service_weather_daily(records, stations)).collect()}
    assert got == {1: (3.0, 4.0, 1), 2: (0.5, 21.0, 0)}
