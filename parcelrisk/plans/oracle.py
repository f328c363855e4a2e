"""DuckDB oracle SQL for the query catalog (independent re-statement of each query)."""

from __future__ import annotations

from parcelrisk.plans.oracle_views import with_views as W

ORACLE: dict[str, str] = {}

BUSINESS = ("delivery_id, date, hour, day_of_week, is_holiday, zone, zone_type, recipient_id, "
            "recipient_failure_rate, num_previous_attempts, driver_id, driver_quality_score, "
            "driver_delivery_load, product_type, requires_signature, is_fragile, is_bulky, "
            "weight_kg, weather_rain, weather_wind_speed, weather_temperature, is_retry, "
            "delivery_failed")
TRACE = "src_partkey, src_suppkey, src_price"


def _ok(expr: str) -> str:
    return f"coalesce({expr}, false)"


def _num_ok(c: str, lo=None, hi=None) -> str:
    e = f"NOT isnan(CAST({c} AS DOUBLE))"
    if lo is not None:
        e += f" AND {c} >= {lo}"
    if hi is not None:
        e += f" AND {c} <= {hi}"
    return _ok(f"({e})")


RANGE_OK = {
    "weather_temperature": _num_ok("weather_temperature", "-20.0::DOUBLE", "50.0::DOUBLE"),
    "weather_wind_speed": _num_ok("weather_wind_speed", "0.0::DOUBLE"),
    "weather_rain": _num_ok("weather_rain", "0.0::DOUBLE"),
    "recipient_failure_rate": _num_ok("recipient_failure_rate", "0.0::DOUBLE", "1.0::DOUBLE"),
    "driver_quality_score": _num_ok("driver_quality_score", "0.0::DOUBLE", "1.0::DOUBLE"),
    "weight_kg": _num_ok("weight_kg", "0.001::DOUBLE"),
    "hour": _num_ok("hour", "0", "23"),
    "num_previous_attempts": _num_ok("num_previous_attempts", "0"),
}
METEO_OK = {
    "weather_wind_speed": _num_ok("weather_wind_speed", None, "40.0::DOUBLE"),
    "weather_temperature": _num_ok("weather_temperature", None, "45.0::DOUBLE"),
    "weather_rain": _num_ok("weather_rain", None, "200.0::DOUBLE"),
}
ALL_RANGE = " AND ".join(RANGE_OK.values())
ALL_METEO = " AND ".join(METEO_OK.values())

KEEP_FIRST = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id "
              "ORDER BY src_partkey, src_suppkey, src_price) AS _rn FROM {src}) WHERE _rn = 1")

# ------------------------------------------------------------------ quality layer
ORACLE["dedup_keep_first"] = W(f"SELECT {BUSINESS} FROM ({KEEP_FIRST.format(src='deliveries')})",
                               "deliveries")

ORACLE["dedup_exact"] = W(f"SELECT DISTINCT {BUSINESS} FROM deliveries", "deliveries")

ORACLE["dedup_counts"] = W(f"""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {BUSINESS} FROM deliveries)) AS BIGINT) AS dropped_row_dups,
  CAST((SELECT count(*) FROM (SELECT DISTINCT {BUSINESS} FROM deliveries))
       - count(DISTINCT delivery_id) AS BIGINT) AS dropped_id_dups,
  CAST(count(DISTINCT delivery_id) AS BIGINT) AS rows_after_dedup
FROM deliveries""", "deliveries")

ORACLE["cast_flags"] = W(f"""
SELECT delivery_id, {TRACE},
  CAST(product_type = 'signature_required' AS DOUBLE) AS requires_signature,
  CAST(product_type = 'fragile' AS DOUBLE) AS is_fragile,
  CAST(product_type = 'bulky' AS DOUBLE) AS is_bulky,
  CAST(num_previous_attempts > 0 AS DOUBLE) AS is_retry
FROM deliveries""", "deliveries")

ORACLE["critical_null_counts"] = W("""
SELECT
  CAST(count(*) FILTER (WHERE delivery_failed IS NULL) AS BIGINT) AS nulls_delivery_failed,
  CAST(count(*) FILTER (WHERE recipient_failure_rate IS NULL OR isnan(recipient_failure_rate)) AS BIGINT) AS nulls_recipient_failure_rate,
  CAST(count(*) FILTER (WHERE driver_quality_score IS NULL OR isnan(driver_quality_score)) AS BIGINT) AS nulls_driver_quality_score,
  CAST(count(*) FILTER (WHERE weather_rain IS NULL OR isnan(weather_rain)) AS BIGINT) AS nulls_weather_rain,
  CAST(count(*) FILTER (WHERE weather_wind_speed IS NULL OR isnan(weather_wind_speed)) AS BIGINT) AS nulls_weather_wind_speed,
  CAST(count(*) FILTER (WHERE weather_temperature IS NULL OR isnan(weather_temperature)) AS BIGINT) AS nulls_weather_temperature,
  CAST(count(DISTINCT delivery_failed) AS BIGINT) AS n_classes,
  CAST(count(*) AS BIGINT) AS n_rows,
  CAST(sum(delivery_failed) AS BIGINT) AS failures,
  avg(CAST(delivery_failed AS DOUBLE)) AS failure_rate
FROM deliveries_gaps""", "deliveries_gaps")

ORACLE["class_counts"] = W("""
SELECT delivery_failed AS label, CAST(count(*) AS BIGINT) AS n FROM deliveries_gaps GROUP BY 1""",
                           "deliveries_gaps")

ORACLE["range_filtered"] = W(f"SELECT * FROM deliveries_dirty WHERE {ALL_RANGE}", "deliveries_dirty")

ORACLE["range_report"] = W(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE NOT {ok}) AS BIGINT) AS n_bad "
        f"FROM deliveries_dirty" for c, ok in RANGE_OK.items()) + ") WHERE n_bad > 0",
    "deliveries_dirty")

ORACLE["weather_consistent"] = W(f"SELECT * FROM deliveries_dirty WHERE {ALL_METEO}", "deliveries_dirty")

_DEDUP_DIRTY = KEEP_FIRST.format(src="deliveries_dirty")

ORACLE["silver_audit"] = W(f"""
SELECT rows_in, rows_out, rows_in - rows_out AS dropped_total, dropped_row_dups, dropped_id_dups,
  dropped_ranges, dropped_meteo, (rows_in - rows_out) / CAST(rows_in AS DOUBLE) AS drop_ratio,
  failure_rate, failures
FROM (
  SELECT
    (SELECT CAST(count(*) AS BIGINT) FROM deliveries_dirty) AS rows_in,
    (SELECT CAST(count(*) AS BIGINT) FROM deliveries_dirty)
      - (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {BUSINESS} FROM deliveries_dirty)) AS dropped_row_dups,
    (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {BUSINESS} FROM deliveries_dirty))
      - (SELECT CAST(count(DISTINCT delivery_id) AS BIGINT) FROM deliveries_dirty) AS dropped_id_dups,
    CAST(count(*) FILTER (WHERE NOT ({ALL_RANGE})) AS BIGINT) AS dropped_ranges,
    CAST(count(*) FILTER (WHERE ({ALL_RANGE}) AND NOT ({ALL_METEO})) AS BIGINT) AS dropped_meteo,
    CAST(count(*) FILTER (WHERE ({ALL_RANGE}) AND ({ALL_METEO})) AS BIGINT) AS rows_out,
    CAST(sum(delivery_failed) FILTER (WHERE ({ALL_RANGE}) AND ({ALL_METEO})) AS BIGINT) AS failures,
    avg(CAST(delivery_failed AS DOUBLE)) FILTER (WHERE ({ALL_RANGE}) AND ({ALL_METEO})) AS failure_rate
  FROM ({_DEDUP_DIRTY}))""", "deliveries_dirty")

ORACLE["silver_clean"] = W(f"""
SELECT {BUSINESS} FROM ({_DEDUP_DIRTY}) WHERE ({ALL_RANGE}) AND ({ALL_METEO})""", "deliveries_dirty")


def _int_ok(c, lo=None, hi=None):
    e = f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) AND CAST({c} AS DOUBLE) = floor(CAST({c} AS DOUBLE))"
    if lo is not None:
        e += f" AND CAST({c} AS DOUBLE) >= {lo}"
    if hi is not None:
        e += f" AND CAST({c} AS DOUBLE) <= {hi}"
    return _ok(f"({e})")


def _flt_ok(c, lo=None, hi=None, strict=False):
    e = f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
    if lo is not None:
        e += f" AND CAST({c} AS DOUBLE) {'>' if strict else '>='} {lo}"
    if hi is not None:
        e += f" AND CAST({c} AS DOUBLE) <= {hi}"
    return _ok(f"({e})")


def _dom(c, vals):
    return _ok(f"({c} IN ({', '.join(repr(v) for v in vals)}))")


CONTRACT = [
    ("delivery_id", "delivery_id IS NOT NULL"),
    ("hour", _int_ok("hour", 0, 23)),
    ("day_of_week", _int_ok("day_of_week", 0, 6)),
    ("is_holiday", _int_ok("is_holiday", 0, 1)),
    ("zone", _dom("zone", ("madrid", "barcelona", "valencia", "sevilla"))),
    ("zone_type", _dom("zone_type", ("residential", "historic_center", "offices", "industrial"))),
    ("recipient_failure_rate", _flt_ok("recipient_failure_rate", 0, 1)),
    ("num_previous_attempts", _int_ok("num_previous_attempts", 0)),
    ("driver_quality_score", _flt_ok("driver_quality_score", 0, 1)),
    ("driver_delivery_load", _int_ok("driver_delivery_load", 0)),
    ("product_type", _dom("product_type", ("standard", "fragile", "bulky", "high_value", "signature_required"))),
    ("requires_signature", _int_ok("requires_signature", 0, 1)),
    ("is_fragile", _int_ok("is_fragile", 0, 1)),
    ("is_bulky", _int_ok("is_bulky", 0, 1)),
    ("weight_kg", _flt_ok("weight_kg", 0, None, strict=True)),
    ("weather_rain", _int_ok("weather_rain", 0, 1)),
    ("weather_wind_speed", _flt_ok("weather_wind_speed")),
    ("weather_temperature", _flt_ok("weather_temperature")),
    ("is_retry", _int_ok("is_retry", 0, 1)),
]
_VIOL = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({ok}) THEN '{n}' END" for n, ok in CONTRACT) + ")"
_NVIOL = " + ".join(f"CASE WHEN NOT ({ok}) THEN 1 ELSE 0 END" for n, ok in CONTRACT)

ORACLE["row_contract_violations"] = W(f"""
SELECT delivery_id, {TRACE}, violations, n_violations FROM (
  SELECT delivery_id, {TRACE}, {_VIOL} AS violations, CAST({_NVIOL} AS INTEGER) AS n_violations
  FROM (SELECT * REPLACE (coalesce(weather_rain, 0.0::DOUBLE) AS weather_rain,
          coalesce(weather_wind_speed, 0.0::DOUBLE) AS weather_wind_speed,
          coalesce(weather_temperature, 15.0::DOUBLE) AS weather_temperature) FROM deliveries_dirty))
WHERE n_violations > 0""", "deliveries_dirty")


# ------------------------------------------------------------------ weather layer
def _rnd(x: str, d: int) -> str:
    """NumPy-style half-even rounding of the binary value."""
    s = f"{10 ** d}.0::DOUBLE"
    return f"(round_even(({x}) * {s}, 0) / {s})"


def _pd(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}), ',', '.') AS DOUBLE)"


_NN = "CASE WHEN isnan({0}) THEN NULL ELSE {0} END"


def _hist_flags(r: str, w: str, t: str) -> str:
    r, w, t = _NN.format(r), _NN.format(w), _NN.format(t)
    p = f"pow(({w}) * 3.6::DOUBLE, 0.16::DOUBLE)"
    chill = (f"CASE WHEN ({t}) < 10 THEN 13.12::DOUBLE + 0.6215::DOUBLE * ({t}) - 11.37::DOUBLE * {p} "
             f"+ 0.3965::DOUBLE * ({t}) * {p} ELSE ({t}) END")
    return f"""
  CASE WHEN ({w}) > 10.0::DOUBLE THEN 1 ELSE 0 END AS strong_wind,
  CASE WHEN ({r}) > 2.0::DOUBLE OR ({w}) > 10.0::DOUBLE THEN 1 ELSE 0 END AS adverse_weather,
  CASE WHEN ({t}) > -999.0::DOUBLE AND ({t}) <= 5.0::DOUBLE THEN 0
       WHEN ({t}) > 5.0::DOUBLE AND ({t}) <= 15.0::DOUBLE THEN 1
       WHEN ({t}) > 15.0::DOUBLE AND ({t}) <= 25.0::DOUBLE THEN 2
       WHEN ({t}) > 25.0::DOUBLE AND ({t}) <= 999.0::DOUBLE THEN 3 END AS temp_category,
  CASE WHEN ({chill}) < 0 THEN 1 ELSE 0 END AS feels_like_cold"""


PARSED_WEATHER = f"""
SELECT date, zone, {_rnd('r', 1)} AS weather_rain, {_rnd('w', 2)} AS weather_wind_speed,
       {_rnd('t', 1)} AS weather_temperature
FROM (
  SELECT *, CASE WHEN avg(w0) OVER (PARTITION BY zone) > 20.0::DOUBLE THEN w0 / 3.6::DOUBLE ELSE w0 END AS w,
         last_value(t0 IGNORE NULLS) OVER (PARTITION BY zone ORDER BY obs_seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t
  FROM (
    SELECT zone, obs_seq, TRY_CAST(fecha AS DATE) AS date,
      CASE WHEN prec IN ('Ip', 'Ip ') THEN 0.1::DOUBLE ELSE coalesce({_pd('prec')}, 0.0::DOUBLE) END AS r,
      coalesce({_pd('velmedia')}, 0.0::DOUBLE) AS w0,
      {_pd('tmed')} AS t0
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, fecha ORDER BY obs_seq) AS _rn
                         FROM weather_raw) WHERE _rn = 1)))
WHERE date IS NOT NULL AND t IS NOT NULL"""

ORACLE["weather_parse"] = W(PARSED_WEATHER, "weather_raw")

_ORIG = ("d.delivery_id, d.date, d.hour, d.day_of_week, d.is_holiday, d.zone, d.zone_type, d.recipient_id, "
         "d.recipient_failure_rate, d.num_previous_attempts, d.driver_id, d.driver_quality_score, "
         "d.driver_delivery_load, d.product_type, d.requires_signature, d.is_fragile, d.is_bulky, "
         "d.weight_kg, d.is_retry, d.delivery_failed, d.src_partkey, d.src_suppkey, d.src_price")

ENRICHED = f"""
SELECT *, {_hist_flags('weather_rain', 'weather_wind_speed', 'weather_temperature')}
FROM (
  SELECT {_ORIG},
    coalesce(w.weather_rain, d.weather_rain) AS weather_rain,
    coalesce(w.weather_wind_speed, d.weather_wind_speed) AS weather_wind_speed,
    coalesce(w.weather_temperature, d.weather_temperature) AS weather_temperature,
    d.weather_rain AS weather_rain_synthetic,
    d.weather_wind_speed AS weather_wind_speed_synthetic,
    d.weather_temperature AS weather_temperature_synthetic,
    w.weather_rain IS NOT NULL AS _matched
  FROM deliveries d LEFT JOIN weather_daily w ON d.date = w.date AND d.zone = w.zone)"""

ORACLE["weather_join"] = W("SELECT * EXCLUDE (_matched) FROM enriched", "deliveries", "weather_daily",
                           extra={"enriched": ENRICHED})

ORACLE["join_coverage"] = W("""
SELECT total, matched, total - matched AS missing, matched / CAST(total AS DOUBLE) AS matched_share,
  (total - matched) / CAST(total AS DOUBLE) AS missing_share
FROM (SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE _matched) AS BIGINT) AS matched
      FROM enriched)""", "deliveries", "weather_daily", extra={"enriched": ENRICHED})

ORACLE["derived_weather"] = W(f"""
SELECT date, zone, weather_rain, weather_wind_speed, weather_temperature,
  {_hist_flags('weather_rain', 'weather_wind_speed', 'weather_temperature')}
FROM weather_daily""", "weather_daily")

ORACLE["enrichment_validation"] = W("""
SELECT *, corr_rain_failure < 0 AS rain_sign_warning FROM (
SELECT
  CAST(count(*) FILTER (WHERE weather_rain IS NULL OR isnan(weather_rain)) AS BIGINT) AS nulls_weather_rain,
  CAST(count(*) FILTER (WHERE weather_wind_speed IS NULL OR isnan(weather_wind_speed)) AS BIGINT) AS nulls_weather_wind_speed,
  CAST(count(*) FILTER (WHERE weather_temperature IS NULL OR isnan(weather_temperature)) AS BIGINT) AS nulls_weather_temperature,
  CAST(count(*) FILTER (WHERE NOT isnan(weather_rain) AND (weather_rain < 0 OR weather_rain > 200)) AS BIGINT) AS out_of_range_weather_rain,
  CAST(count(*) FILTER (WHERE NOT isnan(weather_wind_speed) AND (weather_wind_speed < 0 OR weather_wind_speed > 50)) AS BIGINT) AS out_of_range_weather_wind_speed,
  CAST(count(*) FILTER (WHERE NOT isnan(weather_temperature) AND (weather_temperature < -20 OR weather_temperature > 50)) AS BIGINT) AS out_of_range_weather_temperature,
  CAST(count(*) FILTER (WHERE temp_category IS NULL) AS BIGINT) AS nulls_temp_category,
  round_even(corr(weather_rain, CAST(delivery_failed AS DOUBLE)) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE
    AS corr_rain_failure,
  round_even(corr(weather_wind_speed, CAST(delivery_failed AS DOUBLE)) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE
    AS corr_wind_failure,
  avg(adverse_weather) AS share_adverse_weather,
  avg(strong_wind) AS share_strong_wind,
  avg(feels_like_cold) AS share_feels_like_cold
FROM enriched)""", "deliveries", "weather_daily", extra={"enriched": ENRICHED})

ORACLE["zone_weather_means"] = W(f"""
SELECT zone, {_rnd('avg(weather_rain)', 2)} AS weather_rain,
  {_rnd('avg(weather_wind_speed)', 2)} AS weather_wind_speed,
  {_rnd('avg(weather_temperature)', 2)} AS weather_temperature
FROM parsed GROUP BY zone""", "weather_raw", extra={"parsed": PARSED_WEATHER})

CONDITIONS = """
SELECT s.zone, s.station,
  coalesce(TRY_CAST(l.prec AS DOUBLE), 0.0::DOUBLE) AS weather_rain_raw,
  coalesce(TRY_CAST(l.vv AS DOUBLE), 0.0::DOUBLE) AS weather_wind_speed_raw,
  coalesce(TRY_CAST(l.ta AS DOUBLE), 0.0::DOUBLE) AS weather_temperature_raw
FROM stations s LEFT JOIN (
  SELECT station, arg_max_null(prec, obs_ts) AS prec, arg_max_null(vv, obs_ts) AS vv,
         arg_max_null(ta, obs_ts) AS ta
  FROM observations GROUP BY station) l ON s.station = l.station"""

ORACLE["latest_conditions"] = W("SELECT * FROM conditions", "observations", "stations",
                                extra={"conditions": CONDITIONS})

REALTIME = """
SELECT zone, weather_rain_raw AS weather_rain, weather_wind_speed_raw AS weather_wind_speed,
  weather_temperature_raw AS weather_temperature,
  CASE WHEN weather_wind_speed_raw > 10.0::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS strong_wind,
  CASE WHEN weather_rain_raw > 5.0::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS adverse_weather,
  CASE WHEN weather_temperature_raw < 5 THEN 0.0::DOUBLE WHEN weather_temperature_raw < 15 THEN 1.0::DOUBLE
       WHEN weather_temperature_raw < 25 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS temp_category
FROM conditions"""

ORACLE["realtime_weather"] = W("SELECT * FROM realtime", "observations", "stations",
                               extra={"conditions": CONDITIONS, "realtime": REALTIME})

ORACLE["display_weather"] = W(f"""
SELECT zone AS city,
  CASE WHEN r > 5.0::DOUBLE THEN 1 ELSE 0 END AS weather_rain,
  {_rnd('r', 1)} AS weather_rain_mm, {_rnd('w', 1)} AS weather_wind_speed,
  {_rnd('t', 1)} AS weather_temperature, src AS source
FROM (SELECT zone,
        CASE WHEN weather_rain_raw IS NOT NULL THEN weather_rain_raw ELSE 0.0::DOUBLE END AS r,
        CASE WHEN weather_rain_raw IS NOT NULL THEN weather_wind_speed_raw ELSE 2.0::DOUBLE END AS w,
        CASE WHEN weather_rain_raw IS NOT NULL THEN weather_temperature_raw ELSE 18.0::DOUBLE END AS t,
        CASE WHEN weather_rain_raw IS NOT NULL THEN 'aemet' ELSE 'fallback' END AS src
      FROM conditions)""", "observations", "stations", extra={"conditions": CONDITIONS})

ORACLE["weather_override"] = W(f"""
SELECT d.delivery_id, {TRACE}, d.zone,
  coalesce(r.weather_rain, d.weather_rain) AS weather_rain,
  coalesce(r.weather_wind_speed, d.weather_wind_speed) AS weather_wind_speed,
  coalesce(r.weather_temperature, d.weather_temperature) AS weather_temperature
FROM deliveries d LEFT JOIN realtime r ON d.zone = r.zone""", "deliveries", "observations", "stations",
                               extra={"conditions": CONDITIONS, "realtime": REALTIME})


# ------------------------------------------------------------------ features & split
_ORIG_NUM = ["hour", "day_of_week", "is_holiday", "recipient_failure_rate", "num_previous_attempts",
             "driver_quality_score", "driver_delivery_load", "requires_signature", "is_fragile",
             "is_bulky", "weight_kg", "weather_rain", "weather_wind_speed", "weather_temperature",
             "is_retry"]
_TWO_PI = "6.283185307179586::DOUBLE"
FEATURES = {c: c for c in _ORIG_NUM}
FEATURES.update({
    "hour_sin": f"sin(({_TWO_PI} * hour) / 24.0::DOUBLE)",
    "hour_cos": f"cos(({_TWO_PI} * hour) / 24.0::DOUBLE)",
    "dow_sin": f"sin(({_TWO_PI} * day_of_week) / 7.0::DOUBLE)",
    "dow_cos": f"cos(({_TWO_PI} * day_of_week) / 7.0::DOUBLE)",
    "month": "CAST(month(date) AS DOUBLE)",
    "quarter": "CAST(quarter(date) AS DOUBLE)",
})
for _col, _vals in (("zone", ("barcelona", "madrid", "sevilla", "valencia")),
                    ("zone_type", ("historic_center", "industrial", "offices", "residential")),
                    ("product_type", ("bulky", "fragile", "high_value", "signature_required", "standard"))):
    for _v in _vals:
        FEATURES[f"{_col}_{_v}"] = f"CASE WHEN {_col} = '{_v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
FEATURES.update({
    "load_x_rain": "driver_delivery_load * weather_rain",
    "fragile_x_bulky": "is_fragile * is_bulky",
    "score_x_rfr": "driver_quality_score * recipient_failure_rate",
    "score_x_load": "driver_quality_score * driver_delivery_load",
    "rfr_x_retry": "recipient_failure_rate * is_retry",
})

ORACLE["features_39"] = W(
    f"SELECT delivery_id, {TRACE}, "
    + ", ".join(f"{_rnd(f'CAST({e} AS DOUBLE)', 9)} AS {k}" for k, e in FEATURES.items())
    + " FROM deliveries", "deliveries")

ORACLE["calendar_flags"] = W(f"""
SELECT delivery_id, {TRACE}, date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CASE WHEN strftime(date, '%m-%d') IN ('01-01','01-06','03-28','03-29','04-01','05-01','08-15',
    '10-12','11-01','12-06','12-08','12-25') THEN 1 ELSE 0 END AS is_holiday,
  CASE WHEN product_type = 'signature_required' THEN 1 ELSE 0 END AS requires_signature,
  CASE WHEN product_type = 'fragile' THEN 1 ELSE 0 END AS is_fragile,
  CASE WHEN product_type = 'bulky' THEN 1 ELSE 0 END AS is_bulky,
  CASE WHEN num_previous_attempts > 0 THEN 1 ELSE 0 END AS is_retry
FROM deliveries""", "deliveries")

ORACLE["zone_failure_rate"] = W("""
SELECT zone, CAST(count(*) AS BIGINT) AS deliveries, avg(CAST(delivery_failed AS DOUBLE)) AS failure_rate
FROM deliveries GROUP BY zone""", "deliveries")

_CORR_COLS = ["hour", "day_of_week", "is_holiday", "recipient_id", "recipient_failure_rate",
              "num_previous_attempts", "driver_quality_score", "driver_delivery_load",
              "requires_signature", "is_fragile", "is_bulky", "weight_kg", "weather_rain",
              "weather_wind_speed", "weather_temperature", "is_retry"]
ORACLE["top_correlations"] = W(
    "SELECT feature, " + _rnd("corr", 9) + " AS corr, " + _rnd("abs(corr)", 9) + " AS abs_corr FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(delivery_failed AS DOUBLE)) AS corr "
                         f"FROM deliveries" for c in _CORR_COLS)
    + ") WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY abs(corr) DESC, feature LIMIT 5", "deliveries")

ORACLE["scaler_stats"] = W(
    " UNION ALL ".join(f"SELECT '{k}' AS feature, {_rnd(f'avg(CAST({e} AS DOUBLE))', 9)} AS mean, "
                       f"{_rnd(f'stddev_samp(CAST({e} AS DOUBLE))', 9)} AS std FROM deliveries"
                       for k, e in FEATURES.items()), "deliveries")

_RT6 = ["weather_rain", "weather_wind_speed", "weather_temperature", "strong_wind", "adverse_weather",
        "temp_category"]
ORACLE["zscored"] = W(
    "SELECT r.zone, " + ", ".join(
        f"{_rnd(f'CASE WHEN s.std_{c} > 0 THEN (r.{c} - s.mean_{c}) / s.std_{c} ELSE 0.0::DOUBLE END', 9)} AS {c}"
        for c in _RT6)
    + " FROM realtime r, (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS std_{c}" for c in _RT6)
    + " FROM enriched) s", "deliveries", "weather_daily", "observations", "stations",
    extra={"enriched": ENRICHED, "conditions": CONDITIONS, "realtime": REALTIME})

CLEAN = (f"SELECT * EXCLUDE (_rn) FROM ({KEEP_FIRST.format(src='deliveries')}) "
         f"WHERE ({ALL_RANGE}) AND ({ALL_METEO})")

ORACLE["silver_enriched"] = W(
    f"SELECT * EXCLUDE (_rn, _matched) FROM ({KEEP_FIRST.format(src='enriched')}) WHERE ({ALL_RANGE}) AND ({ALL_METEO})",
    "deliveries", "weather_daily", extra={"enriched": ENRICHED})

SPLIT = """
SELECT c.*, CASE WHEN c._r <= q.t THEN 'test' WHEN c._r <= q.t + q.v THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY delivery_failed ORDER BY md5('42#' || delivery_id)) AS _r
      FROM clean) c
JOIN quotas q ON c.delivery_failed = q.lbl"""

QUOTAS = """
SELECT lbl, n - keep AS t, keep - tr AS v FROM (
  SELECT *, floor2 + CASE WHEN rk2 <= need2 THEN 1 ELSE 0 END AS tr FROM (
    SELECT *, row_number() OVER (ORDER BY cont2 - floor2 DESC, lbl) AS rk2,
           n_train - sum(floor2) OVER () AS need2 FROM (
      SELECT *, keep * n_train / rest AS cont2, floor(keep * n_train / rest) AS floor2 FROM (
        SELECT *, floor1 + CASE WHEN rk1 <= need1 THEN 1 ELSE 0 END AS keep FROM (
          SELECT *, row_number() OVER (ORDER BY cont1 - floor1 DESC, lbl) AS rk1,
                 rest - sum(floor1) OVER () AS need1 FROM (
            SELECT c.lbl, c.n, s.rest, s.n_train, c.n * s.rest / s.total AS cont1,
                   floor(c.n * s.rest / s.total) AS floor1
            FROM (SELECT delivery_failed AS lbl, count(*) AS n FROM clean GROUP BY 1) c,
                 (SELECT total, rest, rest - CAST(ceil(0.125::DOUBLE * rest) AS BIGINT) AS n_train FROM (
                    SELECT total, total - CAST(ceil(0.2::DOUBLE * total) AS BIGINT) AS rest
                    FROM (SELECT count(*) AS total FROM clean))) s))))))"""

_SPLIT_CTES = {"clean": CLEAN, "quotas": QUOTAS, "split": SPLIT}

ORACLE["split_exact"] = W("SELECT delivery_id, delivery_failed, split FROM split", "deliveries",
                          extra=_SPLIT_CTES)
ORACLE["split_sizes"] = W("""
SELECT split, delivery_failed AS label, CAST(count(*) AS BIGINT) AS n FROM split GROUP BY 1, 2""",
                          "deliveries", extra=_SPLIT_CTES)
ORACLE["class_weights"] = W(f"""
SELECT label, n, {_rnd('sum(n) OVER () / (count(*) OVER () * n)', 9)} AS weight
FROM (SELECT delivery_failed AS label, CAST(count(*) AS BIGINT) AS n FROM split WHERE split = 'train' GROUP BY 1)""",
                            "deliveries", extra=_SPLIT_CTES)


# ------------------------------------------------------------------ scoring & metrics
def _lookup(col, pairs):
    return "CASE " + " ".join(f"WHEN {col} IN ({', '.join(map(str, k))}) THEN {w}::DOUBLE" if isinstance(k, tuple)
                              else f"WHEN {col} = '{k}' THEN {w}::DOUBLE" for k, w in pairs) + " ELSE 0.0::DOUBLE END"


def _truthy(c):
    return f"coalesce(CAST({c} AS DOUBLE) <> 0, false)"


LOGIT = " + ".join([
    "-2.8::DOUBLE",
    "weather_rain * 1.1::DOUBLE",
    "CASE WHEN weather_wind_speed > 10.0 THEN 0.5::DOUBLE WHEN weather_wind_speed > 7.0 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END",
    "CASE WHEN abs(weather_temperature) < 2.0 THEN 0.6::DOUBLE WHEN weather_temperature > 35.0 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END",
    _lookup("zone_type", [("historic_center", 0.9), ("residential", 0.0), ("offices", -0.1), ("industrial", -0.5)]),
    _lookup("hour", [((13, 14), 0.5), ((8, 9), -0.2), ((17, 18), -0.1)]),
    _lookup("day_of_week", [((0,), 0.3), ((4,), 0.2), ((5, 6), -0.3)]),
    f"CASE WHEN {_truthy('is_holiday')} THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END",
    "recipient_failure_rate * 2.5::DOUBLE",
    "(-(driver_quality_score * 1.5::DOUBLE))",
    "CASE WHEN driver_delivery_load > 40 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END",
    f"CASE WHEN {_truthy('is_retry')} THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END",
    _lookup("product_type", [("fragile", 0.3), ("bulky", 0.4), ("high_value", 0.2), ("signature_required", 0.5),
                             ("standard", 0.0)]),
    f"CASE WHEN {_truthy('requires_signature')} THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END",
    f"CASE WHEN {_truthy('is_bulky')} THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END",
    "CASE WHEN weight_kg > 20.0 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END",
    "num_previous_attempts * 0.5::DOUBLE",
])
PROB = f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({LOGIT}))))"
SCORE = _rnd(PROB, 4)

SCORED = f"SELECT *, {SCORE} AS score, delivery_failed AS label FROM clean"
SCORED_W = f"SELECT *, {SCORE} AS score, delivery_failed AS label FROM enriched_clean"
ENRICHED_CLEAN = ENRICHED.replace("FROM deliveries d LEFT JOIN", "FROM clean d LEFT JOIN")

GRID = ("SELECT 0.2::DOUBLE + i * ((0.2::DOUBLE + 0.02::DOUBLE) - 0.2::DOUBLE) AS threshold "
        "FROM range(25) t(i)")
SWEEP = """
SELECT threshold, tp, fp, tn, fn, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0::DOUBLE
  ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1
FROM (SELECT g.threshold,
        CAST(count(*) FILTER (WHERE s.score >= g.threshold AND s.label = 1) AS BIGINT) AS tp,
        CAST(count(*) FILTER (WHERE s.score >= g.threshold AND s.label = 0) AS BIGINT) AS fp,
        CAST(count(*) FILTER (WHERE NOT (s.score >= g.threshold) AND s.label = 0) AS BIGINT) AS tn,
        CAST(count(*) FILTER (WHERE NOT (s.score >= g.threshold) AND s.label = 1) AS BIGINT) AS fn
      FROM grid g, {src} s GROUP BY g.threshold)"""
BEST = "SELECT * FROM {sweep} ORDER BY f1 DESC, threshold ASC LIMIT 1"
CONF = """
SELECT threshold, tp, fp, tn, fn,
  CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
  CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
  positive_rate
FROM (SELECT b.threshold,
        CAST(count(*) FILTER (WHERE s.score >= b.threshold AND s.label = 1) AS BIGINT) AS tp,
        CAST(count(*) FILTER (WHERE s.score >= b.threshold AND s.label = 0) AS BIGINT) AS fp,
        CAST(count(*) FILTER (WHERE NOT (s.score >= b.threshold) AND s.label = 0) AS BIGINT) AS tn,
        CAST(count(*) FILTER (WHERE NOT (s.score >= b.threshold) AND s.label = 1) AS BIGINT) AS fn,
        avg(CAST(s.label AS DOUBLE)) AS positive_rate
      FROM {best} b, {src} s GROUP BY b.threshold)"""
CUM = """
SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
          sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp
FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY score)"""
AUC = ("SELECT sum(neg * ((tp - pos) + pos * 0.5::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc "
       "FROM ({cum})")
AP = "SELECT sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / sum(pos) AS avg_precision FROM ({cum})"
PROJ = """
SELECT e AS expected_failures, CAST(trunc(e * recall) AS INTEGER) AS daily_detected,
  CAST(trunc((18000 - e) * (fp / CAST(greatest(tn + fp, 1) AS DOUBLE))) AS INTEGER) AS daily_false_alarms
FROM (SELECT *, CAST(trunc(18000 * positive_rate) AS INTEGER) AS e FROM conf)"""


def _metric_ctes(src: str, suffix: str = "") -> dict:
    sweep, best, conf = f"sweep{suffix}", f"best{suffix}", f"conf{suffix}"
    return {
        sweep: SWEEP.format(src=src),
        best: BEST.format(sweep=sweep),
        conf: CONF.format(best=best, src=src),
        f"cum{suffix}": CUM.format(src=src),
    }


_M = {"clean": CLEAN, "scored": SCORED, "grid": GRID, **_metric_ctes("scored")}

ORACLE["rule_scores"] = W(f"SELECT delivery_id, {TRACE}, score, label FROM scored", "deliveries",
                          extra={"clean": CLEAN, "scored": SCORED})
ORACLE["threshold_sweep"] = W("SELECT * FROM sweep", "deliveries", extra=_M)
ORACLE["best_threshold"] = W("SELECT * FROM best", "deliveries", extra=_M)
ORACLE["roc_auc"] = W(f"SELECT {_rnd('roc_auc', 4)} AS roc_auc FROM ({AUC.format(cum='SELECT * FROM cum')})",
                      "deliveries", extra=_M)
ORACLE["average_precision"] = W(
    f"SELECT {_rnd('avg_precision', 4)} AS avg_precision FROM ({AP.format(cum='SELECT * FROM cum')})",
    "deliveries", extra=_M)
ORACLE["confusion"] = W("SELECT * EXCLUDE (positive_rate) FROM conf", "deliveries", extra=_M)
ORACLE["daily_projection"] = W(PROJ, "deliveries", extra=_M)
_CR = {
    "per": """
  SELECT '0' AS cls, tn AS t, fn AS fpos, fp AS fneg FROM conf
  UNION ALL SELECT '1', tp, fp, fn FROM conf""",
    "m": """
  SELECT cls,
    CASE WHEN t + fpos = 0 THEN 0.0::DOUBLE ELSE t / CAST(t + fpos AS DOUBLE) END AS precision,
    CASE WHEN t + fneg = 0 THEN 0.0::DOUBLE ELSE t / CAST(t + fneg AS DOUBLE) END AS recall,
    CASE WHEN 2 * t + fpos + fneg = 0 THEN 0.0::DOUBLE ELSE 2 * t / CAST(2 * t + fpos + fneg AS DOUBLE) END AS f1,
    CAST(t + fneg AS DOUBLE) AS support FROM per"""}
ORACLE["classification_report"] = W("""
SELECT cls, precision, recall, f1, CAST(support AS BIGINT) AS support FROM m
UNION ALL SELECT 'accuracy', a, a, a, CAST(total AS BIGINT) FROM (
  SELECT (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS a, tp + tn + fp + fn AS total FROM conf)
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m""", "deliveries", extra={**_M, **_CR})


def _evaluate_sql(suffix: str) -> str:
    cum = f"SELECT * FROM cum{suffix}"
    return f"""
SELECT {_rnd('a.roc_auc', 4)} AS roc_auc, {_rnd('p.avg_precision', 4)} AS avg_precision,
  {_rnd('b.f1', 4)} AS f1_optimal, {_rnd('c.threshold', 3)} AS best_threshold,
  {_rnd('c.recall', 4)} AS recall_fallo, {_rnd('c.precision', 4)} AS precision_fallo,
  c.tp, c.fp, c.tn, c.fn,
  CAST(trunc(CAST(trunc(18000 * c.positive_rate) AS INTEGER) * c.recall) AS INTEGER) AS daily_detected,
  CAST(trunc((18000 - CAST(trunc(18000 * c.positive_rate) AS INTEGER))
       * (c.fp / CAST(greatest(c.tn + c.fp, 1) AS DOUBLE))) AS INTEGER) AS daily_false_alarms
FROM ({AUC.format(cum=cum)}) a, ({AP.format(cum=cum)}) p, best{suffix} b, conf{suffix} c"""


ORACLE["model_comparison"] = W(f"""
SELECT * EXCLUDE (_o), row_number() OVER (ORDER BY avg_precision DESC, _o) = 1 AS is_best FROM (
  SELECT 'rule_scorecard' AS model, 0 AS _o, * FROM ({_evaluate_sql('')})
  UNION ALL SELECT 'rule_scorecard_weather', 1, * FROM ({_evaluate_sql('_w')}))""",
    "deliveries", "weather_daily",
    extra={**_M, "enriched_clean": ENRICHED_CLEAN, "scored_w": SCORED_W, **_metric_ctes("scored_w", "_w")})


# ------------------------------------------------------------------ operations layer
BANDED = f"""
SELECT *, CASE WHEN risk_level = 'HIGH' THEN 'REAGENDAR_SMS' WHEN risk_level = 'MEDIUM' THEN 'CAMBIAR_FRANJA'
               ELSE 'ENTREGA_NORMAL' END AS action
FROM (SELECT *, {_rnd('score', 4)} AS prob_fallo,
        CASE WHEN score >= 0.5::DOUBLE * 1.3::DOUBLE THEN 'HIGH'
             WHEN score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
      FROM scored)"""
_B = {"clean": CLEAN, "scored": SCORED, "banded": BANDED}


def _cap(x):
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


ORACLE["risk_bands"] = W(f"SELECT delivery_id, {TRACE}, prob_fallo, risk_level, action FROM banded",
                         "deliveries", extra=_B)
ORACLE["risk_summary"] = W("""
SELECT total, high, medium, low, high / CAST(total AS DOUBLE) AS high_share,
  medium / CAST(total AS DOUBLE) AS medium_share, low / CAST(total AS DOUBLE) AS low_share
FROM (SELECT CAST(count(*) AS BIGINT) AS total,
        CAST(count(*) FILTER (WHERE risk_level = 'HIGH') AS BIGINT) AS high,
        CAST(count(*) FILTER (WHERE risk_level = 'MEDIUM') AS BIGINT) AS medium,
        CAST(count(*) FILTER (WHERE risk_level = 'LOW') AS BIGINT) AS low FROM banded)""",
                           "deliveries", extra=_B)
ORACLE["actionable"] = W(f"""
SELECT delivery_id, {TRACE}, prob_fallo, risk_level FROM banded WHERE risk_level IN ('HIGH', 'MEDIUM')""",
                         "deliveries", extra=_B)

_REASON = ("concat_ws(' · ', "
           f"CASE WHEN {_truthy('weather_rain')} THEN '🌧️ Lluvia' END, "
           f"CASE WHEN {_truthy('is_retry')} THEN '🔁 Reintento' END, "
           "CASE WHEN zone_type = 'historic_center' THEN '🏛️ Centro histórico' END, "
           "CASE WHEN driver_quality_score < 0.5 THEN '👷 Conductor bajo' END, "
           "CASE WHEN recipient_failure_rate > 0.5 THEN '📬 Dest. problemático' END, "
           "CASE WHEN num_previous_attempts > 1 THEN '🔄 ' || CAST(num_previous_attempts AS VARCHAR) || ' intentos' END, "
           f"CASE WHEN {_truthy('is_fragile')} THEN '⚠️ Frágil' END)")

ORACLE["ranked_panel"] = W(f"""
SELECT row_number() OVER (ORDER BY prob_fallo DESC, delivery_id ASC) AS rank, delivery_id,
  {_cap("coalesce(zone, '—')")} AS city,
  coalesce(CASE zone_type WHEN 'residential' THEN 'Residencial' WHEN 'offices' THEN 'Oficinas'
      WHEN 'historic_center' THEN 'Centro histórico' WHEN 'industrial' THEN 'Industrial' END, zone_type, '—')
    AS zone_type_label,
  coalesce(CASE product_type WHEN 'standard' THEN '📦 Estándar' WHEN 'fragile' THEN '⚠️ Frágil'
      WHEN 'bulky' THEN '🏗️ Voluminoso' WHEN 'high_value' THEN '💎 Alto valor'
      WHEN 'signature_required' THEN '✍️ Firma requerida' END, product_type, '—') AS product_label,
  coalesce(CASE risk_level WHEN 'HIGH' THEN '🔴 ALTO' WHEN 'MEDIUM' THEN '🟡 MEDIO' WHEN 'LOW' THEN '🟢 BAJO' END,
    '🟢 BAJO') AS badge,
  {_rnd('prob_fallo * 100.0::DOUBLE', 1)} AS pct,
  CASE WHEN {_REASON} = '' THEN '—' ELSE {_REASON} END AS reason,
  coalesce(CASE action WHEN 'REAGENDAR_SMS' THEN '📱 Reagendar SMS' WHEN 'CAMBIAR_FRANJA' THEN '🕐 Cambiar franja'
      WHEN 'ENTREGA_NORMAL' THEN '✅ Normal' END, action, '—') AS action_label,
  risk_level = 'HIGH' AS sms_eligible
FROM banded""", "deliveries", extra=_B)

_MAP = """
SELECT {grain}, total, high, medium, low, share AS high_share,
  CASE WHEN share > 0.5 THEN '#ef4444' WHEN share > 0.2 THEN '#f59e0b' ELSE '#22c55e' END AS color,
  greatest(12.0::DOUBLE, least(36.0::DOUBLE, 12.0::DOUBLE + total * 0.6::DOUBLE)) AS radius
FROM (SELECT *, CASE WHEN total > 0 THEN high / CAST(total AS DOUBLE) ELSE 0.0::DOUBLE END AS share FROM (
  SELECT {grain}, CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (WHERE risk_level = 'HIGH') AS BIGINT) AS high,
    CAST(count(*) FILTER (WHERE risk_level = 'MEDIUM') AS BIGINT) AS medium,
    CAST(count(*) FILTER (WHERE risk_level = 'LOW') AS BIGINT) AS low
  FROM (SELECT * REPLACE (coalesce(zone, 'madrid') AS zone) FROM banded) GROUP BY {grain}))"""
ORACLE["city_risk_map"] = W(_MAP.format(grain="zone"), "deliveries", extra=_B)
ORACLE["city_zone_risk"] = W(_MAP.format(grain="zone, zone_type"), "deliveries", extra=_B)

ALERTS = f"""
SELECT true AS sent, true AS simulated, delivery_id, '+34000000000' AS phone,
  'Entregas: Su entrega ' || delivery_id || ' en ' || {_cap("coalesce(zone, 'desconocida')")}
    || ' tiene un ' || CAST(CAST(round_even(prob_fallo * 100.0::DOUBLE, 0) AS INTEGER) AS VARCHAR)
    || '% de probabilidad de fallo hoy. Le proponemos cambiar de franja horaria. Responda SI para reprogramar.'
    AS message,
  'simulated: no webhook configured' AS detail, coalesce(zone, 'desconocida') AS city, prob_fallo
FROM {{src}} WHERE prob_fallo >= 0.7::DOUBLE"""
_A = {**_B, "alerts": ALERTS.format(src="banded"),
      "prior": ALERTS.format(src="(SELECT * FROM banded WHERE date < DATE '1998-01-01')")}

ORACLE["alerts"] = W("SELECT * FROM alerts", "deliveries", extra=_A)
ORACLE["alert_summary"] = W("""
SELECT CAST(count(*) AS BIGINT) AS total_alerts, CAST(count(*) FILTER (WHERE NOT simulated) AS BIGINT) AS real,
  CAST(count(*) FILTER (WHERE simulated) AS BIGINT) AS simulated FROM alerts""", "deliveries", extra=_A)
ORACLE["new_alerts"] = W("SELECT * FROM alerts WHERE delivery_id NOT IN (SELECT delivery_id FROM prior)",
                         "deliveries", extra=_A)
ORACLE["alert_flags"] = W("""
SELECT delivery_id, delivery_id IN (SELECT delivery_id FROM prior) AS already_alerted FROM alerts""",
                          "deliveries", extra=_A)
ORACLE["remove_deliveries"] = W(f"""
SELECT delivery_id, {TRACE}, prob_fallo FROM banded
WHERE delivery_id NOT IN (SELECT delivery_id FROM banded WHERE delivery_failed = 1 AND is_retry = 1)""",
                                "deliveries", extra=_B)
ORACLE["append_predictions"] = W(f"""
SELECT delivery_id, {TRACE}, date, prob_fallo, risk_level FROM banded WHERE date < DATE '1998-01-01'
UNION ALL
SELECT delivery_id, {TRACE}, date, prob_fallo, risk_level FROM banded WHERE NOT (date < DATE '1998-01-01')""",
                                 "deliveries", extra=_B)
ORACLE["manual_delivery_defaults"] = W(f"""
SELECT delivery_id, {TRACE}, 0.2::DOUBLE AS recipient_failure_rate,
  CASE WHEN CAST(is_retry AS DOUBLE) <> 0 THEN 1 ELSE 0 END AS num_previous_attempts,
  0.75::DOUBLE AS driver_quality_score, CAST(NULL AS INTEGER) AS delivery_failed
FROM deliveries""", "deliveries")

HISTORY = """
SELECT date AS run_date, coalesce(delivery_id, '') AS delivery_id, zone AS city, prob_fallo, risk_level, action,
  'rule_scorecard_unknown' AS model_version FROM banded"""
ORACLE["prediction_history"] = W("SELECT * FROM history", "deliveries", extra={**_B, "history": HISTORY})
ORACLE["history_appends"] = W("""
SELECT run_date, CAST(count(*) AS BIGINT) AS n_shown, CAST(count(*) AS BIGINT) AS n_counted FROM history GROUP BY run_date""",
                              "deliveries", extra={**_B, "history": HISTORY})
ORACLE["recent_rollup"] = W("""
SELECT run_date, city, risk_level, action, CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CAST(round_even(prob_fallo * 10000.0::DOUBLE, 0) AS BIGINT)) AS DOUBLE) / count(*) / 10000.0::DOUBLE
    AS avg_prob
FROM history WHERE CAST(run_date AS TIMESTAMP) >= TIMESTAMP '2001-10-01 10:00:00' - INTERVAL 7 DAY
GROUP BY 1, 2, 3, 4 ORDER BY run_date DESC""", "deliveries", extra={**_B, "history": HISTORY})


# ------------------------------------------------------------------ drift
DRIFT_FEATURES = ["recipient_failure_rate", "driver_quality_score", "weight_kg", "weather_rain",
                  "weather_wind_speed", "weather_temperature", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
                  "month", "quarter", "zone_barcelona", "zone_madrid", "zone_sevilla", "zone_valencia",
                  "zone_type_historic_center", "zone_type_industrial", "zone_type_offices",
                  "zone_type_residential", "product_type_bulky", "product_type_fragile",
                  "product_type_high_value", "product_type_signature_required", "product_type_standard",
                  "load_x_rain", "score_x_rfr", "score_x_load", "rfr_x_retry"]
_QL = "[" + ", ".join(f"{(i * 10.0) / 100.0!r}::DOUBLE" for i in range(11)) + "]"


def _drift_ctes(exp_cond: str, act_cond: str) -> dict:
    def long(side, cond):
        return " UNION ALL ".join(
            f"SELECT '{side}' AS side, {i} AS pos, '{f}' AS feature, CAST({FEATURES[f]} AS DOUBLE) AS value "
            f"FROM deliveries WHERE {cond}" for i, f in enumerate(DRIFT_FEATURES))
    return {
        "dl": long("e", exp_cond) + " UNION ALL " + long("a", act_cond),
        "edges": f"""
SELECT feature, [q[1] - 1e-8::DOUBLE] || q[2:10] || [q[11] + 1e-8::DOUBLE] AS e FROM (
  SELECT feature, quantile_cont(value, {_QL}) AS q FROM dl WHERE side = 'e' GROUP BY feature)""",
        "lens": "SELECT side, feature, count(*) AS len FROM dl GROUP BY side, feature",
        "binned": """
SELECT side, feature, least(len(list_filter(e, lambda x: x <= value)) - 1, 9) AS bin, count(*) AS cnt
FROM dl JOIN edges USING (feature) WHERE value >= e[1] AND value <= e[11] GROUP BY 1, 2, 3""",
        "psi": """
SELECT pos, feature, psi, round_even(psi * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS psi_rounded,
  CASE WHEN psi < 0.1 THEN 'OK' WHEN psi < 0.2 THEN 'WARN' ELSE 'ALERT' END AS severity
FROM (
  SELECT g.pos, g.feature, sum((ap - ep) * ln(ap / ep)) AS psi FROM (
    SELECT g.pos, g.feature, g.bin,
      CASE WHEN coalesce(be.cnt, 0) / (le.len + 1e-8::DOUBLE) = 0 THEN 1e-8::DOUBLE
           ELSE coalesce(be.cnt, 0) / (le.len + 1e-8::DOUBLE) END AS ep,
      CASE WHEN coalesce(ba.cnt, 0) / (la.len + 1e-8::DOUBLE) = 0 THEN 1e-8::DOUBLE
           ELSE coalesce(ba.cnt, 0) / (la.len + 1e-8::DOUBLE) END AS ap
    FROM (SELECT DISTINCT pos, feature, b.bin FROM dl, range(10) b(bin) WHERE side = 'e') g
    LEFT JOIN binned be ON be.side = 'e' AND be.feature = g.feature AND be.bin = g.bin
    LEFT JOIN binned ba ON ba.side = 'a' AND ba.feature = g.feature AND ba.bin = g.bin
    JOIN lens le ON le.side = 'e' AND le.feature = g.feature
    JOIN lens la ON la.side = 'a' AND la.feature = g.feature) g
  GROUP BY g.pos, g.feature)""",
        "n_act": f"SELECT count(*) AS n FROM deliveries WHERE {act_cond}",
    }


def _drift_oracles(suffix: str, exp_cond: str, act_cond: str):
    ctes = _drift_ctes(exp_cond, act_cond)
    ORACLE[f"psi_{suffix}"] = W("SELECT feature, psi_rounded AS psi, severity FROM psi", "deliveries", extra=ctes)
    ORACLE[f"drift_alerts_{suffix}"] = W("""
SELECT DATE '1998-01-01' AS alert_date, feature AS feature_name, psi_rounded AS psi_value, severity
FROM psi WHERE severity <> 'OK' AND (SELECT n FROM n_act) >= 1000""", "deliveries", extra=ctes)
    ORACLE[f"drift_summary_{suffix}"] = W(f"""
SELECT CASE WHEN NOT enough THEN 'insufficient_data' WHEN n_alerts > 0 THEN 'ALERT' ELSE 'OK' END AS status,
  CASE WHEN enough THEN {_rnd('overall', 4)} END AS overall_psi, CASE WHEN enough THEN n_features ELSE 0 END AS n_features,
  CASE WHEN enough THEN n_alerts ELSE 0 END AS n_alerts, CASE WHEN enough THEN features_with_drift ELSE '' END AS features_with_drift
FROM (SELECT (SELECT n FROM n_act) >= 1000 AS enough, * FROM (SELECT CAST(count(*) AS BIGINT) AS n_features, avg(psi_rounded) AS overall,
        CAST(count(*) FILTER (WHERE severity = 'ALERT') AS BIGINT) AS n_alerts,
        coalesce(string_agg(feature, ',' ORDER BY pos) FILTER (WHERE severity = 'ALERT'), '')
          AS features_with_drift FROM psi))""", "deliveries", extra=ctes)


_drift_oracles("by_feature", "date < DATE '1998-01-01'", "NOT (date < DATE '1998-01-01')")
_drift_oracles("seasonal", "month(date) <= 6", "NOT (month(date) <= 6)")
ORACLE["drift_summary_one_day"] = W("""
SELECT CASE WHEN count(*) < 1000 THEN 'insufficient_data' END AS status, CAST(NULL AS DOUBLE) AS overall_psi, CAST(0 AS BIGINT) AS n_features,
  CAST(0 AS BIGINT) AS n_alerts, '' AS features_with_drift
FROM deliveries WHERE date = (SELECT max(date) FROM deliveries)""", "deliveries")
ORACLE["drift_alerts"] = ORACLE.pop("drift_alerts_by_feature")
ORACLE["drift_summary"] = ORACLE.pop("drift_summary_by_feature")


# ------------------------------------------------------------------ streaming (same scoring over raw rows)
ORACLE["incremental_scoring"] = W(f"""
SELECT delivery_id, {TRACE}, prob_fallo, risk_level,
  CASE WHEN risk_level = 'HIGH' THEN 'REAGENDAR_SMS' WHEN risk_level = 'MEDIUM' THEN 'CAMBIAR_FRANJA'
       ELSE 'ENTREGA_NORMAL' END AS action
FROM (SELECT *, CASE WHEN prob_fallo >= 0.5::DOUBLE * 1.3::DOUBLE THEN 'HIGH'
                     WHEN prob_fallo >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
      FROM (SELECT *, {SCORE} AS prob_fallo FROM deliveries))""", "deliveries")


# ------------------------------------------------------------------ panel joins, top-k, weather parts
ORACLE["panel_with_originals"] = W(f"""
SELECT b.delivery_id, b.prob_fallo, b.risk_level, 'model' AS zone, o.zone_type, o.weight_kg,
  o.src_partkey, o.src_suppkey, o.src_price
FROM banded b LEFT JOIN ({KEEP_FIRST.format(src='deliveries')}) o ON b.delivery_id = o.delivery_id""",
                                   "deliveries", extra=_B)
ORACLE["top_risk_deliveries"] = W(f"""
SELECT delivery_id, {TRACE}, prob_fallo, risk_level FROM banded
ORDER BY prob_fallo DESC, delivery_id ASC LIMIT 100""", "deliveries", extra=_B)
ORACLE["weather_parse_halves"] = ORACLE["weather_parse"]

ORACLE["weather_from_json"] = ORACLE["weather_parse"]
# the service's replies: each thirteenth day twice (the second one is ignored), a file per station and half-year
_SERVICE = {
    "landed": """
SELECT *, CAST(year(day) AS VARCHAR) || CASE WHEN month(day) <= 6 THEN 'a' ELSE 'b' END AS period
FROM (SELECT *, DATE '1970-01-01' + obs_seq AS day FROM weather_raw WHERE zone <> 'sevilla')""",
    "service_days": """
SELECT zone, station, period, obs_seq, fecha, prec, velmedia, tmed FROM (
  SELECT *, row_number() OVER (PARTITION BY station, fecha, CASE WHEN TRY_CAST(fecha AS DATE) IS NULL THEN period END
                               ORDER BY obs_seq) AS _first FROM landed) WHERE _first = 1"""}
ORACLE["weather_service_daily"] = W(
    PARSED_WEATHER.replace("row_number() OVER (PARTITION BY station, fecha ORDER BY obs_seq)", "1").replace("weather_raw", "service_days"),
    "weather_raw", extra=_SERVICE)
ORACLE["weather_service_coverage"] = W("""
SELECT s.zone, s.station, coalesce(files, 0) AS files, coalesce(records, 0) AS records, coalesce(days, 0) AS days, first_day, last_day
FROM stations s
LEFT JOIN (SELECT station, count(DISTINCT period) AS files, sum(CASE WHEN obs_seq % 13 = 0 THEN 2 ELSE 1 END) AS records
           FROM landed GROUP BY station) l USING (station)
LEFT JOIN (SELECT station, count(DISTINCT TRY_CAST(fecha AS DATE)) AS days, min(TRY_CAST(fecha AS DATE)) AS first_day,
                  max(TRY_CAST(fecha AS DATE)) AS last_day FROM service_days GROUP BY station) d USING (station)""",
    "weather_raw", "stations", extra=_SERVICE)
ORACLE["recent_rollup_stored"] = ORACLE["recent_rollup"]

# ------------------------------------------------------------------ models as tables
for _name in ("linear", "forest", "boosted"):
    ORACLE[f"model_table_{_name}"] = W(f"""
SELECT '{_name}' AS kind, split, delivery_failed AS label, CAST(count(*) AS BIGINT) AS n, TRUE AS agree
FROM split GROUP BY split, delivery_failed""", "deliveries", extra=_SPLIT_CTES)

_STORED = {
    "clean": CLEAN,
    "linear": """
SELECT d.delivery_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(-1.2::DOUBLE
  + 0.8::DOUBLE * (recipient_failure_rate - 0.5::DOUBLE) / 0.3::DOUBLE - 0.4::DOUBLE * (driver_quality_score - 0.5::DOUBLE) / 0.3::DOUBLE
  + 0.15::DOUBLE * (weather_rain - 0.2::DOUBLE) / 0.4::DOUBLE + 0.25::DOUBLE * (weight_kg - 25.0::DOUBLE) / 14.0::DOUBLE
  + 0.3::DOUBLE * (num_previous_attempts - 1.0::DOUBLE)))) AS p FROM clean d""",
    "leaves": """
SELECT delivery_id,
  CASE WHEN recipient_failure_rate <= 0.45::DOUBLE THEN 0.25::DOUBLE WHEN weight_kg <= 30.0::DOUBLE THEN 0.5::DOUBLE ELSE 0.875::DOUBLE END AS t0,
  CASE WHEN hour > 12 THEN 0.125::DOUBLE WHEN driver_quality_score <= 0.2::DOUBLE THEN 0.75::DOUBLE ELSE 0.375::DOUBLE END AS t1,
  0.0625::DOUBLE AS t2 FROM clean"""}
ORACLE["stored_model_scores"] = W(f"""
SELECT delivery_id, {_rnd('l.p', 6)} AS linear, {_rnd('(t0 + 0.5::DOUBLE * t1 + 2.0::DOUBLE * t2) / 3.5::DOUBLE', 6)} AS forest,
  {_rnd('1.0::DOUBLE / (1.0::DOUBLE + exp(-2.0::DOUBLE * (t0 + 0.5::DOUBLE * t1 + 2.0::DOUBLE * t2)))', 6)} AS boosted
FROM leaves JOIN linear l USING (delivery_id)""", "deliveries", extra=_STORED)

# gain times rows of each split, as shares of its tree, then of all trees
ORACLE["stored_model_importance"] = W(f"""
SELECT feature, {_rnd('sum(g / t) / 2.0::DOUBLE', 6)} AS importance FROM (
  SELECT *, sum(g) OVER (PARTITION BY tree) AS t FROM (
    SELECT 0 AS tree, 'recipient_failure_rate' AS feature, 0.02::DOUBLE * count(*) AS g FROM clean
    UNION ALL SELECT 0, 'weight_kg', 0.01::DOUBLE * count(*) FROM clean WHERE recipient_failure_rate > 0.45::DOUBLE
    UNION ALL SELECT 1, 'hour', 0.02::DOUBLE * count(*) FROM clean
    UNION ALL SELECT 1, 'driver_quality_score', 0.01::DOUBLE * count(*) FROM clean WHERE hour <= 12))
GROUP BY feature""", "deliveries", extra={"clean": CLEAN})

# ------------------------------------------------------------------ exact duplicates, and a city without a reading
_TWICE = {"repeated": "SELECT * FROM deliveries UNION ALL SELECT * FROM deliveries WHERE src_partkey % 41 = 0"}
ORACLE["dedup_exact_repeated"] = W(f"SELECT DISTINCT {BUSINESS} FROM repeated", "deliveries", extra=_TWICE)
ORACLE["dedup_counts_repeated"] = W(f"""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {BUSINESS} FROM repeated)) AS BIGINT) AS dropped_row_dups,
  CAST((SELECT count(*) FROM (SELECT DISTINCT {BUSINESS} FROM repeated)) - count(DISTINCT delivery_id) AS BIGINT) AS dropped_id_dups,
  CAST(count(DISTINCT delivery_id) AS BIGINT) AS rows_after_dedup
FROM repeated""", "deliveries", extra=_TWICE)

_MORE = {"more_stations": "SELECT * FROM stations UNION ALL SELECT 'zaragoza', '9434'",
         "conditions": CONDITIONS.replace("FROM stations s", "FROM more_stations s").replace(
             "coalesce(", "CASE WHEN l.station IS NOT NULL THEN coalesce(").replace("0.0::DOUBLE) AS", "0.0::DOUBLE) END AS")}
ORACLE["display_weather_gap"] = ORACLE["display_weather"].replace("conditions AS (" + CONDITIONS, "more_stations AS (" + _MORE["more_stations"]
                                                                   + "),\nconditions AS (" + _MORE["conditions"])
ORACLE["realtime_weather_gap"] = W("SELECT zone, " + ", ".join(
    f"CASE WHEN weather_rain IS NULL THEN 0.0::DOUBLE ELSE {c} END AS {c}" for c in _RT6) + " FROM realtime",
    "observations", "stations", extra={**_MORE, "realtime": REALTIME})
