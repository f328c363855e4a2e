"""DuckDB SQL text of the fixture views (independent of the Spark code).

Each constant is one CTE body; ``with_views`` stitches the ones a query
needs in front of it. Numeric literals are cast to DOUBLE explicitly because
DuckDB types bare decimals as DECIMAL.
"""

from __future__ import annotations

_HOLIDAYS = ("'01-01','01-06','03-28','03-29','04-01','05-01','08-15',"
             "'10-12','11-01','12-06','12-08','12-25'")
_ZONES = "['madrid','barcelona','valencia','sevilla']"
_ZONE_TYPES = "['residential','historic_center','offices','industrial']"
_PRODUCTS = "['standard','fragile','bulky','high_value','signature_required']"
_STATIONS = "['3195','0076','8416','5783']"

_D = "1.0::DOUBLE"

VIEWS: dict[str, str] = {}

VIEWS["deliveries_base"] = f"""
SELECT
  'dlv_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS delivery_id,
  CAST(l.l_shipdate AS DATE) AS date,
  CAST(8 + l.l_partkey % 11 AS INTEGER) AS hour,
  CAST(isodow(CAST(l.l_shipdate AS DATE)) - 1 AS INTEGER) AS day_of_week,
  CASE WHEN strftime(CAST(l.l_shipdate AS DATE), '%m-%d') IN ({_HOLIDAYS}) THEN 1 ELSE 0 END AS is_holiday,
  {_ZONES}[l.l_suppkey % 4 + 1] AS zone,
  {_ZONE_TYPES}[l.l_partkey % 4 + 1] AS zone_type,
  o.o_custkey AS recipient_id,
  l.l_discount * 10.0::DOUBLE AS recipient_failure_rate,
  CAST((l.l_linenumber - 1) % 4 AS INTEGER) AS num_previous_attempts,
  'driver_' || CAST(l.l_suppkey AS VARCHAR) AS driver_id,
  (s.s_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS driver_quality_score,
  CAST(5 + l.l_partkey % 55 AS INTEGER) AS driver_delivery_load,
  {_PRODUCTS}[CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)] AS product_type,
  l.l_quantity AS weight_kg,
  CASE WHEN l.l_linenumber % 5 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weather_rain,
  l.l_tax * 100.0::DOUBLE AS weather_wind_speed,
  l.l_quantity - 10.0::DOUBLE AS weather_temperature,
  CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS delivery_failed,
  l.l_partkey AS src_partkey, l.l_suppkey AS src_suppkey, l.l_extendedprice AS src_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

VIEWS["deliveries"] = """
SELECT delivery_id, date, hour, day_of_week, is_holiday, zone, zone_type, recipient_id,
  recipient_failure_rate, num_previous_attempts, driver_id, driver_quality_score,
  driver_delivery_load, product_type,
  CASE WHEN product_type = 'signature_required' THEN 1 ELSE 0 END AS requires_signature,
  CASE WHEN product_type = 'fragile' THEN 1 ELSE 0 END AS is_fragile,
  CASE WHEN product_type = 'bulky' THEN 1 ELSE 0 END AS is_bulky,
  weight_kg, weather_rain, weather_wind_speed, weather_temperature,
  CASE WHEN num_previous_attempts > 0 THEN 1 ELSE 0 END AS is_retry,
  delivery_failed, src_partkey, src_suppkey, src_price
FROM deliveries_base"""

VIEWS["deliveries_dirty"] = """
SELECT * REPLACE (
  CASE WHEN src_partkey % 97 = 0 THEN 55.0::DOUBLE WHEN src_partkey % 89 = 0 THEN 47.0::DOUBLE
       ELSE weather_temperature END AS weather_temperature,
  CASE WHEN src_partkey % 79 = 0 THEN 41.0::DOUBLE ELSE weather_wind_speed END AS weather_wind_speed,
  CASE WHEN src_partkey % 73 = 0 THEN 0.0::DOUBLE WHEN src_partkey % 61 = 0 THEN 'NaN'::DOUBLE
       ELSE weight_kg END AS weight_kg,
  CASE WHEN src_partkey % 71 = 0 THEN 24 ELSE hour END AS hour,
  CASE WHEN src_partkey % 67 = 0 THEN NULL ELSE num_previous_attempts END AS num_previous_attempts,
  CASE WHEN src_partkey % 59 = 0 THEN 1.5::DOUBLE ELSE recipient_failure_rate END AS recipient_failure_rate,
  CASE WHEN src_partkey % 53 = 0 THEN 250.0::DOUBLE ELSE weather_rain END AS weather_rain)
FROM deliveries"""

VIEWS["deliveries_gaps"] = """
SELECT * REPLACE (
  CASE WHEN src_partkey % 101 = 0 THEN NULL ELSE weather_rain END AS weather_rain,
  CASE WHEN src_partkey % 103 = 0 THEN 'NaN'::DOUBLE ELSE weather_wind_speed END AS weather_wind_speed,
  CASE WHEN src_partkey % 107 = 0 THEN NULL ELSE delivery_failed END AS delivery_failed)
FROM deliveries"""

VIEWS["wbase"] = f"""
SELECT CAST(o_orderdate AS DATE) AS date, {_ZONES}[o_custkey % 4 + 1] AS zone,
  min(o_totalprice) AS min_tp, max(o_totalprice) AS max_tp
FROM orders GROUP BY 1, 2"""

VIEWS["weather_daily"] = """
SELECT date, zone,
  greatest(CAST(floor(min_tp * 10) AS BIGINT) % 300 - 200, 0) / 10.0::DOUBLE AS weather_rain,
  (CAST(floor(max_tp) AS BIGINT) % 150) / 10.0::DOUBLE AS weather_wind_speed,
  (CAST(floor(max_tp * 10) AS BIGINT) % 450) / 10.0::DOUBLE - 5.0::DOUBLE AS weather_temperature
FROM wbase"""


def _comma(t: str) -> str:
    return (f"(CASE WHEN {t} < 0 THEN '-' ELSE '' END || CAST(abs({t}) // 10 AS VARCHAR) || ',' "
            f"|| CAST(abs({t}) % 10 AS VARCHAR))")


VIEWS["weather_raw"] = f"""
SELECT
  CASE zone WHEN 'madrid' THEN '3195' WHEN 'barcelona' THEN '0076'
            WHEN 'valencia' THEN '8416' WHEN 'sevilla' THEN '5783' END AS station,
  zone,
  CAST(date - DATE '1970-01-01' AS INTEGER) AS obs_seq,
  CASE WHEN x10 % 211 = 0 THEN 'bad' ELSE CAST(date AS VARCHAR) END AS fecha,
  CASE WHEN m10 % 17 = 0 THEN 'Ip' WHEN m10 % 19 = 0 THEN '-' WHEN m10 % 23 = 0 THEN NULL
       ELSE {_comma('greatest(m10 % 300 - 200, 0)')} END AS prec,
  CASE WHEN x10 % 29 = 0 THEN 'x'
       WHEN zone = 'barcelona' THEN CAST((w10 * 36) // 100 AS VARCHAR) || ','
            || lpad(CAST((w10 * 36) % 100 AS VARCHAR), 2, '0')
       ELSE {_comma('w10')} END AS velmedia,
  CASE WHEN x10 % 7 = 0 THEN NULL ELSE {_comma('(x10 % 450 - 50)')} END AS tmed
FROM (SELECT *, CAST(floor(min_tp * 10) AS BIGINT) AS m10, CAST(floor(max_tp * 10) AS BIGINT) AS x10,
             CAST(floor(max_tp) AS BIGINT) % 150 AS w10 FROM wbase)"""

VIEWS["observations"] = f"""
SELECT {_STATIONS}[user_id % 4 + 1] AS station,
  CAST(ts AS TIMESTAMP) AS obs_ts,
  CASE WHEN event_type = 'error' THEN 'n/a'
       ELSE CAST((v100 % 900) // 100 AS VARCHAR) || '.' || lpad(CAST(v100 % 100 AS VARCHAR), 2, '0') END AS prec,
  CAST((v100 % 1500) // 100 AS VARCHAR) || '.' || CAST(v100 % 10 AS VARCHAR) AS vv,
  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) % 40 - 5 AS VARCHAR) END AS ta
FROM (SELECT *, CAST(floor(value * 100) AS BIGINT) AS v100 FROM events)"""

VIEWS["stations"] = """
SELECT * FROM (VALUES ('madrid', '3195'), ('barcelona', '0076'), ('valencia', '8416'),
  ('sevilla', '5783')) AS t(zone, station)"""

# dependencies between the views, in definition order
_DEPS = {
    "deliveries": ["deliveries_base"],
    "deliveries_dirty": ["deliveries"],
    "deliveries_gaps": ["deliveries"],
    "weather_daily": ["wbase"],
    "weather_raw": ["wbase"],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <views...>, <extra...> <body>``; extra CTEs may use the views."""
    ctes = [f"{n} AS ({VIEWS[n]})" for n in _closure(names)]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(ctes) + "\n" + body
