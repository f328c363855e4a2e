"""Fixed values and default parameters.

Everything under a "fixed values" heading must equal the behaviour we
reproduce (bounds, vocabularies, thresholds, calendar). Tunables are plain
keyword arguments of the operators; the defaults live here.
"""

from __future__ import annotations

# --- fixed values: target and identifiers -----------------------------------
TARGET = "delivery_failed"
EXCLUDE_COLS = ("delivery_id", "recipient_id", "delivery_failed")

# --- fixed values: the 23-column delivery contract --------------------------
DELIVERY_COLUMNS = (
    "delivery_id", "date", "hour", "day_of_week", "is_holiday", "zone",
    "zone_type", "recipient_id", "recipient_failure_rate",
    "num_previous_attempts", "driver_id", "driver_quality_score",
    "driver_delivery_load", "product_type", "requires_signature",
    "is_fragile", "is_bulky", "weight_kg", "weather_rain",
    "weather_wind_speed", "weather_temperature", "is_retry",
    "delivery_failed",
)
REQUIRED_COLUMNS = (
    "delivery_failed", "recipient_failure_rate", "driver_quality_score",
    "weather_rain", "weather_wind_speed", "weather_temperature",
)

# --- fixed values: quality gates ---------------------------------------------
CRITICAL_COLS = (
    "delivery_failed", "recipient_failure_rate", "driver_quality_score",
    "weather_rain", "weather_wind_speed", "weather_temperature",
)
# column -> (min inclusive, max inclusive); None = unbounded
RANGE_RULES = (
    ("weather_temperature", -20.0, 50.0),
    ("weather_wind_speed", 0.0, None),
    ("weather_rain", 0.0, None),
    ("recipient_failure_rate", 0.0, 1.0),
    ("driver_quality_score", 0.0, 1.0),
    ("weight_kg", 0.001, None),
    ("hour", 0, 23),
    ("num_previous_attempts", 0, None),
)
# physically impossible weather: column -> inclusive upper limit
WEATHER_HARD_LIMITS = (
    ("weather_wind_speed", 40.0),
    ("weather_temperature", 45.0),
    ("weather_rain", 200.0),
)

# --- fixed values: closed category domains ----------------------------------
ZONES = ("madrid", "barcelona", "valencia", "sevilla")
ZONE_TYPES = ("residential", "historic_center", "offices", "industrial")
PRODUCT_TYPES = ("standard", "fragile", "bulky", "high_value", "signature_required")
# weather station per city
STATIONS = (("madrid", "3195"), ("barcelona", "0076"), ("valencia", "8416"),
            ("sevilla", "5783"))

# --- fixed values: calendar --------------------------------------------------
HOLIDAYS_MM_DD = ("01-01", "01-06", "03-28", "03-29", "04-01", "05-01",
                  "08-15", "10-12", "11-01", "12-06", "12-08", "12-25")

# --- fixed values: risk bands and actions ------------------------------------
HIGH_MULTIPLIER = 1.3
ACTION_HIGH = "REAGENDAR_SMS"
ACTION_MEDIUM = "CAMBIAR_FRANJA"
ACTION_LOW = "ENTREGA_NORMAL"
DEFAULT_THRESHOLD = 0.5
SMS_THRESHOLD = 0.70
DEFAULT_PHONE = "+34000000000"
UNKNOWN_CITY = "desconocida"

# --- fixed values: evaluation -----------------------------------------------
THRESHOLD_MIN, THRESHOLD_MAX, THRESHOLD_STEP = 0.2, 0.7, 0.02
DAILY_VOLUME = 18000
PRIMARY_METRIC = "avg_precision"

# --- fixed values: weather ---------------------------------------------------
STRONG_WIND_MS = 10.0
ADVERSE_RAIN_MM_HISTORICAL = 2.0
ADVERSE_RAIN_MM_REALTIME = 5.0
TEMP_CATEGORY_EDGES = (5.0, 15.0, 25.0)
TEMP_CATEGORY_SPAN = (-999.0, 999.0)
WIND_KMH_MEAN_CUTOFF = 20.0
MISSING_TEMPERATURE = 15.0
TRACE_RAIN_MM = 0.1
DISPLAY_FALLBACK = (0.0, 2.0, 18.0)  # rain mm, wind m/s, temp C

# --- fixed values: drift -----------------------------------------------------
PSI_BUCKETS = 10
PSI_EPS = 1e-8
PSI_WARN, PSI_ALERT = 0.1, 0.2
MIN_SAMPLES_FOR_DRIFT = 1000
MAX_DRIFT_FEATURES = 20  # the published job's limit; ours checks all features unless it is passed

# --- fixed values: manual deliveries -----------------------------------------
MANUAL_RECIPIENT_RATE = 0.2
MANUAL_DRIVER_SCORE = 0.75

# --- fixed values: map colours -----------------------------------------------
MAP_RED, MAP_AMBER, MAP_GREEN = "#ef4444", "#f59e0b", "#22c55e"

# --- split -------------------------------------------------------------------
TEST_SIZE, VAL_SIZE, SPLIT_SEED = 0.2, 0.1, 42


def snapshot() -> dict:
    """Plain-data copy of the settings above, stored with every saved model."""
    return {k: v for k, v in globals().items()
            if k.isupper() and isinstance(v, (str, int, float, tuple))}

# column that the bronze step adds: a row's place in the ingested data
INGEST_POSITION = "ingest_pos"
