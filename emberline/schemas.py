"""Column sets, layouts and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY = "province_id"

# --- fixed values: detection files -------------------------------------------------------
NRT_COLUMNS = [
    "latitude", "longitude", "bright_ti4", "scan", "track", "acq_date", "acq_time",
    "satellite", "instrument", "confidence", "version", "bright_ti5", "frp", "daynight",
]
ARCHIVE_COLUMNS = [
    "latitude", "longitude", "brightness", "scan", "track", "acq_date", "acq_time",
    "satellite", "instrument", "confidence", "version", "bright_t31", "frp", "daynight", "type",
]
HEADER_CRITICAL = ["latitude", "longitude", "acq_date", "acq_time"]
DETECTION_REQUIRED = ["latitude", "longitude", "acq_date", "acq_time", "frp"]
DETECTION_KEPT = [
    "latitude", "longitude", "acq_date", "acq_time", "frp", "confidence", "daynight", "satellite",
]

# --- fixed values: weather ---------------------------------------------------------------
WEATHER = [
    "temperature_2m_max", "temperature_2m_min", "precipitation_sum",
    "windspeed_10m_max", "winddirection_10m_dominant", "relative_humidity_2m_mean",
]
WEATHER_REQUIRED = [ENTITY, "date"]
# Constants the dashboard sends to the model in place of weather it does not have.
WEATHER_CONSTANTS = {
    "temperature_2m_max": 32.0,
    "temperature_2m_min": 24.0,
    "precipitation_sum": 0.0,
    "windspeed_10m_max": 10.0,
    "winddirection_10m_dominant": 180.0,
    "relative_humidity_2m_mean": 75.0,
}
DRY_DAYS_CONSTANT = 7

# --- fixed values: areas, in priority order (first match wins) ----------------------------
# id, display name, lat_min, lon_min, lat_max, lon_max
AREAS = [
    ("kalteng", "Kalimantan Tengah", -3.5, 110.5, 1.5, 116.5),
    ("kalbar", "Kalimantan Barat", -3.0, 108.0, 2.5, 118.0),
    ("riau", "Riau", 0.0, 100.0, 4.5, 106.5),
    ("sumsel", "Sumatera Selatan", -5.5, 102.0, -1.0, 108.5),
    ("jambi", "Jambi", -3.0, 101.0, -0.5, 105.0),
]

# --- fixed values: features --------------------------------------------------------------
WINDOWS = (1, 3, 7)
HORIZON = 1
RAIN_MM = 1.0
UTC_OFFSET_HOURS = 7
FEATURES = [
    "hotspot_count", "frp_mean", "frp_max", "frp_sum",
    "n_daytime", "n_nighttime", "n_confidence_high",
    *WEATHER,
    "month", "day_of_year", "month_sin", "month_cos",
    "hotspot_count_1d", "hotspot_count_3d", "hotspot_count_7d",
    "frp_mean_1d", "frp_mean_3d", "frp_mean_7d",
    "hotspot_count_lag_1d", "hotspot_count_lag_3d", "hotspot_count_lag_7d",
    "days_since_rain",
]
INT_FEATURES = {"month", "day_of_year"}
LONG_FEATURES = {"hotspot_count", "n_daytime", "n_nighttime", "n_confidence_high", "days_since_rain"}
TARGET_COUNT = "hotspot_count_tomorrow"
TARGET_CLASS = "risk_level"

# --- fixed values: risk classes ----------------------------------------------------------
RISK_LABELS = {0: "Aman", 1: "Waspada", 2: "Bahaya"}
AMAN_MAX = 0
WASPADA_MAX = 10

# --- fixed values: monitoring ------------------------------------------------------------
DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
PREDICTION_BOUNDS = [0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0, 1000.0]

# --- fixed values: scenarios -------------------------------------------------------------
FIRE = ["frp_mean", "frp_max", "frp_sum", "hotspot_count"]
ROLLING = [
    "hotspot_count_1d", "hotspot_count_3d", "hotspot_count_7d",
    "frp_mean_1d", "frp_mean_3d", "frp_mean_7d",
    "hotspot_count_lag_1d", "hotspot_count_lag_3d", "hotspot_count_lag_7d",
]
SHIFTED_WEATHER = [
    "temperature_2m_max", "temperature_2m_min", "precipitation_sum",
    "relative_humidity_2m_mean", "windspeed_10m_max",
]
PHYSICAL_BOUNDS = {
    "precipitation_sum": (0.0, 500.0),
    "relative_humidity_2m_mean": (0.0, 100.0),
    "temperature_2m_max": (-10.0, 50.0),
    "temperature_2m_min": (-15.0, 40.0),
    "windspeed_10m_max": (0.0, 100.0),
    "days_since_rain": (0, 90),
}


def text_schema(columns: list[str]) -> T.StructType:
    """All-string landing schema: types come later, through try_cast."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


AREA_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType(), False),
    T.StructField(ENTITY, T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("lat_min", T.DoubleType()),
    T.StructField("lon_min", T.DoubleType()),
    T.StructField("lat_max", T.DoubleType()),
    T.StructField("lon_max", T.DoubleType()),
])

WEATHER_PAYLOAD = T.StructType([
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in WEATHER])),
])

ALERT_PAYLOAD = T.StructType([
    T.StructField("alerts", T.ArrayType(T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("labels", T.StructType([T.StructField("alertname", T.StringType())])),
        T.StructField("annotations", T.StructType([T.StructField("summary", T.StringType())])),
    ]))),
])
