"""Column contracts shared by batch jobs, streams, serving queries and training."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the feature contract and its readers.
RAW_COLUMNS = [
    "ID", "Severity", "Start_Time", "Start_Lat", "Start_Lng", "Street",
    "Weather_Condition", "Temperature_F", "Humidity_pct", "Wind_Speed_mph",
    "Visibility_mi", "Junction", "Traffic_Signal", "Crossing", "Roundabout",
    "Stop", "Station", "Railway", "Sunrise_Sunset",
]
RAW_REQUIRED = ["ID", "Severity", "Start_Time", "Start_Lat", "Start_Lng"]

# Header spellings found in real files, and the plain names used inside.
RAW_RENAMES = {
    "Temperature(F)": "Temperature_F",
    "Humidity(%)": "Humidity_pct",
    "Wind_Speed(mph)": "Wind_Speed_mph",
    "Visibility(mi)": "Visibility_mi",
}

MODEL_FEATURES = [
    "lat", "lon", "hour", "day_of_week", "is_weekend", "is_rush_hour", "weather_code",
    "temperature_f", "humidity", "wind_speed_mph", "visibility_mi", "road_type_code",
    "is_junction", "has_traffic_signal", "is_crossing", "is_roundabout", "is_stop",
    "is_station", "is_railway", "is_night",
]
FEATURE_COLUMNS = ["event_id", "event_year", "event_time", "true_severity", *MODEL_FEATURES]

# Raw infrastructure column -> 0/1 feature.
FLAG_SOURCES = {
    "is_junction": "Junction",
    "has_traffic_signal": "Traffic_Signal",
    "is_crossing": "Crossing",
    "is_roundabout": "Roundabout",
    "is_stop": "Stop",
    "is_station": "Station",
    "is_railway": "Railway",
}
CONTEXT_FLAGS = [*FLAG_SOURCES, "is_night"]

# Raw weather number -> (feature, default, lower bound, upper bound).
WEATHER_BOUNDS = {
    "temperature_f": ("Temperature_F", 50.0, -40.0, 130.0),
    "humidity": ("Humidity_pct", 50.0, 0.0, 100.0),
    "wind_speed_mph": ("Wind_Speed_mph", 0.0, 0.0, 100.0),
    "visibility_mi": ("Visibility_mi", 10.0, 0.0, 10.0),
}

REQUIRED_COLUMNS = ["event_id", "event_year", "true_severity", "lat", "lon"]
FILL_DEFAULTS = {c: 0.0 if c in WEATHER_BOUNDS else 0 for c in MODEL_FEATURES if c not in ("lat", "lon")}

LABEL = "true_severity"
NON_FEATURES = {
    "event_id", "event_year", "event_time", "true_severity",
    "ingestion_time_epoch", "processed_time_epoch", "end_to_end_latency_ms",
}

_DOUBLES = {
    "lat", "lon", "temperature_f", "humidity", "wind_speed_mph", "visibility_mi", "risk_score",
    "inference_latency_ms", "end_to_end_latency_ms", "delay_seconds", "length_meters",
}
_TIMES = {"event_time", "ingestion_time", "processed_time", "updated_at", "created_at"}
_TEXTS = {
    "event_id", "incident_id", "model_status", "state_or_region", "city", "from_road", "to_road",
    "geometry_wkt",
}


def _field(name: str) -> T.StructField:
    if name in _DOUBLES:
        kind: T.DataType = T.DoubleType()
    elif name in _TIMES:
        kind = T.TimestampNTZType()
    elif name in _TEXTS:
        kind = T.StringType()
    else:
        kind = T.IntegerType()
    return T.StructField(name, kind, True)


def schema_of(columns: list[str]) -> T.StructType:
    """StructType for contract columns, typed by name."""
    return T.StructType([_field(c) for c in columns])


# At the file boundary event_time is ISO text and the weather numbers are floats.
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType(), True) if c == "event_time"
        else T.StructField(c, T.FloatType(), True) if c in WEATHER_BOUNDS
        else _field(c)
        for c in FEATURE_COLUMNS
    ]
)
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

_CONTEXT = [
    "weather_code", "temperature_f", "humidity", "wind_speed_mph", "visibility_mi", "road_type_code",
    "hour", "day_of_week", "is_weekend", "is_rush_hour", "is_junction", "has_traffic_signal",
    "is_crossing", "is_roundabout", "is_stop", "is_station", "is_railway", "is_night",
]
REPLAY_COLUMNS = [
    "event_id", "event_year", "event_time", "lat", "lon", "true_severity", "predicted_severity",
    "risk_score", *_CONTEXT, "model_status", "inference_latency_ms", "ingestion_time",
    "processed_time", "end_to_end_latency_ms",
]
LIVE_COLUMNS = [
    "event_id", "incident_id", "event_time", "lat", "lon", "severity", "risk_score", "icon_category",
    "delay_magnitude", "delay_seconds", "length_meters", *_CONTEXT, "state_or_region", "city",
    "from_road", "to_road", "geometry_wkt", "model_status", "ingestion_time", "processed_time",
    "end_to_end_latency_ms",
]
AUDIT_COLUMNS = ["updated_at", "created_at"]
REPLAY_SCHEMA = schema_of(REPLAY_COLUMNS + AUDIT_COLUMNS)
LIVE_SCHEMA = schema_of(LIVE_COLUMNS + AUDIT_COLUMNS)

# One landed response of the live incident feed. Coordinates stay JSON text: their depth varies.
INCIDENT_PAYLOAD = """
incidents array<struct<
  type: string,
  properties: struct<
    id: string, iconCategory: int, magnitudeOfDelay: int, startTime: string, endTime: string,
    `from`: string, `to`: string, length: double, delay: double, roadNumbers: array<string>,
    timeValidity: string, probabilityOfOccurrence: string, numberOfReports: int,
    lastReportTime: string,
    events: array<struct<description: string, code: int, iconCategory: int>>>,
  geometry: struct<type: string, coordinates: string>>>
"""

# Message of the live topic, as written by the incident normalizer. Numbers are read leniently, as text.
LIVE_MESSAGE = """
event_id string, source string, incident_id string, latitude string, longitude string,
timestamp string, event_timestamp string, last_report_time string, state_or_region string,
city string, icon_category string, delay_magnitude string, delay_seconds string,
length_meters string, geometry_wkt string, incident_description string, incident_code string,
from_road string, to_road string, road_numbers array<string>, time_validity string,
probability_of_occurrence string, number_of_reports string, ingestion_time string,
_ingested_at_utc string, visibility_mi string
"""

# Fields that make up the observable state of a live incident.
STATE_FIELDS = [
    "timestamp", "last_report_time", "time_validity", "probability_of_occurrence", "icon_category",
    "delay_magnitude", "delay_seconds", "length_meters", "from_road", "to_road", "road_numbers",
    "geometry_wkt", "incident_code", "incident_description", "number_of_reports",
]

# One landed hourly weather response: parallel arrays.
HOURLY_WEATHER = """
time array<string>, temperature_2m array<double>, relative_humidity_2m array<double>,
weather_code array<int>, wind_speed_10m array<double>
"""

TRACKED_METRICS = [
    "accuracy", "macro_precision", "macro_recall", "macro_f1",
    "weighted_precision", "weighted_recall", "weighted_f1", "logloss",
]
