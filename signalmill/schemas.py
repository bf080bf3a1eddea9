"""Declared schemas and the fixed values of the telemetry contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: they must equal the published contracts ---------------------------------

SIGNAL_STATES = ("GREEN", "RED", "YELLOW", "FLASHING_YELLOW", "UNKNOWN")
EVENT_SOURCES = ("simulator", "municipal_feed", "osm_probe")
INVENTORY_SOURCES = ("osm", "manual_fallback")

ID_PATTERN = r"^[A-Za-z0-9_-]+\z"
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:?\d{2})?\z"
)

ROOT_KEYS = ("event_id", "intersection_id", "environment", "telemetry")
ENVIRONMENT_KEYS = ("timestamp", "source")
TELEMETRY_KEYS = (
    "current_signal_state",
    "avg_stop_duration_seconds",
    "avg_vehicle_speed_kmh",
)
OPTIONAL_ROOT_KEYS = ("metadata",)

SEVERE_STOP_SECONDS = 75.0
SEVERE_SPEED_KMH = 5.0
WINDOW_LENGTH = "1 minute"
WATERMARK = "10 seconds"
TRIGGER = "15 seconds"
FRESH_SECONDS = 120.0
MAX_INVALID_SHARE = 0.001
MAX_EMISSION_GAP_SECONDS = 10
P95_EVENT_TO_STATUS_SECONDS = 120
P95_WINDOW_TO_CORE_SECONDS = 180
SOURCE_WARN_SECONDS = 3 * 60
SOURCE_ERROR_SECONDS = 10 * 60

NO_TELEMETRY_WINDOW = "1970-01-01T00:00:00Z"
# Default area as south, west, north, east.
DEFAULT_BBOX = (-27.12, -52.67, -27.06, -52.56)

# --- Schemas -------------------------------------------------------------------------------

FLAT_EVENT = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("signal_state", T.StringType()),
        T.StructField("avg_stop_duration_seconds", T.DoubleType()),
        T.StructField("avg_vehicle_speed_kmh", T.DoubleType()),
    ]
)

# The fields of a JSON event before anything is known about their kinds.
EVENT_TEXT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("intersection_id", T.StringType()),
        T.StructField(
            "environment",
            T.StructType([T.StructField(name, T.StringType()) for name in ENVIRONMENT_KEYS]),
        ),
        T.StructField(
            "telemetry",
            T.StructType([T.StructField(name, T.StringType()) for name in TELEMETRY_KEYS]),
        ),
    ]
)

# Column order is part of the contract.
LANDING = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("signal_state", T.StringType()),
        T.StructField("avg_stop_duration_seconds", T.DoubleType()),
        T.StructField("avg_vehicle_speed_kmh", T.DoubleType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
LANDING_KEY = ("intersection_id", "window_end")
LANDING_REQUIRED = tuple(f for f in LANDING.fieldNames() if f != "ingested_at")

# A window as far as one micro-batch has seen it: sums that add up, and the last state with its place.
PARTIAL = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("signal_state", T.StringType()),
        T.StructField("last_at", T.TimestampType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("stop_sum", T.DoubleType()),
        T.StructField("stop_count", T.LongType()),
        T.StructField("speed_sum", T.DoubleType()),
        T.StructField("speed_count", T.LongType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("late_count", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("osm_node_id", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

INVENTORY_REQUIRED = ("intersection_id", "display_name", "latitude", "longitude")

POINT = T.StructType(
    [T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType())]
)

CORE = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("signal_state", T.StringType()),
        T.StructField("avg_stop_duration_seconds", T.DoubleType()),
        T.StructField("avg_vehicle_speed_kmh", T.DoubleType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("is_severe_bottleneck", T.BooleanType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("spatial_geography_point", POINT),
    ]
)

STATUS = T.StructType(
    [
        T.StructField("intersection_id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("signal_state", T.StringType()),
        T.StructField("avg_stop_duration_seconds", T.DoubleType()),
        T.StructField("avg_vehicle_speed_kmh", T.DoubleType()),
        T.StructField("is_severe_bottleneck", T.BooleanType()),
        T.StructField("window_end", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                ]
            ),
        ),
    ]
)

HEALTH = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("freshness_status", T.StringType()),
        T.StructField("max_lag_seconds", T.DoubleType()),
        T.StructField("intersection_count", T.LongType()),
    ]
)

MAP_ELEMENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)
MAP_EXTRACT = T.StructType([T.StructField("elements", T.ArrayType(MAP_ELEMENT))])


def same_shape(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Differences in column order, name or type; empty when the two declarations agree."""
    problems = []
    if actual.fieldNames() != expected.fieldNames():
        problems.append(f"columns {actual.fieldNames()} instead of {expected.fieldNames()}")
    for field in expected.fields:
        if field.name in actual.fieldNames() and actual[field.name].dataType != field.dataType:
            problems.append(
                f"{field.name} is {actual[field.name].dataType.simpleString()}"
                f" instead of {field.dataType.simpleString()}"
            )
    return problems


def require_shape(df, expected: T.StructType):
    """Pass the frame through, or fail before anything is written."""
    problems = same_shape(df.schema, expected)
    if problems:
        raise ValueError("; ".join(problems))
    return df
