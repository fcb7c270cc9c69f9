"""Table schemas, wire formats and the device seed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "ARRAY<BIGINT>": T.ArrayType(T.LongType()), "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def columns(ddl: str) -> T.StructType:
    """A schema from "name TYPE, ..." without needing a session, so it can be a module constant."""
    fields = (column.split() for column in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# ---- fixed values: names, types, seed rows and limits of the data model ----

TELEMETRY = columns(
    "reading_id BIGINT, device_id STRING, event_time TIMESTAMP_NTZ, energy_usage DOUBLE, "
    "temperature DOUBLE, vibration DOUBLE, signal_strength INT"
)

EVENTS = columns(
    "device_id STRING, event_time TIMESTAMP_NTZ, event_type STRING, severity STRING, "
    "error_code STRING, component STRING, root_cause STRING, technician STRING, "
    "duration_min INT, parts_replaced STRING, status STRING, next_inspection_days INT"
)

DEVICE = columns(
    "device_id STRING, temp_threshold DOUBLE, location_id STRING, model STRING, status STRING"
)

SILVER = columns(
    "reading_id BIGINT, device_id STRING, event_time TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ, "
    "energy_usage DOUBLE, temperature DOUBLE, vibration DOUBLE, signal_strength INT, "
    "temp_threshold DOUBLE, anomaly_flag BOOLEAN, vibration_spike BOOLEAN, "
    "location_id STRING, model STRING"
)

GOLD = columns(
    "device_id STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, cnt_points BIGINT, "
    "cnt_anomalies BIGINT, cnt_vib_spikes BIGINT, avg_temperature DOUBLE, min_temperature DOUBLE, "
    "max_temperature DOUBLE, avg_energy_usage DOUBLE, max_vibration DOUBLE, min_signal INT, "
    "threshold_used DOUBLE, anomaly_flag BOOLEAN, location_id STRING, model STRING"
)

# What the hot log of a landing table has besides: the message and why it was set aside, both NULL in a row of the table.
ASIDE = columns("value STRING, quarantine_reason STRING")

DEVICE_SEED = [
    ("device_1", 24.0, "plant_a", "Model-A", "active"),
    ("device_2", 24.5, "plant_b", "Model-A", "active"),
    ("device_3", 25.0, "plant_c", "Model-B", "active"),
    ("device_4", 25.5, "plant_a", "Model-B", "active"),
    ("device_5", 26.0, "plant_b", "Model-A", "active"),
    ("device_6", 26.5, "plant_c", "Model-C", "active"),
    ("device_7", 27.0, "plant_a", "Model-C", "active"),
    ("device_8", 27.5, "plant_b", "Model-D", "active"),
    ("device_9", 28.0, "plant_c", "Model-D", "active"),
    ("device_10", 28.5, "plant_a", "Model-B", "active"),
    ("device_11", 29.0, "plant_b", "Model-A", "active"),
]

VIBRATION_LIMIT = 3.0
TEMPERATURE_RANGE = (18.0, 30.0)
READING_ID_RANGE = (1, 100_000_000)
SPIKE_RATE = 0.05
EXPECTED_MIX = {"failure": 0.1, "maintenance": 0.3, "inspection": 0.6}
SEVERITIES = ["low", "medium", "high"]
COMPONENTS = ["motor", "bearing", "sensor", "battery"]
ROOT_CAUSES = ["overheating", "wear", "power_surge", "unknown"]
PARTS = ["bearing", "filter", "battery"]
STATUSES = ["passed", "passed", "failed"]  # two passes to one failure
LOCATIONS = ["plant_a", "plant_b", "plant_c"]
MODELS = ["Model-A", "Model-B", "Model-C", "Model-D"]

# The columns each event type carries; every other type's columns are NULL.
EVENT_FIELDS = {
    "failure": ["error_code", "component", "root_cause"],
    "maintenance": ["technician", "duration_min", "parts_replaced"],
    "inspection": ["status", "next_inspection_days"],
}


@dataclass(frozen=True)
class TableSpec:
    """A log table: its columns, the time column flushes are described by, and its tiering."""

    name: str
    schema: T.StructType
    time_column: str
    tiered: bool = True
    freshness: str = "30 seconds"
    log_ttl_days: int = 7
    sets_aside: bool = False  # its hot log also keeps the messages that could not be decoded


IOT_TELEMETRY = TableSpec("iot_telemetry", TELEMETRY, "event_time", sets_aside=True)
IOT_EVENTS = TableSpec("iot_events", EVENTS, "event_time", sets_aside=True)
DEVICE_TELEMETRY = TableSpec("datalake_device_telemetry", SILVER, "event_time")
DEVICE_HEALTH = TableSpec("datalake_device_health_1min", GOLD, "window_start")
DIM_DEVICE = "dim_device"

LOG_TABLES = [IOT_TELEMETRY, IOT_EVENTS, DEVICE_TELEMETRY, DEVICE_HEALTH]
