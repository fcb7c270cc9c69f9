from __future__ import annotations

import datetime as dt
import json

from tidemark import schemas

SILVER_DEFAULTS = {
    "reading_id": 1, "device_id": "device_1", "event_time": None, "ingest_time": None,
    "energy_usage": 1.0, "temperature": 20.0, "vibration": 0.5, "signal_strength": 90,
    "temp_threshold": 24.0, "anomaly_flag": False, "vibration_spike": False,
    "location_id": "plant_a", "model": "Model-A",
}


def at(minute: int, second: int = 0, milli: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute, seconds=second, milliseconds=milli)


def silver_rows(spark, rows: list[dict]):
    filled = [tuple({**SILVER_DEFAULTS, **row}[c] for c in schemas.SILVER.names) for row in rows]
    return spark.createDataFrame(filled, schemas.SILVER)


def readings(spark, rows: list[dict]):
    defaults = {"event_time": at(0), "energy_usage": 1.0, "temperature": 20.0, "vibration": 0.5,
                "signal_strength": 90, "device_id": "device_1", "reading_id": 1}
    filled = [tuple({**defaults, **row}[c] for c in schemas.TELEMETRY.names) for row in rows]
    return spark.createDataFrame(filled, schemas.TELEMETRY)


def message(reading_id: int = 1, device_id: str = "device_1", when: dt.datetime | None = None, **over) -> str:
    body = {
        "reading_id": reading_id, "device_id": device_id,
        "event_time": (when or at(0)).isoformat(timespec="milliseconds"),
        "energy_usage": 1.0, "temperature": 20.0, "vibration": 0.5, "signal_strength": 90,
    }
    return json.dumps({**body, **over})


def drop_lines(spark, path: str, lines: list[str]) -> None:
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def drop_rows(df, path: str) -> None:
    df.coalesce(1).write.parquet(path)
