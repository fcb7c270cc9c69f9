"""Readings to the silver table: thresholds, flags and the arrival stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import now_millis
from tidemark.operators.lookup import lookup
from tidemark.schemas import SILVER, VIBRATION_LIMIT

DIM_COLUMNS = ["temp_threshold", "location_id", "model"]


def enriched(readings: DataFrame, dim: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Each reading with its device's threshold, location and model; NULLs for an unknown device."""
    return lookup(readings, dim, DIM_COLUMNS, broadcast)


def flag(readings: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Add ``ingest_time`` and the two flags, in the silver column order.

    Both flags are strict and stay NULL when an operand is: a reading of an
    unknown device is neither an anomaly nor cleared of being one.
    """
    return readings.select(
        "*",
        (arrival if arrival is not None else now_millis()).alias("ingest_time"),
        (F.col("temperature") > F.col("temp_threshold")).alias("anomaly_flag"),
        (F.col("vibration") > F.lit(VIBRATION_LIMIT)).alias("vibration_spike"),
    ).select(*SILVER.names)


def silver(
    readings: DataFrame, dim: DataFrame, arrival: Column | None = None, broadcast: bool | None = None
) -> DataFrame:
    return flag(enriched(readings, dim, broadcast), arrival)
