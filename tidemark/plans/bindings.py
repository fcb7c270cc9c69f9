"""The test tables read as device data: who sent what, when, and how it arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.sources.dimension import seed_rows

# Readings before this instant are the first drop (flushed to the cold tier), the rest the second.
CUT = dt.datetime(2024, 1, 25)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _device() -> Column:
    return F.concat(F.lit("device_"), (F.col("user_id") % 12 + 1).cast("string"))


def _pick(number: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reading; device_12 is deliberately not in the seeded dimension."""
    return events_table(spark, sf_dir).select(
        F.col("event_id").alias("reading_id"),
        _device().alias("device_id"),
        F.col("ts").alias("event_time"),
        (F.col("value") / F.lit(100.0)).alias("energy_usage"),
        F.col("value").alias("temperature"),
        (_k() / F.lit(20.0)).alias("vibration"),
        (F.lit(70) + _k() % 31).alias("signal_strength"),
    )


def iot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a device event, with only its own type's columns set."""
    kind = (
        F.when(F.col("event_type") == "error", "failure")
        .when(F.col("event_type") == "purchase", "maintenance")
        .otherwise("inspection")
    )
    k = F.col("_k")

    def only(wanted: str, value: Column) -> Column:
        return F.when(F.col("_kind") == wanted, value)

    return events_table(spark, sf_dir).withColumn("_k", _k()).withColumn("_kind", kind).select(
        _device().alias("device_id"),
        F.col("ts").alias("event_time"),
        F.col("_kind").alias("event_type"),
        _pick(k, schemas.SEVERITIES).alias("severity"),
        only("failure", F.concat(F.lit("ERR"), (k + 1000).cast("string"))).alias("error_code"),
        only("failure", _pick(k, schemas.COMPONENTS)).alias("component"),
        only("failure", _pick(F.floor(k / 4), schemas.ROOT_CAUSES)).alias("root_cause"),
        only("maintenance", F.concat(F.lit("tech-"), (k % 20 + 1).cast("string"))).alias("technician"),
        only("maintenance", k + 15).alias("duration_min"),
        only("maintenance", _pick(k, schemas.PARTS)).alias("parts_replaced"),
        only("inspection", _pick(k, schemas.STATUSES)).alias("status"),
        only("inspection", k % 24 + 7).alias("next_inspection_days"),
    )


def device_seed(spark: SparkSession) -> DataFrame:
    return seed_rows(spark)


def device_changes(spark: SparkSession, sf_dir: str, device: Column | None = None) -> DataFrame:
    """Every signup as a change to its device's row, in force from then on."""
    k = _k()
    return (
        events_table(spark, sf_dir)
        .where("event_type = 'signup'")
        .select(
            (device if device is not None else _device()).alias("device_id"),
            (F.lit(24.0) + (k % 11) * F.lit(0.5)).alias("temp_threshold"),
            _pick(k, schemas.LOCATIONS).alias("location_id"),
            _pick(k, schemas.MODELS).alias("model"),
            F.lit("active").alias("status"),
            F.col("ts").alias("valid_from"),
        )
    )


def arrival() -> Column:
    """A replayable arrival stamp: zero to three seconds after the reading."""
    return F.expr("event_time + make_dt_interval(0, 0, 0, CAST(reading_id % 4 AS DECIMAL(18, 6)))")


def as_messages(rows: DataFrame) -> DataFrame:
    """Rows as the JSON a device sends: naive ISO-8601 to the millisecond, NULL fields absent."""
    fields = [
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in rows.schema
    ]
    # explode() keeps the encoding one step; see decode().
    return rows.select(F.explode(F.array(F.to_json(F.struct(*fields)))).alias("value"))
