"""Silver to the gold table: one health row per device and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import tumble
from tidemark.schemas import GOLD, VIBRATION_LIMIT


def _ones(condition: Column) -> Column:
    # NULL conditions count 0, so an unknown device has points but no anomalies.
    return F.sum(F.when(condition, 1).otherwise(0))


def is_over() -> Column:
    return F.col("temperature") > F.col("temp_threshold")


def is_spike() -> Column:
    return F.col("vibration") > F.lit(VIBRATION_LIMIT)


def _gold_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "device_id",
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in GOLD.names if c not in ("device_id", "window_start", "window_end", "anomaly_flag")],
        (F.col("max_temperature") > F.col("threshold_used")).alias("anomaly_flag"),
    ).select(*GOLD.names)


def _partial(readings: DataFrame, window: Column, points: Column) -> DataFrame:
    """Sums and extremes by device, window, location and model: fixed-width state, which Spark hashes."""
    return readings.groupBy("device_id", window.alias("window"), "location_id", "model").agg(
        points.alias("cnt_points"),
        _ones(is_over()).alias("cnt_anomalies"),
        _ones(is_spike()).alias("cnt_vib_spikes"),
        F.sum("temperature").alias("_t_sum"),
        F.count("temperature").alias("_t_n"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.sum("energy_usage").alias("_e_sum"),
        F.count("energy_usage").alias("_e_n"),
        F.max("vibration").alias("max_vibration"),
        F.min("signal_strength").alias("min_signal"),
        F.max("temp_threshold").alias("threshold_used"),
    )


def _whole(partial: DataFrame, window: Column) -> DataFrame:
    """The few partial rows of a device and window as one; only here strings are compared."""
    return partial.groupBy("device_id", window.alias("window")).agg(
        F.sum("cnt_points").alias("cnt_points"),
        F.sum("cnt_anomalies").alias("cnt_anomalies"),
        F.sum("cnt_vib_spikes").alias("cnt_vib_spikes"),
        F.try_divide(F.sum("_t_sum"), F.sum("_t_n")).alias("avg_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.try_divide(F.sum("_e_sum"), F.sum("_e_n")).alias("avg_energy_usage"),
        F.max("max_vibration").alias("max_vibration"),
        F.min("min_signal").alias("min_signal"),
        F.max("threshold_used").alias("threshold_used"),
        F.max("location_id").alias("location_id"),
        F.max("model").alias("model"),
    )


def health(readings: DataFrame, by: str = "ingest_time", size: str = "1 minute") -> DataFrame:
    """Tumbling health windows over ``by``, for batch frames.

    Spark sorts its input to aggregate strings with max(), so the readings are
    first hash-aggregated with location and model as keys (one combination per
    device unless the dimension changed mid-window), and only those few partial
    rows take the string max.
    """
    return _gold_columns(_whole(_partial(readings, tumble(by, size), F.count(F.lit(1))), F.col("window")))


def health_stream(
    readings: DataFrame, by: str = "ingest_time", delay: str = "0 seconds", size: str = "1 minute"
) -> DataFrame:
    """The same windows over a stream, append-only: a row appears once its window has closed.

    Two windowed aggregations in a chain, for the same reason as in batch: the
    first closes a window's partial rows, the second puts them together in the
    same micro-batch. ``readings`` may carry clock ticks, rows whose ``is_tick``
    is true: they move the watermark while no reading arrives. A tick has no
    device, location or model and counts no point, so groups of ticks alone are
    dropped by that count, after the watermark has seen them; readings without a
    device stay, as they do in batch.
    """
    tick = F.coalesce("is_tick", F.lit(False)) if "is_tick" in readings.columns else F.lit(False)
    timed = readings.withColumn(by, F.col(by).cast("timestamp")).withWatermark(by, delay)
    partial = _partial(timed, tumble(by, size), _ones(~tick)).where("cnt_points > 0")
    return _gold_columns(_whole(partial, F.window(F.window_time("window"), size)))
