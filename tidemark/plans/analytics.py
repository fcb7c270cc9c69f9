"""The operational queries, as frames over the tables' frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sizing import at_most
from tidemark.functions.times import naive, whole_seconds_between

# Hot rows whose ids fit a broadcast; a 30-second remainder is normally far below it.
HOT_IDS = 2_000_000


# ---- live ----

def row_count(table: DataFrame, name: str) -> DataFrame:
    """count(*) under ``name``: one row in batch, a running count on a stream."""
    return table.groupBy().agg(F.count(F.lit(1)).alias(name))


def anomaly_feed(silver: DataFrame) -> DataFrame:
    """Readings over their own threshold or with a vibration spike; works on streams too."""
    return silver.where(F.col("anomaly_flag") | F.col("vibration_spike")).select(
        "device_id", "location_id", "temperature", "temp_threshold", "event_time"
    )


def _back_from(as_of: dt.datetime | Column | None, back: str) -> Column:
    """``as_of`` (the clock, unless given) minus ``back``: a constant, so a filter on it reaches the scan."""
    if as_of is None:
        as_of = F.localtimestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = naive(as_of)
    return as_of - F.expr(f"INTERVAL {back}")


def lag_histogram(silver: DataFrame, as_of=None, back: str = "1 MINUTE") -> DataFrame:
    """Whole seconds from sensor to silver, counted, for the most recent readings."""
    return (
        silver.where(F.col("event_time") > _back_from(as_of, back))
        .groupBy(whole_seconds_between("event_time", "ingest_time").alias("lag_s"))
        .agg(F.count(F.lit(1)).alias("readings"))
        .orderBy("lag_s")
    )


# ---- hot against cold ----

def freshness_gap(tagged: DataFrame) -> DataFrame:
    """Union, cold and hot-only counts from one pinned version in one pass.

    ``tagged`` is a union read with its ``_tier`` column, so the three numbers
    describe the same instant and add up; the scan reads no data columns.
    """
    return tagged.agg(
        F.count(F.lit(1)).alias("hot_plus_cold"),
        F.count_if(F.col("_tier") == "cold").alias("cold_only"),
    ).withColumn("rows_only_in_hot", F.col("hot_plus_cold") - F.col("cold_only"))


def only_in_hot(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """Readings of hot plus cold whose ``reading_id`` the cold tier does not hold.

    A cold row always finds itself, unless its id is NULL, so only the hot
    remainder needs the anti-join. When the hot ids fit a broadcast (tasks count
    them, nothing else is sent), the cold tier is scanned for those ids alone
    (one column, no shuffle).
    """
    columns = [F.col("reading_id").alias("reading_only_in_hot"), "device_id", "temperature", "anomaly_flag"]
    hot_ids = hot.select("reading_id").where("reading_id IS NOT NULL")
    cold_ids = cold.select("reading_id")
    if at_most(hot_ids, HOT_IDS):
        cold_ids = cold_ids.join(F.broadcast(hot_ids), "reading_id", "left_semi").distinct()
        cold_ids = F.broadcast(cold_ids)
    missing = hot.join(cold_ids, "reading_id", "left_anti")
    return missing.select(*columns).unionByName(cold.where("reading_id IS NULL").select(*columns))


def only_in_hot_exact(union: DataFrame, cold: DataFrame) -> DataFrame:
    """The rows of ``union`` that ``cold`` lacks, with how many copies of each, whatever their ids.

    ``only_in_hot`` follows the question as it is usually asked, by ``reading_id``; ids are drawn at random and collide, so
    it hides a new reading whose id the cold tier has for another. Here rows are counted whole, as bags: a row that one
    side has more often is a difference too. The two sides meet in one aggregation that combines map-side.
    """
    columns = union.columns
    signed = union.withColumn("_n", F.lit(1)).unionByName(cold.select(*columns).withColumn("_n", F.lit(-1)))
    return signed.groupBy(*columns).agg(F.sum("_n").alias("copies")).where("copies > 0")


def hot_devices(silver: DataFrame) -> DataFrame:
    """Which devices are running hot: anomalies and the worst temperature, most anomalies first."""
    return (
        silver.where("anomaly_flag")
        .groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("anomalies"), F.round(F.max("temperature"), 1).alias("worst_temp"))
        .orderBy(F.desc("anomalies"), "device_id")
    )


# ---- cold only ----

def pct_over_threshold(gold: DataFrame) -> DataFrame:
    """Devices ranked by the share of readings over their threshold."""
    share = F.lit(100.0) * F.sum("cnt_anomalies").cast("double") / F.sum("cnt_points").cast("double")
    return (
        gold.groupBy("device_id")
        .agg(
            F.max("threshold_used").alias("threshold"),
            F.count(F.lit(1)).alias("windows"),
            F.sum("cnt_anomalies").alias("anomalous_readings"),
            F.round(share, 1).alias("pct_over_threshold"),
        )
        .orderBy(F.desc("pct_over_threshold"), "device_id")
    )


def event_counts(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type", "severity")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("event_type", "severity")
    )


def failures_in_context(events: DataFrame, gold: DataFrame, size: str = "1 minute") -> DataFrame:
    """What each machine was doing in the window in which it reported a failure.

    Windows tile time, so flooring the event to the window size turns the
    interval condition into an equality: the join hashes on (device, window)
    and compares no reading with a window it cannot match.
    """
    failed = events.where("event_type = 'failure'").select(
        "device_id",
        "component",
        "root_cause",
        F.window("event_time", size)["start"].cast("timestamp_ntz").alias("window_start"),
    )
    windows = gold.select(
        "device_id",
        "window_start",
        "cnt_anomalies",
        F.round("max_temperature", 1).alias("max_c"),
        "threshold_used",
    )
    return failed.join(windows, ["device_id", "window_start"]).select(
        "device_id", "component", "root_cause", "window_start", "cnt_anomalies", "max_c", "threshold_used"
    )


def failure_context(events: DataFrame, gold: DataFrame, size: str = "1 minute", k: int = 20) -> DataFrame:
    """The ``k`` most recent failures in context; ties are broken so the answer is one."""
    found = failures_in_context(events, gold, size)
    return found.orderBy(
        F.desc("window_start"), "device_id", "component", "root_cause", "cnt_anomalies", "max_c"
    ).limit(k)


def recent_windows(gold: DataFrame, as_of=None, back: str = "120 MINUTE") -> DataFrame:
    """Health windows that started within ``back`` of ``as_of``, the bound included."""
    return gold.where(F.col("window_start") >= _back_from(as_of, back))


# ---- ad hoc ----

def hotter_than(readings: DataFrame, degrees: float) -> DataFrame:
    return readings.where(F.col("temperature") > F.lit(degrees))


def peek(table: DataFrame, rows: int = 5) -> DataFrame:
    """Any few rows; Spark stops scanning once it has them."""
    return table.limit(rows)
