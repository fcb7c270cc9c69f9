"""Joining readings to the device dimension, as it is now or as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.sources.scratch import scratch

KEY = "device_id"

# A device with more readings than this share of a task's part is spread over several tasks.
PER_TASK = 4


def lookup(
    readings: DataFrame, dim: DataFrame, columns: list[str], broadcast: bool | None = None, tasks: int | None = None
) -> DataFrame:
    """Left equi-join on ``device_id``; ``dim`` holds one row per device.

    ``broadcast=None`` leaves the choice to Spark, which broadcasts ``dim`` when
    its size allows and splits skewed partitions otherwise. ``False`` shuffles
    both sides, a busy device's readings over several tasks: devices with more
    than a ``PER_TASK``-th of a task's share are counted out (there are at most
    ``PER_TASK`` times ``tasks`` of them), and only their rows are repeated, as
    often as their counts ask for. On a stream nothing can be counted ahead; a
    micro-batch shuffles by device.
    """
    dim = dim.select(KEY, *columns)
    if broadcast is None:
        return readings.join(dim, KEY, "left")
    if broadcast:
        return readings.join(F.broadcast(dim), KEY, "left")
    if readings.isStreaming:
        return readings.join(dim.hint("merge"), KEY, "left")
    tasks = tasks or int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = readings.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg(F.sum("_n")).scalar() / F.lit(PER_TASK * tasks)
    busy = counts.where(F.col("_n") > share).select(KEY, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    busy = F.broadcast(busy)
    salts = F.coalesce("_salts", F.lit(1))
    salted = readings.join(busy, KEY, "left").withColumn("_salt", F.pmod(F.xxhash64(*readings.columns), salts).cast("int"))
    copies = dim.join(busy, KEY, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(copies.hint("merge"), [KEY, "_salt"], "left").drop("_salt", "_salts")


def lookup_as_of(
    readings: DataFrame, versions: DataFrame, at: str, columns: list[str], slices: int | None = None
) -> DataFrame:
    """Left join each reading to the device version valid at its ``at`` time.

    ``versions`` has (device_id, valid_from, *columns), one row per device and
    valid_from; a version without a device or a ``valid_from`` was never in force.

    Readings and versions are swept together along (device, time), whatever the
    size of either. A range partitioning cuts the sorted rows into even slices,
    through a device or a single stamp if need be; the last version before each
    slice is carried into it, so slices fill independently. Readings without a
    device or a time have no version and are not moved.
    """
    spark = readings.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    versions = versions.select(KEY, "valid_from", *columns).where(f"{KEY} IS NOT NULL AND valid_from IS NOT NULL")
    timed = F.col(at).isNotNull() & F.col(KEY).isNotNull()
    version, reading = F.struct("valid_from", *columns), F.struct(*readings.columns)
    kinds = {
        "_v": versions.select(version.alias("_")).schema["_"].dataType,
        "_r": readings.select(reading.alias("_")).schema["_"].dataType,
    }
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()}
    marks = versions.select(
        F.col(KEY).alias("_d"), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"),
        version.alias("_v"), none["_r"],
    ).unionByName(
        readings.where(timed).select(
            F.col(KEY).alias("_d"), F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*readings.columns).alias("_tie"),
            none["_v"], reading.alias("_r"),
        )
    )
    # The slice number comes from a sampled partitioning, so it is written once and read twice.
    marks = scratch(
        marks.repartitionByRange(slices, "_d", "_t", "_kind", "_tie").withColumn("_slice", F.spark_partition_id()), "as-of"
    )

    # One row per (device, slice) touched: at most ``slices`` rows for any device.
    earlier = Window.partitionBy("_d").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    touched = marks.groupBy("_d", "_slice").agg(F.max(F.when(F.col("_kind") == 0, F.col("_t"))).alias("_t"))
    last = marks.where("_kind = 0").select("_d", "_slice", "_t", "_v")
    carried = (
        touched.join(last, ["_d", "_slice", "_t"], "left")
        .withColumn("_v", F.last("_v", ignorenulls=True).over(earlier))
        .where(F.col("_v").isNotNull())
        .select(
            "_d", F.lit(None).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"), "_v", none["_r"], "_slice"
        )
    )
    along = Window.partitionBy("_d", "_slice").orderBy(F.col("_t").asc_nulls_first(), "_kind")
    resolved = (
        marks.drop("_tie").unionByName(carried)
        .withColumn("_v", F.last("_v", ignorenulls=True).over(along))
        .where("_kind = 1")
        .select("_r.*", "_v.*")
    )
    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds["_v"].fields]
    return resolved.unionByName(readings.where(~timed).select(*readings.columns, *unknown))


def latest_per_device(changes: DataFrame, order: list[str]) -> DataFrame:
    """The last change of each device by ``order``; combines map-side, so a busy device is no hot spot."""
    rest = [c for c in changes.columns if c != KEY and c not in order]
    return (
        changes.groupBy(KEY)
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(KEY, *[F.col(f"_last.{c}").alias(c) for c in changes.columns if c != KEY])
    )
