"""Queries on a table that keep answering while rows land."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import whole_seconds_between
from tidemark.plans import analytics
from tidemark.sources import storage
from tidemark.sources.scratch import folder


def running_count(
    table: DataFrame, name: str, view: str, trigger: dict, checkpoint: str | None = None
) -> StreamingQuery:
    """A count(*) that updates in place in the in-memory table ``view`` (one row).

    The count is state that executors write to ``checkpoint`` and read again;
    without one it goes to a new folder under ``spark.checkpoint.dir``.
    """
    return (
        analytics.row_count(table, name)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(view)
        .option("checkpointLocation", checkpoint or folder(table.sparkSession, "running-count"))
        .trigger(**trigger)
        .start()
    )


def feed(silver: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """The anomaly feed, appended to ``path`` as readings land."""
    return (
        analytics.anomaly_feed(silver)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def failures_in_context(events: DataFrame, gold: DataFrame, size: str = "1 minute", delay: str = "1 hour") -> DataFrame:
    """``analytics.failures_in_context`` over two streams: a failure meets its window whichever comes first.

    Both sides are kept until the other's watermark says that nothing can match them any more: a window until failures
    later than its end by ``delay`` have come, a failure until windows later than itself have. The equality on
    the floored time keeps a device's failures and windows apart by the hour or minute; the range condition is what Spark
    reads the expiry from.
    """
    failed = events.where("event_type = 'failure'").select(
        F.col("device_id").alias("failed_device"), "component", "root_cause",
        F.col("event_time").cast("timestamp").alias("failed_at"),
        F.window("event_time", size)["start"].cast("timestamp_ntz").alias("failed_in"),
    ).withWatermark("failed_at", delay)
    windows = gold.select(
        "device_id", "window_start", F.col("window_start").cast("timestamp").alias("opened_at"), "cnt_anomalies",
        F.round("max_temperature", 1).alias("max_c"), "threshold_used",
    ).withWatermark("opened_at", delay)
    meets = (
        (F.col("failed_device") == F.col("device_id")) & (F.col("failed_in") == F.col("window_start"))
        & (F.col("failed_at") >= F.col("opened_at")) & (F.col("failed_at") < F.col("opened_at") + F.expr(f"INTERVAL {size}"))
    )
    return failed.join(windows, meets).select(
        "device_id", "component", "root_cause", "window_start", "cnt_anomalies", "max_c", "threshold_used"
    )


class HotRanking:
    """The ``k`` devices with the most anomalies, replaced as readings land.

    Spark keeps every device's count and passes on those that changed. As counts only grow, a device that enters the
    ranking has just changed, so the last ranking and the changed devices are all there is to rank: the greater of a
    device's two counts is its new one. ``batch=N`` under ``path`` is the ranking after micro-batch N; a repeated
    micro-batch starts from the one before it and writes the same again.
    """

    def __init__(self, spark, path: str, checkpoint: str, k: int = 20):
        self.spark, self.path, self.checkpoint, self.k = spark, path, checkpoint, k

    def _newest(self, before: int | None = None) -> str | None:
        done = [int(n.split("=")[1]) for n in storage.names(self.spark, self.path) if n.startswith("batch=")]
        done = [n for n in done if (before is None or n < before) and storage.exists(self.spark, f"{self.path}/batch={n}/_SUCCESS")]
        return f"{self.path}/batch={max(done)}" if done else None

    def _read(self, path: str | None) -> DataFrame:
        schema = "device_id STRING, anomalies BIGINT, worst_temp DOUBLE"
        return self.spark.read.schema(schema).parquet(path) if path else self.spark.createDataFrame([], schema)

    def current(self) -> DataFrame:
        """The ranking as it is now."""
        best = [F.desc("anomalies"), "device_id"]
        rows = self._read(self._newest()).withColumn("worst_temp", F.round("worst_temp", 1))
        return rows.orderBy(*best)

    def _replace(self, changed: DataFrame, batch_id: int) -> None:
        both = self._read(self._newest(batch_id)).unionByName(changed)
        newest = both.groupBy("device_id").agg(F.max("anomalies").alias("anomalies"), F.max("worst_temp").alias("worst_temp"))
        top = newest.orderBy(F.desc("anomalies"), "device_id").limit(self.k)
        top.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def start(self, silver: DataFrame, trigger: dict) -> StreamingQuery:
        counts = silver.where("anomaly_flag").groupBy("device_id").agg(
            F.count(F.lit(1)).alias("anomalies"), F.max("temperature").alias("worst_temp")
        )
        return (
            counts.writeStream.outputMode("update")
            .foreachBatch(self._replace)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .start()
        )


def lag_histograms(silver: DataFrame, slide: str = "1 second", back: str = "1 minute", delay: str = "10 seconds") -> DataFrame:
    """as_of, lag_s, readings: ``analytics.lag_histogram`` at every instant, ``slide`` apart, as readings land.

    A reading is counted once, in a pane of one second; the sliding minute adds up panes. An instant's histogram is
    emitted once no reading of its minute can come any more, readings later than ``delay`` are not in it.
    """
    # The minute is open at its beginning and closed at its end, Spark's windows the other way round.
    moment = F.col("event_time").cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")
    lagged = silver.select(moment.alias("_at"), whole_seconds_between("event_time", "ingest_time").alias("lag_s"))
    panes = lagged.withWatermark("_at", delay).groupBy(F.window("_at", "1 second"), "lag_s").agg(F.count(F.lit(1)).alias("n"))
    minutes = panes.groupBy(F.window(F.window_time("window"), back, slide).alias("minute"), "lag_s")
    return minutes.agg(F.sum("n").alias("readings")).select(
        F.col("minute.end").cast("timestamp_ntz").alias("as_of"), "lag_s", "readings"
    )
