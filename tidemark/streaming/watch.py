"""Health of a landing while it runs: figures of each micro-batch, taken as its rows pass and written as rows."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources import storage

NAME = "landing_health"
_FIGURES = "readings BIGINT, null_event_time BIGINT, null_threshold BIGINT"


def observed(silver: DataFrame) -> DataFrame:
    """``silver`` as it is; whatever writes it counts readings, lost times and missing thresholds on the way."""
    return silver.observe(
        NAME,
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("event_time").isNull()).alias("null_event_time"),
        F.count_if(F.col("temp_threshold").isNull()).alias("null_threshold"),
    )


class LandingHealth(StreamingQueryListener):
    """Writes the figures of every observed micro-batch to ``path``, a row each; a repeated one replaces its row.

    ``spark.streams.addListener(LandingHealth(spark, path))``. No table is scanned: Spark sums the figures up in the
    tasks that write the rows and hands them over with the query's progress.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        storage.make_dir(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = progress.observedMetrics.get(NAME)
        if figures is None or not figures["readings"]:
            return
        row = [(progress.name, figures["readings"], figures["null_event_time"], figures["null_threshold"])]
        made = self.spark.createDataFrame(row, f"query STRING, {_FIGURES}").withColumn("seen_at", F.current_timestamp())
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={progress.id}/batch_id={progress.batchId}")

    def rows(self) -> DataFrame:
        """query, batch_id, the figures, and the symptoms of a broken landing that each micro-batch shows."""
        found = self.spark.read.schema(
            f"query STRING, {_FIGURES}, seen_at TIMESTAMP, run STRING, batch_id BIGINT"
        ).parquet(self.path)
        return found.select(
            "query", "batch_id", "seen_at", "readings", "null_event_time", "null_threshold",
            (F.col("null_event_time") == F.col("readings")).alias("timestamps_lost"),
            (F.col("null_threshold") == F.col("readings")).alias("dimension_missing"),
        )

    def wait(self, micro_batches: int, seconds: float = 120) -> "LandingHealth":
        """Progress is reported after a micro-batch is done; wait until so many have been."""
        until = time.time() + seconds
        while self.rows().count() < micro_batches:
            if time.time() > until:
                raise TimeoutError(f"{micro_batches} micro-batches were not reported within {seconds} s")
            time.sleep(0.2)
        return self
