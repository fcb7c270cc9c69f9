"""The freshness monitor: the gap between the tiers, sampled round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.analytics import freshness_gap
from tidemark.sources import storage
from tidemark.sources.tiered import TieredTable

_SAMPLE = "round INT, as_of TIMESTAMP, hot_plus_cold BIGINT, cold_only BIGINT, rows_only_in_hot BIGINT"


class FreshnessMonitor:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        storage.make_dir(spark, path)
        self._round = self.samples().agg(F.max("round")).first()[0] or 0

    def sample(self, table: TieredTable) -> None:
        """Append one row from one pinned version of ``table``."""
        self._round += 1
        (
            freshness_gap(table.read(tagged=True))
            .withColumn("round", F.lit(self._round))
            .withColumn("as_of", F.current_timestamp())
            .write.mode("append")
            .parquet(self.path)
        )

    def samples(self) -> DataFrame:
        return self.spark.read.schema(_SAMPLE).parquet(self.path)
