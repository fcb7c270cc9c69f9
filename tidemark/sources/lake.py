"""The cold tier as any other engine sees it: committed Parquet under a root, and nothing hot.

Needs no table definitions: names, columns and types come from what is stored.
Every read lists the commit records anew, so there is no metadata to refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import storage


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def tables(self) -> list[str]:
        """Tables that have a cold tier, be it empty."""
        found = storage.names(self.spark, self.root)
        return sorted(name for name in found if storage.exists(self.spark, f"{self.root}/{name}/lake/snapshots"))

    def read(self, name: str) -> DataFrame:
        """The rows of the live snapshots of ``name``; none before its first flush."""
        lake = f"{self.root}/{name}/lake"
        if not storage.exists(self.spark, f"{lake}/snapshots"):
            raise LookupError(f"no tiered table {name} under {self.root}")
        if not storage.names(self.spark, f"{lake}/snapshots"):
            return self.spark.read.parquet(f"{lake}/schema")
        records = self.spark.read.parquet(f"{lake}/snapshots").select("snapshot_id", "replaces")
        replaced = records.select(F.explode("replaces").alias("snapshot_id"))
        live = records.join(replaced, "snapshot_id", "left_anti").select("snapshot_id").collect()
        return self.spark.read.parquet(*[f"{lake}/data/snapshot_id={r.snapshot_id}" for r in live])

    def register(self) -> list[str]:
        """Temp views of every table, under their own names."""
        for name in self.tables():
            self.read(name).createOrReplaceTempView(name)
        return self.tables()
