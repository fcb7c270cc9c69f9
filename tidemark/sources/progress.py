"""Which files a streaming query was handed and is done with, as its checkpoint tells."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import storage

_ENTRY = "path STRING, batchId BIGINT"


def _offsets(spark: SparkSession, checkpoint: str, batch: int) -> list[int]:
    """The last entry of each file source's log that ``batch`` and those before it took; -1 for none."""
    if batch < 0:
        return []
    # A line for the version, one for the query, and then one per source.
    lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{batch}").collect()][2:]
    return [int(json.loads(line).get("logOffset", -1)) if line.startswith("{") else -1 for line in lines]


def _entries(spark: SparkSession, checkpoint: str, source: int, above: int, upto: int) -> DataFrame:
    log = spark.read.text(f"{checkpoint}/sources/{source}").where("value LIKE '{%'")
    entry = log.select(F.from_json("value", _ENTRY).alias("e")).select("e.path", "e.batchId")
    taken = entry.where((F.col("batchId") > above) & (F.col("batchId") <= upto))
    return taken.select("path", F.element_at(F.split("path", "/"), -1).alias("name")).distinct()


def handed(spark: SparkSession, checkpoint: str, batch: int, source: int = 0) -> DataFrame:
    """path and name of the files of one micro-batch; it need not be done."""
    before = _offsets(spark, checkpoint, batch - 1) if storage.exists(spark, f"{checkpoint}/offsets/{batch - 1}") else []
    above = before[source] if source < len(before) else -1
    return _entries(spark, checkpoint, source, above, _offsets(spark, checkpoint, batch)[source])


def done(spark: SparkSession, checkpoint: str) -> DataFrame:
    """path and name of all files in micro-batches that are committed."""
    batches = [int(name) for name in storage.names(spark, f"{checkpoint}/commits") if name.isdigit()]
    files = spark.createDataFrame([], "path STRING, name STRING")
    for source, upto in enumerate(_offsets(spark, checkpoint, max(batches, default=-1))):
        if upto >= 0:
            files = files.unionByName(_entries(spark, checkpoint, source, -1, upto))
    return files
