"""Where raw messages come from: a topic, or a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def from_folder(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Stream a folder of JSON-lines files from its beginning, one message per line."""
    reader = spark.readStream.schema("value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path)


def from_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream a Kafka topic from its beginning; needs the Kafka connector on the classpath.

    The checkpoint of the query that reads it is its identity: a restart goes
    on from there, and ``earliest`` only matters the first time.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if group:
        reader = reader.option("groupIdPrefix", group)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"))
