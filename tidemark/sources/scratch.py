"""Intermediate tables in the folder all executors share, removed when the process ends."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir
from tidemark.sources import storage

_made: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, forgotten with the process."""
    if not _made:
        atexit.register(drop_scratch)
    path = shared_dir(spark, purpose)
    _made.append((spark, path))
    return path


def scratch(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once, and read from there: it cuts lineage, and Spark then knows the table's true size."""
    path = folder(df.sparkSession, purpose)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    return made


def discard(made: DataFrame) -> None:
    """Remove what ``scratch`` wrote, once nothing will read it any more."""
    storage.delete(made.sparkSession, made._scratch_path)


def drop_scratch() -> None:
    """Remove every folder made so far. Frames that read them stop working."""
    while _made:
        spark, path = _made.pop()
        if spark.sparkContext._jsc is not None:
            storage.delete(spark, path)
