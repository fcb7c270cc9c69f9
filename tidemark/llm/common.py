"""What the operators share: reading tables, scratch tables, text hashing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.scratch import discard, folder, scratch

__all__ = ["bucketed", "discard", "discard_table", "folder", "hex_lower", "partitions", "scratch", "settings", "sha256", "table"]

#: White space of the contracts: space, and tab to carriage return.
WHITE = r"[\x20\x09-\x0D]"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, buckets: int, column: str, purpose: str) -> DataFrame:
    """``scratch`` as a table bucketed by ``column``, so that joins on it move only their other side."""
    spark = df.sparkSession
    path = folder(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(name)
    made = spark.table(name)
    made._scratch_path, made._table_name = path, name
    return made


def discard_table(made: DataFrame) -> None:
    """Remove what ``bucketed`` wrote, and its entry in the catalog."""
    made.sparkSession.sql(f"DROP TABLE IF EXISTS {made._table_name}")
    discard(made)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (dots as ``__``) for the jobs run inside."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sha256(text: Column) -> Column:
    """The 32 bytes of a text's SHA-256, half the size of its hex digits."""
    return F.unhex(F.sha2(text, 256))


def hex_lower(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
