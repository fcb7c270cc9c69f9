"""A lakehouse fed from the test tables by the standing jobs, at a known point of its life."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.times import naive
from tidemark.plans import bindings
from tidemark.sources import messages, storage
from tidemark.sources.scratch import folder as shared_dir
from tidemark.sources.tiered import TieredTable
from tidemark.streaming.jobs import CATCH_UP, Lakehouse, finish

_built: dict[tuple[str, str], Lakehouse] = {}
_building = threading.Lock()


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Both drops landed, enriched and windowed; only the first one flushed. Built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _building:
        if key not in _built:
            _built[key] = _build(spark, sf_dir)
        return _built[key]


def _build(spark: SparkSession, sf_dir: str) -> Lakehouse:
    root = shared_dir(spark, "lakehouse")
    house = Lakehouse(spark, root)
    ticks = f"{root}/ticks"
    storage.make_dir(spark, ticks)
    first, second = F.col("event_time") < naive(bindings.CUT), F.col("event_time") >= naive(bindings.CUT)

    def drop(number, part):
        for topic, rows in (("telemetry", bindings.telemetry), ("events", bindings.iot_events)):
            lines = bindings.as_messages(rows(spark, sf_dir).where(part))
            lines.write.text(f"{root}/inbox/{topic}/{number}")

    def land():
        return house.start_landing(
            messages.from_folder(spark, f"{root}/inbox/telemetry/*"),
            messages.from_folder(spark, f"{root}/inbox/events/*"),
            CATCH_UP,
            quarantine=False,
        )

    def enrich():
        return house.start_enrichment(CATCH_UP, bindings.arrival())

    def windows():
        clock = spark.readStream.schema("ingest_time TIMESTAMP_NTZ").parquet(ticks)
        return house.start_health(CATCH_UP, "ingest_time", clock)

    # Each step runs side by side what does not depend on the others in it.
    drop(1, first)
    running = land()
    house.dimension.seed()
    finish(running)
    running = [enrich(), house.telemetry.flush(CATCH_UP), house.events.flush(CATCH_UP)]
    drop(2, second)
    finish(running)
    finish([windows(), house.silver.flush(CATCH_UP), *land()])
    finish([house.gold.flush(CATCH_UP), enrich()])
    # A late tick closes every window, as an hour without readings would.
    last = house.silver.read().agg((F.max("ingest_time") + F.expr("INTERVAL 1 HOUR")).alias("ingest_time"))
    last.coalesce(1).write.mode("append").parquet(ticks)
    finish([windows()])
    return house


def staged_table(spark: SparkSession, sf_dir: str, cuts: list[dt.datetime]) -> "StagedTable":
    return StagedTable(spark, sf_dir, cuts)


class StagedTable:
    """A telemetry table whose readings land drop by drop, split at ``cuts``."""

    def __init__(self, spark: SparkSession, sf_dir: str, cuts: list[dt.datetime]):
        self.spark = spark
        self.root = shared_dir(spark, "staged")
        self.table = TieredTable(spark, self.root, schemas.IOT_TELEMETRY).create()
        self.readings = bindings.telemetry(spark, sf_dir)
        self.bounds = [None, *cuts, None]
        self.landed = 0

    def land(self) -> "StagedTable":
        low, high = self.bounds[self.landed : self.landed + 2]
        rows: DataFrame = self.readings
        if low is not None:
            rows = rows.where(F.col("event_time") >= naive(low))
        if high is not None:
            rows = rows.where(F.col("event_time") < naive(high))
        self.landed += 1
        rows.write.parquet(f"{self.root}/inbox/{self.landed}")
        arriving = self.spark.readStream.schema(self.table.spec.schema).parquet(f"{self.root}/inbox/*")
        finish([self.table.append(arriving, CATCH_UP)])
        return self

    def flush(self) -> "StagedTable":
        finish([self.table.flush(CATCH_UP)])
        return self
