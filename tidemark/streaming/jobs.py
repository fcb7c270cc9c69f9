"""The standing jobs: landing, enrichment, health windows and tiering.

Every job takes a ``trigger``: ``{"processingTime": "10 seconds"}`` for a
standing job, ``{"availableNow": True}`` to catch up and stop.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import decode as wire
from tidemark.operators.enrich import silver
from tidemark.operators.health import health_stream
from tidemark.session import uncounted_state
from tidemark.sources.dimension import DeviceDimension
from tidemark.sources.tiered import TieredTable
from tidemark.streaming.stateful import arrival_windows
from tidemark.streaming.watch import observed

CATCH_UP = {"availableNow": True}

EVENT_TIME_DELAY = "5 seconds"


@dataclass
class Lakehouse:
    """The five tables under one root, and the jobs between them."""

    spark: SparkSession
    root: str
    dimension_slices: int = 8
    files_per_batch: int | None = None
    tables: dict[str, TieredTable] = field(default_factory=dict)

    def __post_init__(self):
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT"):
            raise RuntimeError(f"event times are naive UTC; the session's time zone is {zone}")
        for spec in schemas.LOG_TABLES:
            self.tables[spec.name] = TieredTable(self.spark, self.root, spec).create()
        self.dimension = DeviceDimension(self.spark, self.root, self.dimension_slices)

    @property
    def telemetry(self) -> TieredTable:
        return self.tables[schemas.IOT_TELEMETRY.name]

    @property
    def events(self) -> TieredTable:
        return self.tables[schemas.IOT_EVENTS.name]

    @property
    def silver(self) -> TieredTable:
        return self.tables[schemas.DEVICE_TELEMETRY.name]

    @property
    def gold(self) -> TieredTable:
        return self.tables[schemas.DEVICE_HEALTH.name]

    # ---- jobs ----

    def start_landing(
        self, telemetry: DataFrame, events: DataFrame, trigger: dict, quarantine: bool = True
    ) -> list[StreamingQuery]:
        """Both message streams into bronze unchanged, and what cannot be decoded aside.

        One query per topic reads and parses each message once. Rows and what is set aside go to the same hot log in the
        same commit, so there is no moment, and no crash, after which only one of them is there.
        """
        started = []
        for messages, table in ((telemetry, self.telemetry), (events, self.events)):
            decoded = wire.decode(messages, table.spec.schema)
            rows = wire.with_set_aside(decoded) if quarantine else wire.accepted(decoded, table.spec.schema)
            started.append(self._append(table, rows, trigger))
        return started

    def _append(self, table: TieredTable, rows: DataFrame, trigger: dict) -> StreamingQuery:
        return table.append(rows, trigger, self.files_per_batch)

    def quarantined(self, table: TieredTable) -> DataFrame:
        return table.set_aside().withColumnRenamed("quarantine_reason", "reason")

    def start_enrichment(
        self, trigger: dict, arrival: Column | None = None, broadcast: bool = False
    ) -> StreamingQuery:
        """Bronze readings into silver, each with the threshold in force as its micro-batch runs.

        A micro-batch shuffles by device, so the dimension may grow to any size
        while the job runs. ``broadcast=True`` is for a dimension known to stay
        small; every read checks that it did, and the job stops if not.
        """
        readings = self.telemetry.stream("enrichment", self.silver.append_checkpoint)
        rows = silver(readings, self.dimension.live(broadcast), arrival, broadcast)
        return self._append(self.silver, observed(rows), trigger)

    def start_health(
        self, trigger: dict, over: str = "arrival", ticks: DataFrame | None = None, size: str = "1 minute"
    ) -> StreamingQuery:
        """Silver into health windows.

        ``over="arrival"``: a reading counts in the minute this job met it. Timers
        close the windows of a standing job, so they close while no reading
        arrives and no reading can come late.
        ``"ingest_time"``: the minute silver stamped it, the same in any replay;
        windows close on later readings, or on ``ticks``, a stream of
        ``ingest_time`` that must never run ahead of the silver job.
        ``"event_time"``: the reading's own time, five seconds late at most.
        """
        readings = self.silver.stream("health", self.gold.append_checkpoint)
        if over == "arrival":
            windows = arrival_windows(readings, size)
        elif over == "ingest_time":
            if ticks is not None:
                ticks = ticks.select("ingest_time", F.lit(True).alias("is_tick"))
                readings = readings.unionByName(ticks, allowMissingColumns=True)
            windows = health_stream(readings, "ingest_time", size=size)
        elif over == "event_time":
            windows = health_stream(readings, "event_time", EVENT_TIME_DELAY, size)
        else:
            raise ValueError(f"no such time: {over}")
        with uncounted_state(self.spark):
            return self._append(self.gold, windows, trigger)

    def start_tiering(self, trigger: dict | None = None) -> list[StreamingQuery]:
        """One flush job per tiered table, by default at each table's own freshness."""
        return [
            table.flush(trigger or {"processingTime": table.spec.freshness})
            for table in self.tables.values()
            if table.spec.tiered
        ]

    # ---- SQL names ----

    def register_views(self) -> None:
        """Temp views for SQL: ``t``, ``t$lake`` (and ``t__lake``), ``t$lake$snapshots``.

        Each table is pinned once, so all of its views show one instant; call
        again to move on. Names with ``$`` are written in backquotes.
        """
        for name, table in self.tables.items():
            version = table.pin()
            cold = table.read("cold", version)
            table.read("union", version).createOrReplaceTempView(name)
            for suffix, frame in (("lake", cold), ("lake$snapshots", table.snapshots())):
                frame.createOrReplaceTempView(f"`{name}${suffix}`")
                frame.createOrReplaceTempView(f"{name}__{suffix.replace('$', '__')}")
        self.dimension.current().createOrReplaceTempView(schemas.DIM_DEVICE)


def finish(queries: list[StreamingQuery]) -> None:
    """Wait for catch-up queries that were started side by side."""
    for query in queries:
        query.awaitTermination()
