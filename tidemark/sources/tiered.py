"""Two-tier log tables: a hot log that streams append to and a cold, columnar copy.

Layout of a table under its root:

    hot/                       appended by Spark's own file sink, whose log is the commit point
    lake/schema/               an empty file with the table's columns
    lake/data/snapshot_id=K/   what flush K moved, as plain Parquet
    lake/files/id=K/           the names of the hot files it took, a row each
    lake/snapshots/id=K/       one row, written last; snapshot K exists once it is there
    lake/purged/id=K           a folder that says K's hot files are being removed
    consumers/NAME/            a standing reader: its checkpoint, and what was purged when it began
    checkpoints/

The hot log of a landing table holds the messages that could not be decoded
beside the table's rows, so one commit is the commit of both; reads of the
table leave them out, and flushes do not take them.

Cold is the rows of the live snapshots. Hot plus cold is the same rows and the
hot files no live snapshot names, simply concatenated: no key, no merge, no
shuffle. Hot files are never rewritten.
"""

from __future__ import annotations

import datetime as dt
import urllib.parse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import naive
from tidemark.operators.changelog import KIND
from tidemark.schemas import ASIDE, TableSpec, columns
from tidemark.sources import progress, storage

# A rewrite of snapshots up to m gets this id plus m, so it cannot meet a flush id.
REWRITE_IDS = 1_000_000_000_000

_RECORD = columns(
    "snapshot_id BIGINT, operation STRING, committed_at TIMESTAMP, row_count BIGINT, file_count BIGINT, "
    "min_time TIMESTAMP_NTZ, max_time TIMESTAMP_NTZ, replaces ARRAY<BIGINT>"
)
_CONSUMER = columns("checkpoint STRING, opening ARRAY<BIGINT>")


class NoSnapshotYet(RuntimeError):
    """A strict union read of a table that has never been flushed."""


@dataclass(frozen=True)
class Version:
    """One instant of a table: its live snapshots and the hot files not in them."""

    snapshots: tuple[int, ...]
    hot_paths: tuple[str, ...]


class TieredTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self.hot = f"{self.path}/hot"
        self.data = f"{self.path}/lake/data"
        self.names = f"{self.path}/lake/files"
        self.records = f"{self.path}/lake/snapshots"
        self.purged = f"{self.path}/lake/purged"
        self.readers = f"{self.path}/consumers"
        self.checkpoints = f"{self.path}/checkpoints"

    def create(self) -> "TieredTable":
        """Make the table readable, with no rows and an empty cold twin."""
        for path in (self.hot, self.records, self.purged, self.readers):
            storage.make_dir(self.spark, path)
        # The columns of the cold twin, for readers that know nothing of the table but its folder.
        if self.spec.tiered and not storage.exists(self.spark, f"{self.path}/lake/schema/_SUCCESS"):
            none = self.spark.createDataFrame([], self.spec.schema)
            none.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lake/schema")
        return self

    # ---- hot ----

    def append(self, rows: DataFrame, trigger: dict, files: int | None = None) -> StreamingQuery:
        """Append a stream to the hot log, exactly once.

        ``files`` bounds the files a micro-batch writes, for sources with many
        partitions. A changelog is refused: its updates and deletes cannot be
        appended, and as plain rows they would be readings that never were.
        """
        if KIND in rows.columns:
            raise ValueError(f"{self.spec.name} is append-only and cannot take a changelog; see insert_only()")
        if files:
            rows = rows.repartition(files)
        aside = ASIDE.names if self.spec.sets_aside and set(ASIDE.names) <= set(rows.columns) else []
        return (
            rows.select(*self.spec.schema.names, *aside)
            .writeStream.format("parquet")
            .outputMode("append")
            .queryName(f"append-{self.spec.name}-{id(rows)}")
            .option("checkpointLocation", self.append_checkpoint)
            .trigger(**trigger)
            .start(self.hot)
        )

    @property
    def _stored(self) -> T.StructType:
        """The columns of the hot log; files without those of ``ASIDE`` read as rows of the table."""
        return T.StructType([*self.spec.schema, *ASIDE]) if self.spec.sets_aside else self.spec.schema

    def _own(self, stored: DataFrame) -> DataFrame:
        """The table's rows of what the hot log or a snapshot holds."""
        if not self.spec.sets_aside:
            return stored
        return stored.where(F.col("quarantine_reason").isNull()).select(*self.spec.schema.names)

    def set_aside(self) -> DataFrame:
        """value and quarantine_reason of the messages that were set aside, as long as the hot log keeps them."""
        reader = self.spark.read.schema(ASIDE).option("ignoreMissingFiles", "true")
        return reader.parquet(self.hot).where(F.col("quarantine_reason").isNotNull())

    @property
    def append_checkpoint(self) -> str:
        return f"{self.checkpoints}/append"

    def stream(self, consumer: str | None = None, checkpoint: str | None = None) -> DataFrame:
        """The table as an unending stream: what is there first, then rows as they land.

        Rows whose hot files were purged before come from the cold tier. A
        standing reader gives its name and the ``checkpoint`` it will write:
        from then on nothing it has not read is purged, however long it stops,
        and every restart gets the same stream. Without a name the stream is
        for one run, and must not fall behind the log's TTL.
        """
        opening = self._enter(consumer, checkpoint) if consumer else self._only_cold()
        reader = self.spark.readStream.schema(self._stored)
        if opening:
            # The log still lists what was purged before this reader began; cold has those rows.
            # Nothing else can be missing, as purging waits for this reader.
            hot = self._own(reader.option("ignoreMissingFiles", "true").parquet(self.hot))
            parts = f"{self.data}/snapshot_id={{{','.join(map(str, opening))}}}"
            return self.spark.readStream.schema(self.spec.schema).parquet(parts).unionByName(hot)
        if not self.spec.tiered:  # its log ages out under readers
            reader = reader.option("ignoreMissingFiles", "true")
        return self._own(reader.parquet(self.hot))

    def _only_cold(self) -> list[int]:
        """The live snapshots whose rows no hot file has any more."""
        purged = self.purged_ids()
        live = self.live().select("snapshot_id").collect() if purged else []
        return sorted(r.snapshot_id for r in live if r.snapshot_id in purged)

    def _enter(self, consumer: str, checkpoint: str | None) -> list[int]:
        if checkpoint is None:
            raise ValueError(f"the checkpoint of {consumer} tells what it has read")
        path = f"{self.readers}/{consumer}"
        if not storage.exists(self.spark, f"{path}/_SUCCESS"):
            # Entered before the purges are listed: one that starts now already waits for this reader.
            self._write_consumer(path, checkpoint, [])
            self._write_consumer(path, checkpoint, self._only_cold())
        known = self.spark.read.schema(_CONSUMER).parquet(path).first()
        if known.checkpoint != checkpoint:
            raise RuntimeError(f"{self.spec.name} knows {consumer} by another checkpoint, {known.checkpoint}")
        return known.opening

    def _write_consumer(self, path: str, checkpoint: str, opening: list[int]) -> None:
        row = self.spark.createDataFrame([(checkpoint, opening)], _CONSUMER)
        row.coalesce(1).write.mode("overwrite").parquet(path)

    def consumers(self) -> list:
        """checkpoint and opening of every standing reader."""
        found = storage.names(self.spark, self.readers)
        if not found:
            return []
        return self.spark.read.schema(_CONSUMER).parquet(*[f"{self.readers}/{name}" for name in found]).collect()

    def leave(self, consumer: str) -> None:
        """Forget a reader that will not come back, so that purging no longer waits for it."""
        storage.delete(self.spark, f"{self.readers}/{consumer}")

    def hot_files(self) -> list[str]:
        """Paths of the committed hot files; Spark names them as URIs, its readers want plain paths."""
        found = self.spark.read.schema(self.spec.schema).parquet(self.hot).inputFiles()
        return [urllib.parse.unquote(path) for path in found]

    # ---- snapshots ----

    def history(self) -> DataFrame:
        """Every committed snapshot that has not expired."""
        return self.spark.read.schema(_RECORD).parquet(self.records)

    def live(self) -> DataFrame:
        """Committed snapshots no other committed snapshot replaces, from one listing of the records."""
        records = self.history()
        replaced = records.select(F.explode("replaces").alias("snapshot_id"))
        return records.join(replaced, "snapshot_id", "left_anti")

    def purged_ids(self) -> set[int]:
        """Snapshots whose hot files are gone, or going."""
        return {int(name.split("=", 1)[1]) for name in storage.names(self.spark, self.purged)}

    def snapshots(self) -> DataFrame:
        """One row per flush or rewrite: what the table's snapshot history shows."""
        return self.history().select("snapshot_id", "operation", "committed_at", "row_count")

    def taken(self, ids: list[int]) -> DataFrame:
        """snapshot_id and name of the hot files that snapshots ``ids`` hold the rows of."""
        schema = "name STRING, id BIGINT"
        if not ids:
            return self.spark.createDataFrame([], schema).withColumnRenamed("id", "snapshot_id")
        reader = self.spark.read.schema(schema).option("basePath", self.names)
        return reader.parquet(*[f"{self.names}/id={k}" for k in ids]).withColumnRenamed("id", "snapshot_id")

    def pin(self, strict: bool = False, since: dt.datetime | None = None) -> Version:
        """Fix what a read will see.

        The hot files are listed before the snapshots. A flush that lands in
        between takes its files out of the hot part and into the cold one, so
        no row is lost or seen twice. ``since`` leaves out snapshots whose
        newest row is older.
        """
        hot = self.hot_files()
        records = self._live_records(strict)
        return Version(
            tuple(r.snapshot_id for r in records if _reaches(r, since)),
            tuple(self._not_taken(hot, [r.snapshot_id for r in records])),
        )

    def _not_taken(self, paths: list[str], ids: list[int]) -> list[str]:
        """The paths no snapshot names.

        A snapshot names hot files, all of which the hot log lists, so the names are no more than the paths that Spark's
        file index holds here anyway; one small read gets them.
        """
        if not paths or not ids:
            return paths
        named = {r.name for r in self.taken(ids).select("name").collect()}
        return sorted(path for path in paths if file_name(path) not in named)

    def _live_records(self, strict: bool = False, since: dt.datetime | None = None) -> list:
        records = self.live().select("snapshot_id", "max_time").collect()
        if strict and not records:
            raise NoSnapshotYet(f"{self.spec.name}: a batch read needs one lake snapshot")
        return sorted((r for r in records if _reaches(r, since)), key=lambda r: r.snapshot_id)

    # ---- reads ----

    def read(
        self,
        tier: str = "union",
        version: Version | None = None,
        strict: bool = False,
        since: dt.datetime | None = None,
        tagged: bool = False,
    ) -> DataFrame:
        """Read ``tier``: "union" (hot plus cold), "cold", or "hot" (the rows only hot has).

        ``since`` keeps rows whose time column is at or after it and skips the
        cold snapshots that cannot hold any. ``tagged`` adds ``_tier``.
        """
        if tier not in ("union", "cold", "hot"):
            raise ValueError(f"no such tier: {tier}")
        if version is None and tier == "cold":
            version = Version(tuple(r.snapshot_id for r in self._live_records(strict, since)), ())
        version = version or self.pin(strict=strict, since=since)
        parts = {
            "cold": [f"{self.data}/snapshot_id={k}" for k in version.snapshots],
            "hot": list(version.hot_paths),
        }
        wanted = ["cold", "hot"] if tier == "union" else [tier]
        frames = [self._files(parts[name], name if tagged else None) for name in wanted if parts[name]]
        if not frames:
            rows = self._tag(self.spark.createDataFrame([], self.spec.schema), tier if tagged else None)
        else:
            rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        if since is not None:
            rows = rows.where(F.col(self.spec.time_column) >= naive(since))
        return rows

    def _files(self, paths: list[str], tag: str | None) -> DataFrame:
        reader = self.spark.read.schema(self._stored)
        if not self.spec.tiered:  # its log ages out under readers
            return self._tag(self._own(reader.option("ignoreMissingFiles", "true").parquet(self.hot)), tag)
        return self._tag(self._own(reader.parquet(*paths)), tag)

    @staticmethod
    def _tag(rows: DataFrame, tag: str | None) -> DataFrame:
        return rows.withColumn("_tier", F.lit(tag)) if tag else rows

    # ---- flush ----

    def flush(self, trigger: dict, before_commit: Callable[[], None] | None = None) -> StreamingQuery:
        """Move newly arrived hot rows to the cold tier, one snapshot per micro-batch.

        However long tiering was paused, what has landed since is one micro-batch.
        A hot file that is missing fails it: only files a snapshot names may go, and
        what was not read is not to be recorded as moved.
        """
        arrivals = self._own(self.spark.readStream.schema(self._stored).parquet(self.hot))
        started = []

        def one(batch: DataFrame, batch_id: int) -> None:
            # Only the first micro-batch after a start can be a replay.
            if started or not self._already_flushed(batch, batch_id + 1):
                self._flush_batch(batch, batch_id + 1, before_commit)
            started.append(batch_id)

        return (
            arrivals.writeStream.queryName(f"flush-{self.spec.name}-{id(arrivals)}")
            .option("checkpointLocation", self._flush_checkpoint)
            .trigger(**trigger)
            .foreachBatch(one)
            .start()
        )

    @property
    def _flush_checkpoint(self) -> str:
        return f"{self.checkpoints}/flush"

    def _flush_batch(self, batch: DataFrame, snapshot_id: int, before_commit) -> None:
        seen = Observation()
        target = f"{self.data}/snapshot_id={snapshot_id}"
        time = F.col(self.spec.time_column)
        (
            batch.observe(
                seen,
                F.count(F.lit(1)).alias("n"),
                F.min(time).alias("min_time"),
                F.max(time).alias("max_time"),
            )
            .write.mode("overwrite")
            .parquet(target)
        )
        found = seen.get
        files = progress.handed(self.spark, self._flush_checkpoint, snapshot_id - 1)
        self._refuse_missing(files)
        if not found["n"]:
            return
        if before_commit:
            before_commit()
        self.commit(
            snapshot_id, "append", found["n"], found["min_time"], found["max_time"], [], files.select("name")
        )

    def _refuse_missing(self, files: DataFrame) -> None:
        """Spark passes over a file that is gone before it is read; what is there now was there then."""
        there = self.spark.createDataFrame([(n,) for n in storage.names(self.spark, self.hot)], "name STRING")
        missing = files.join(there, "name", "left_anti").select("name").take(3)
        if missing:
            raise RuntimeError(f"{self.spec.name}: hot files are missing: {[r.name for r in missing]}")

    def _already_flushed(self, batch: DataFrame, snapshot_id: int) -> bool:
        """Whether this is a replay of the last flush, committed just before a restart.

        Flushes commit in order and a rewrite carries the number of the newest
        flush in it, so this holds after that flush was compacted and expired too.
        """
        records = {r.snapshot_id: r.row_count for r in self.history().select("snapshot_id", "row_count").collect()}
        newest = max((i % REWRITE_IDS for i in records), default=0)
        if snapshot_id > newest:
            return False
        if snapshot_id < newest or batch.count() != records.get(snapshot_id, batch.count()):
            raise RuntimeError(f"{self.spec.name}: flush {snapshot_id} is another's, is the flush checkpoint lost?")
        return True

    def commit(
        self, snapshot_id, operation, row_count, min_time, max_time, replaces, names: DataFrame
    ) -> None:
        """Check the data that was written and add the one-row record that makes it a snapshot.

        ``names`` has the names of the hot files whose rows it holds.

        The record is one file, so it appears whole or not at all.
        """
        written = self.spark.read.schema(self.spec.schema).parquet(f"{self.data}/snapshot_id={snapshot_id}")
        rows = written.count()
        if rows != row_count:
            raise RuntimeError(f"{self.spec.name} snapshot {snapshot_id} has {rows} of {row_count} rows")
        names.write.mode("overwrite").parquet(f"{self.names}/id={snapshot_id}")
        record = (
            snapshot_id, operation, dt.datetime.now(dt.timezone.utc), row_count, len(written.inputFiles()),
            min_time, max_time, sorted(replaces),
        )
        self.spark.createDataFrame([record], _RECORD).coalesce(1).write.mode("overwrite").parquet(
            f"{self.records}/id={snapshot_id}"
        )


def _reaches(record, since: dt.datetime | None) -> bool:
    return since is None or record.max_time is None or record.max_time >= since


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[1]
