"""The device dimension: one row per device, replaced version by version."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.sizing import BROADCAST_ROWS
from tidemark.operators.changelog import changelog
from tidemark.operators.lookup import latest_per_device
from tidemark.schemas import DEVICE, DEVICE_SEED, DIM_DEVICE
from tidemark.sources import lookup_source, storage

_COMMIT = "row_count BIGINT, committed_at TIMESTAMP"


def seed_rows(spark: SparkSession) -> DataFrame:
    """The eleven seeded devices as literal rows."""
    values = ", ".join(
        f"('{device}', {threshold}D, '{location}', '{model}', '{status}')"
        for device, threshold, location, model, status in DEVICE_SEED
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed({', '.join(DEVICE.names)})")


class DeviceDimension:
    """Upserts write a whole new version; its commit row makes it current.

    ``versions/version=K`` holds the devices hashed into ``slices`` files,
    ``commits/version=K`` one row once they are all there, and ``changes`` every
    change with the time it took effect, for lookups as of an earlier time.
    """

    def __init__(self, spark: SparkSession, root: str, slices: int = 8):
        self.spark = spark
        self.path = f"{root}/{DIM_DEVICE}"
        self.slices = slices
        storage.make_dir(spark, f"{self.path}/commits")
        storage.make_dir(spark, f"{self.path}/claims")

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT + ", version BIGINT").parquet(f"{self.path}/commits")

    def version(self) -> int | None:
        return self._commits().agg(F.max("version")).first()[0]

    def current(self) -> DataFrame:
        """The newest version as a plain batch frame."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], DEVICE)
        return self.spark.read.schema(DEVICE).parquet(f"{self.path}/versions/version={version}")

    def seed(self) -> int:
        return self.upsert(seed_rows(self.spark))

    def upsert(self, changes: DataFrame, order: list[str] | None = None) -> int:
        """Merge changed rows, the last one per device by ``order`` winning; returns the version.

        ``changes`` may carry ``valid_from``, the time each change took effect;
        without it they take effect now. Without ``order`` a device's changes
        are ranked by ``valid_from``. Of two upserts at a time, the one that
        finishes last raises and is to be repeated.
        """
        if "valid_from" not in changes.columns:
            changes = changes.withColumn("valid_from", F.localtimestamp())
        order = order or ["valid_from"]
        old = self.version() or 0
        rows = changes.withColumn("_new", F.lit(1))
        if old:
            # What is there now ranks below any change; one aggregation merges both.
            rows = rows.unionByName(self.current().withColumn("_new", F.lit(0)), allowMissingColumns=True)
        merged = latest_per_device(rows, ["_new", *order]).select(*DEVICE.names)
        new = old + 1
        while not storage.claim(self.spark, f"{self.path}/claims/{new}"):
            new += 1  # taken by another upsert, running or broken off
        if (self.version() or 0) >= new:  # that claim was free because its version is committed and vacuumed
            raise RuntimeError("another upsert was committed meanwhile; repeat this one")
        target = f"{self.path}/versions/version={new}"
        merged.repartition(self.slices, "device_id").write.mode("overwrite").parquet(target)
        log = changes.select(*DEVICE.names, "valid_from")
        log.write.mode("overwrite").parquet(f"{self.path}/changes/version={new}")
        rows = self.spark.read.schema(DEVICE).parquet(target).agg(F.count(F.lit(1)).alias("row_count"))
        if (self.version() or 0) != old:
            raise RuntimeError(f"another upsert was committed meanwhile; repeat this one, it was not version {new}")
        rows.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/commits/version={new}"
        )
        self.vacuum()
        return new

    def _ever_committed(self) -> DataFrame:
        """version of every upsert that was committed, those vacuumed since included."""
        return self._retired().union(self._commits().select("version")).distinct()

    def _retired(self) -> DataFrame:
        """version of every committed upsert whose commit has been vacuumed: one file, written anew by each vacuum."""
        lists = self._lists_of_retired()
        if not lists:
            return self.spark.createDataFrame([], "version BIGINT")
        return self.spark.read.schema("version BIGINT").parquet(f"{self.path}/retired/upto={lists[-1]}")

    def _lists_of_retired(self) -> list[int]:
        found = [n for n in storage.names(self.spark, f"{self.path}/retired") if n.startswith("upto=")]
        return sorted(int(n.split("=")[1]) for n in found if storage.exists(self.spark, f"{self.path}/retired/{n}/_SUCCESS"))

    def history(self) -> DataFrame:
        """Every committed change: the device row and ``valid_from``."""
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DEVICE)
        log = self.spark.read.schema(f"{schema}, valid_from TIMESTAMP_NTZ, version BIGINT").parquet(
            f"{self.path}/changes"
        )
        # Versions that were never committed are numbered below later ones that were.
        return log.join(self._ever_committed(), "version", "left_semi").drop("version")

    def changelog(self, since: int | None = None) -> DataFrame:
        """version, row_kind and the device row: what each kept version after ``since`` changed.

        Without ``since``, or once that version is vacuumed, the oldest kept version counts as all inserts.
        """
        versions = sorted(r.version for r in self._commits().select("version").collect())
        versions = [v for v in versions if since is None or v >= since]
        rows = self.spark.createDataFrame([], DEVICE).withColumn("version", F.lit(0).cast("bigint"))
        if versions:
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DEVICE) + ", version BIGINT"
            reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/versions")
            rows = reader.parquet(*[f"{self.path}/versions/version={v}" for v in versions])
        found = changelog(rows, versions)
        return found if since not in versions else found.where(F.col("version") > since)

    def vacuum(self, keep: int = 10) -> list[int]:
        """Delete all but the newest ``keep`` versions (at least two); the change log stays whole.

        What was deleted is written down first. Claims up to the newest version go as well: none of them can
        be committed any more.
        """
        versions = sorted(r.version for r in self._commits().select("version").collect())
        old = versions[: -max(keep, 2)]
        before = self._lists_of_retired()
        if old and old[-1] not in before:
            gone = self._ever_committed().where(F.col("version") <= old[-1])
            gone.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/retired/upto={old[-1]}")
            for upto in before:
                storage.delete(self.spark, f"{self.path}/retired/upto={upto}")
        for claim in storage.names(self.spark, f"{self.path}/claims"):
            if claim.isdigit() and int(claim) <= max(versions, default=0):
                storage.delete(self.spark, f"{self.path}/claims/{claim}")
        for version in old:
            storage.delete(self.spark, f"{self.path}/commits/version={version}")
            storage.delete(self.spark, f"{self.path}/versions/version={version}")
        return old

    def live(self, broadcast: bool = True) -> DataFrame:
        """The dimension for a stream-static join, read again by every micro-batch.

        Served for a broadcast, the read fails rather than exceed the row bound.
        """
        cloudpickle.register_pickle_by_value(lookup_source)
        self.spark.dataSource.register(lookup_source.DimensionSource)
        reader = (
            self.spark.read.format(lookup_source.FORMAT)
            .option("path", self.path)
            .option("slices", str(self.slices))
        )
        if broadcast:
            reader = reader.option("max_rows", str(BROADCAST_ROWS))
        return reader.load()
