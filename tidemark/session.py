"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job needs, whoever built the session.
RUNTIME_CONF = {
    # event_time is naive UTC and is compared with the clock, so the zone is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window state outgrows the heap with many devices; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` overrides use dots as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # Spark's cluster default; one JVM wants about one partition per thread.
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


@contextlib.contextmanager
def uncounted_state(spark: SparkSession):
    """Streams started in here do not count the rows of their state; a stream keeps the settings it was started with.

    The count costs a look-up for each row that is put into state and one more for each that leaves it. Where a
    backlog passes through state once, that is half of the work, and the part that grows faster than the state.
    """
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``.

    Every executor must be able to read what any other wrote, so without that
    setting only a local session gets a fallback, and it is removed at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
