"""Upkeep of a two-tier table: rewrite small files, expire snapshots, age out the hot log."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.sources import progress, storage
from tidemark.sources.tiered import REWRITE_IDS, TieredTable, file_name


def compact(table: TieredTable, rows_per_file: int = 5_000_000) -> list[int]:
    """Rewrite small snapshots into one with few, time-ordered files; returns the new ids.

    A snapshot with full files is left alone, so a row is rewritten when it is
    new and not again with every later compaction. Snapshots whose hot files
    are gone stay apart from the others, so that a stream can still tell which
    rows only the cold tier has. Names of hot files that turned out to hold no
    rows are recorded too, which takes them out of every later union read. One
    compaction at a time; flushes may go on.
    """
    records = table.live().collect()
    existing = {r.snapshot_id for r in table.history().select("snapshot_id").collect()}
    gone = table.purged_ids()
    empty = _empty_hot_files(table)
    made = []
    for purged in (True, False):
        group = [r for r in records if (r.snapshot_id in gone) == purged and _is_small(r, rows_per_file)]
        names = table.taken([r.snapshot_id for r in group]).select("name")
        if not purged and empty:
            names = names.unionByName(table.spark.createDataFrame([(name,) for name in empty], "name STRING"))
        if len(group) > 1 or (group and not purged and empty):
            made.append(_rewrite(table, group, rows_per_file, names, existing, purged))
    return made


def _is_small(record, rows_per_file: int) -> bool:
    return record.row_count < rows_per_file or record.row_count < record.file_count * rows_per_file // 2


def _rewrite(table, group, rows_per_file, names, existing, purged) -> int:
    ids = [r.snapshot_id for r in group]
    new_id = REWRITE_IDS + max(i % REWRITE_IDS for i in ids)
    while new_id in existing:
        new_id += REWRITE_IDS
    rows = sum(r.row_count for r in group)
    source = table.spark.read.schema(table.spec.schema).parquet(
        *[f"{table.data}/snapshot_id={i}" for i in ids]
    )
    time_column = table.spec.time_column
    target = f"{table.data}/snapshot_id={new_id}"
    # Time order across files and within them, so a time filter skips files and row groups;
    # the row's place in its file splits rows that share one time.
    (
        source.withColumn("_row", F.col("_metadata.row_index"))
        .repartitionByRange(max(1, -(-rows // rows_per_file)), time_column, "_row")
        .sortWithinPartitions(time_column)
        .drop("_row")
        .write.mode("overwrite")
        .parquet(target)
    )
    if purged:
        storage.make_dir(table.spark, f"{table.purged}/id={new_id}/done")
    # What the group had itself replaced stays replaced until its records are gone.
    replaces = set(ids) | {i for r in group for i in r.replaces if i in existing}
    starts = [r.min_time for r in group if r.min_time is not None]
    ends = [r.max_time for r in group if r.max_time is not None]
    table.commit(
        new_id, "replace", rows, min(starts, default=None), max(ends, default=None), replaces, names
    )
    return new_id


def _empty_hot_files(table: TieredTable) -> set[str]:
    paths = table.pin().hot_paths
    if not paths:
        return set()
    with_rows = (
        table.spark.read.schema(table.spec.schema)
        .parquet(*paths)
        .select(F.col("_metadata.file_name").alias("name"))
        .distinct()
        .collect()
    )
    return {file_name(path) for path in paths} - {r.name for r in with_rows}


def expire(table: TieredTable, older_than_s: float = 3600.0) -> list[int]:
    """Delete snapshots that were replaced more than ``older_than_s`` ago.

    The age protects readers that pinned a version before the rewrite; a
    snapshot that a standing reader began with stays until it has read it. Data
    goes before its record, so a crash leaves a replaced snapshot behind, never
    a live one without data. When a flush was committed is kept.
    """
    cutoff = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=older_than_s)
    records = table.history()
    replaced = records.where(F.col("committed_at") <= F.lit(cutoff)).select(
        F.explode("replaces").alias("snapshot_id")
    )
    due = records.join(replaced, "snapshot_id", "left_semi").select("snapshot_id").collect()
    awaited = {i for reader in table.consumers() for i in reader.opening if not _has_read(table, reader, i)}
    ids = sorted({r.snapshot_id for r in due} - awaited)
    if ids:
        flushes = records.where(F.col("snapshot_id").isin(ids) & (F.col("operation") == "append"))
        flushes.select("snapshot_id", "committed_at", "row_count").coalesce(1).write.mode("append").parquet(
            f"{table.path}/lake/expired"
        )
    for i in ids:
        storage.delete(table.spark, f"{table.data}/snapshot_id={i}")
        storage.delete(table.spark, f"{table.records}/id={i}")
        storage.delete(table.spark, f"{table.names}/id={i}")
        storage.delete(table.spark, f"{table.purged}/id={i}")
    return ids


def _has_read(table: TieredTable, reader, snapshot_id: int) -> bool:
    """Whether a reader that began with this purged snapshot is through with its files."""
    if not storage.exists(table.spark, f"{table.data}/snapshot_id={snapshot_id}"):
        return True
    files = table.spark.read.schema(table.spec.schema).parquet(f"{table.data}/snapshot_id={snapshot_id}").inputFiles()
    names = table.spark.createDataFrame([(file_name(f),) for f in files], "name STRING")
    return names.join(progress.done(table.spark, reader.checkpoint), "name", "left_anti").isEmpty()


def purge(table: TieredTable, older_than_s: float | None = None) -> int:
    """Remove hot files past the log's TTL; returns how many went.

    On a tiered table only files a live snapshot names are removed, a whole
    snapshot at a time, once it is older than the TTL and every standing reader
    of the table is through with its files; the snapshot is marked before the
    first file goes. An untiered table loses what has aged out.
    """
    if older_than_s is None:
        older_than_s = table.spec.log_ttl_days * 86_400.0
    if not table.spec.tiered:
        cutoff = (time.time() - older_than_s) * 1000
        return sum(_remove_aged(table, path, cutoff) for path in table.hot_files())
    cutoff = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=older_than_s)
    gone = {i for i in table.purged_ids() if storage.exists(table.spark, f"{table.purged}/id={i}/done")}
    old = table.live().where(F.col("committed_at") <= F.lit(cutoff)).select("snapshot_id").collect()
    ids = [r.snapshot_id for r in old if r.snapshot_id not in gone]
    taken = table.taken(ids)
    for reader in table.consumers():
        unread = taken.join(progress.done(table.spark, reader.checkpoint), "name", "left_anti")
        waiting = {r.snapshot_id for r in unread.select("snapshot_id").distinct().collect()}
        ids = [i for i in ids if i not in waiting]
    removed = 0
    for i in sorted(ids):
        mark = f"{table.purged}/id={i}"
        storage.make_dir(table.spark, mark)
        for r in taken.where(F.col("snapshot_id") == i).select("name").toLocalIterator():
            removed += storage.delete(table.spark, f"{table.hot}/{r.name}")
        storage.make_dir(table.spark, f"{mark}/done")
    return removed


def _age(table, path) -> float:
    """When a hot file was written, in epoch milliseconds; a file already gone is as old as can be."""
    written = storage.modified_millis(table.spark, path)
    return float("-inf") if written is None else written


def _remove_aged(table, path, cutoff) -> bool:
    return float("-inf") < _age(table, path) <= cutoff and storage.delete(table.spark, path)


def lake_lag(table: TieredTable) -> DataFrame:
    """How far the cold tier trails the table: in rows, and in seconds of the time column."""
    when = F.col(table.spec.time_column)
    cold_when = F.when(F.col("_tier") == "cold", when)
    return table.read(tagged=True).agg(
        F.lit(table.spec.name).alias("table_name"),
        F.count_if(F.col("_tier") == "hot").alias("rows_behind"),
        F.timestamp_diff("SECOND", F.max(cold_when), F.max(when)).alias("seconds_behind"),
    )


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def seconds_of(interval: str) -> float:
    """"30 seconds", "1 minute 30 seconds" and the like, in seconds."""
    words = interval.split()
    if not words or len(words) % 2:
        raise ValueError(f"not an interval: {interval!r}")
    return sum(float(n) * _SECONDS[unit.lower().removesuffix("s")] for n, unit in zip(words[::2], words[1::2]))


def flush_intervals(table: TieredTable, freshness: str | None = None) -> DataFrame:
    """Seconds since the previous commit, per flush, and whether it missed the freshness target, by default the table's.

    Flushes whose snapshots were rewritten and have expired are in it.
    """
    flushes = table.history().where("operation = 'append'").select("snapshot_id", "committed_at", "row_count")
    if storage.exists(table.spark, f"{table.path}/lake/expired"):
        expired = table.spark.read.schema(flushes.schema).parquet(f"{table.path}/lake/expired")
        flushes = flushes.unionByName(expired).dropDuplicates(["snapshot_id"])
    # One row per flush of one table, a few thousand a day at the default freshness.
    in_order = Window.partitionBy(F.lit(table.spec.name)).orderBy("committed_at", "snapshot_id")
    interval = F.col("committed_at").cast("double") - F.lag(F.col("committed_at").cast("double")).over(in_order)
    target = seconds_of(freshness or table.spec.freshness)
    return flushes.withColumn("interval_s", interval).select(
        "snapshot_id", "committed_at", "row_count", "interval_s", F.lit(target).alias("target_s"),
        (F.col("interval_s") > target).alias("missed_target"),
    )


def flush_lag(table: TieredTable) -> DataFrame:
    """Freshness against target, one row: flushes, intervals between them, and how many missed it."""
    return flush_intervals(table).agg(
        F.lit(table.spec.name).alias("table_name"),
        F.lit(seconds_of(table.spec.freshness)).alias("target_s"),
        F.count(F.lit(1)).alias("flushes"),
        F.count("interval_s").alias("intervals"),
        F.count_if("missed_target").alias("missed"),
        F.max("interval_s").alias("longest_s"),
    )
