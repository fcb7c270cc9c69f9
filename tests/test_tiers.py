from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from tests.helpers import at, drop_rows, readings
from tidemark import schemas
from tidemark.operators import maintenance
from tidemark.plans import analytics
from tidemark.sources.tiered import REWRITE_IDS, NoSnapshotYet, TieredTable
from tidemark.streaming.jobs import CATCH_UP, finish


class Feed:
    """A telemetry table and a folder of drops that land in it."""

    def __init__(self, spark, root):
        self.spark, self.root, self.drops, self.next_id = spark, root, 0, 0
        self.table = TieredTable(spark, root, schemas.IOT_TELEMETRY).create()

    def land(self, n, when=None):
        self.drops += 1
        rows = [
            {"reading_id": self.next_id + i, "event_time": when or at(self.drops, i % 60)}
            for i in range(n)
        ]
        self.next_id += n
        drop_rows(readings(self.spark, rows) if rows else self.empty(), f"{self.root}/in/{self.drops}")
        stream = self.spark.readStream.schema(schemas.TELEMETRY).parquet(f"{self.root}/in/*")
        finish([self.table.append(stream, CATCH_UP)])
        return self

    def empty(self):
        return self.spark.createDataFrame([], schemas.TELEMETRY)

    def flush(self, **kw):
        finish([self.table.flush(CATCH_UP, **kw)])
        return self

    def gap(self):
        """(union, cold, hot) counts of one version, checked for lost and doubled rows."""
        version = self.table.pin()
        rows = self.table.read(version=version, tagged=True).select("reading_id", "_tier").collect()
        assert sorted(r.reading_id for r in rows) == list(range(self.next_id))
        cold = {r.reading_id for r in rows if r._tier == "cold"}
        assert {r.reading_id for r in self.table.read("cold", version).select("reading_id").collect()} == cold
        return len(rows), len(cold), len(rows) - len(cold)


@pytest.fixture
def feed(spark, root):
    return Feed(spark, root)


def test_before_the_first_flush(feed):
    assert feed.table.read().count() == feed.table.read("cold").count() == 0
    feed.land(5)
    assert feed.gap() == (5, 0, 5)
    assert feed.table.snapshots().count() == 0
    with pytest.raises(NoSnapshotYet):
        feed.table.read(strict=True)
    feed.flush()
    assert feed.table.read(strict=True).count() == 5


def test_cold_is_flat_between_flushes_and_catches_up_in_one_jump(feed):
    assert feed.land(10).flush().gap() == (10, 10, 0)
    assert tuple(analytics.freshness_gap(feed.table.read(tagged=True)).first()) == (10, 10, 0)
    assert feed.land(15).gap() == (25, 10, 15)
    assert feed.land(5).gap() == (30, 10, 20)
    assert feed.flush().gap() == (30, 30, 0)
    history = feed.table.snapshots().orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.operation, r.row_count) for r in history] == [(1, "append", 10), (2, "append", 20)]
    feed.flush()  # nothing new: no snapshot
    assert feed.table.snapshots().count() == 2


def test_crash_between_data_and_record_loses_and_doubles_nothing(feed):
    feed.land(10).flush().land(15)

    def crash():
        raise RuntimeError("lost the executor")

    with pytest.raises(StreamingQueryException):
        feed.flush(before_commit=crash)
    assert feed.gap() == (25, 10, 15)
    feed.land(4)
    assert feed.gap() == (29, 10, 19)
    feed.flush()
    assert feed.gap() == (29, 29, 0)


def test_replay_of_a_committed_flush_is_recognised(feed):
    feed.land(10).flush().land(10).flush()
    rows = feed.table.read("cold")
    assert feed.table._already_flushed(rows.limit(10), 2)
    assert not feed.table._already_flushed(rows.limit(10), 3)
    for wrong in ((rows.limit(3), 2), (rows.limit(10), 1)):
        with pytest.raises(RuntimeError, match="checkpoint lost"):
            feed.table._already_flushed(*wrong)
    # still so once the flush has been rewritten and has expired
    maintenance.compact(feed.table)
    maintenance.expire(feed.table, older_than_s=0)
    assert feed.table._already_flushed(rows.limit(0), 2)


def test_crash_after_the_record_and_before_the_checkpoint(feed, monkeypatch):
    feed.land(10)
    real = feed.table._flush_batch

    def crash_late(*args):
        real(*args)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(feed.table, "_flush_batch", crash_late)
    with pytest.raises(StreamingQueryException):
        feed.flush()
    monkeypatch.setattr(feed.table, "_flush_batch", real)
    assert feed.gap() == (10, 10, 0)
    feed.land(5)
    assert feed.flush().gap() == (15, 15, 0)
    rows = feed.table.snapshots().orderBy("snapshot_id").collect()
    assert [r.row_count for r in rows] == [10, 5]


def test_a_flush_in_the_middle_of_a_pin(feed, monkeypatch):
    feed.land(10).flush().land(5)
    real = feed.table.hot_files

    def then_flush():
        found = real()
        feed.flush()
        return found

    monkeypatch.setattr(feed.table, "hot_files", then_flush)
    version = feed.table.pin()
    monkeypatch.setattr(feed.table, "hot_files", real)
    assert sorted(r.reading_id for r in feed.table.read(version=version).collect()) == list(range(15))


def test_a_root_with_odd_characters(spark, root):
    feed = Feed(spark, f"{root}/a b=c%20d")
    assert feed.land(5).flush().land(5).gap() == (10, 5, 5)


def test_a_pinned_version_does_not_move(feed):
    feed.land(10).flush().land(5)
    version = feed.table.pin()
    feed.flush().land(5)
    assert feed.table.read(version=version).count() == 15
    assert feed.table.read("cold", version).count() == 10
    assert feed.gap() == (20, 15, 5)


def test_since_skips_older_snapshots(feed):
    for _ in range(3):
        feed.land(10).flush()
    feed.land(10)
    assert feed.table.pin(since=at(3)).snapshots == (3,)
    assert {r.reading_id for r in feed.table.read(since=at(3)).collect()} == set(range(20, 40))


def test_compaction_keeps_the_rows_and_the_gap(feed):
    for _ in range(3):
        feed.land(10).flush()
    feed.land(7)
    pinned = feed.table.pin()
    assert maintenance.compact(feed.table) == [REWRITE_IDS + 3]
    assert feed.gap() == (37, 30, 7)
    assert feed.table.read(version=pinned).count() == 37  # old files stay until they expire
    assert {r.operation for r in feed.table.live().collect()} == {"replace"}
    assert maintenance.expire(feed.table, older_than_s=3600) == []
    assert maintenance.expire(feed.table, older_than_s=0) == [1, 2, 3]
    assert feed.gap() == (37, 30, 7)
    assert not os.path.exists(f"{feed.table.data}/snapshot_id=1")
    # a second round on top of the first
    feed.flush().land(2)
    assert feed.gap() == (39, 37, 2)
    assert maintenance.compact(feed.table) == [REWRITE_IDS + 4]
    assert feed.gap() == (39, 37, 2)
    assert maintenance.expire(feed.table, older_than_s=0) == [4, REWRITE_IDS + 3]
    assert feed.gap() == (39, 37, 2)


def test_a_rewrite_of_a_rewrite_hides_the_first_generation_too(feed):
    for _ in range(2):
        feed.land(10).flush()
    maintenance.compact(feed.table)
    feed.land(10).flush()
    maintenance.compact(feed.table)  # nothing has expired in between
    assert feed.gap() == (30, 30, 0)
    ids = maintenance.expire(feed.table, older_than_s=0)
    assert ids == [1, 2, 3, REWRITE_IDS + 2]


def test_compaction_splits_rows_that_share_one_time(feed):
    for _ in range(4):
        feed.land(29, when=at(1)).flush()
    maintenance.compact(feed.table, rows_per_file=30)
    (snapshot,) = feed.table.pin().snapshots
    files = [f for f in os.listdir(f"{feed.table.data}/snapshot_id={snapshot}") if f.startswith("part-")]
    assert len(files) == 4
    assert feed.gap() == (116, 116, 0)


def test_full_snapshots_are_not_rewritten_again(feed):
    for _ in range(2):
        feed.land(10).flush()
    assert maintenance.compact(feed.table, rows_per_file=20) == [REWRITE_IDS + 2]
    assert maintenance.compact(feed.table, rows_per_file=20) == []
    for _ in range(2):
        feed.land(10).flush()
    assert maintenance.compact(feed.table, rows_per_file=20) == [REWRITE_IDS + 4]
    assert feed.table.pin().snapshots == (REWRITE_IDS + 2, REWRITE_IDS + 4)
    assert feed.gap() == (40, 40, 0)


def test_lake_is_readable_without_the_tables(spark, feed):
    from tidemark.sources.lake import Lake

    lake = Lake(spark.newSession(), feed.root)
    feed.land(10)
    assert lake.tables() == ["iot_telemetry"]
    assert lake.read("iot_telemetry").count() == 0
    assert lake.read("iot_telemetry").columns == schemas.TELEMETRY.names
    with pytest.raises(LookupError):
        lake.read("no_such_table")
    feed.flush().land(5)
    assert lake.tables() == ["iot_telemetry"]
    assert lake.read("iot_telemetry").count() == 10
    feed.flush()
    maintenance.compact(feed.table)
    assert lake.register() == ["iot_telemetry"]
    assert lake.spark.sql("SELECT count(*) FROM iot_telemetry").first()[0] == 15


def test_changelog_may_not_enter_a_log_table(spark, feed):
    from pyspark.errors import AnalysisException

    feed.land(1)
    counts = feed.table.stream().groupBy(*schemas.TELEMETRY.names).count()
    with pytest.raises(AnalysisException, match="(?i)append"):
        feed.table.append(counts, CATCH_UP)


def test_files_per_batch(spark, root):
    feed = Feed(spark, root)
    drop_rows(readings(spark, [{"reading_id": i} for i in range(9)]), f"{root}/in/1")
    finish([feed.table.append(spark.readStream.schema(schemas.TELEMETRY).parquet(f"{root}/in/*"), CATCH_UP, files=3)])
    assert len(feed.table.hot_files()) == 3


def test_a_backlog_of_any_number_of_files_is_one_snapshot(feed):
    for _ in range(4):
        feed.land(3)
    feed.flush()
    assert feed.table.pin().snapshots == (1,)
    assert feed.table.taken([1]).count() == len(feed.table.hot_files())
    assert feed.gap() == (12, 12, 0)


def test_a_flush_with_a_missing_hot_file_raises(feed):
    feed.land(10).land(10)
    maintenance.storage.delete(feed.table.spark, feed.table.hot_files()[0])
    with pytest.raises(StreamingQueryException):
        feed.flush()
    assert feed.table.snapshots().count() == 0


def test_empty_hot_files_leave_the_union_at_compaction(feed):
    feed.land(5).flush().land(0).land(5)
    with_empty = len(feed.table.pin().hot_paths)
    maintenance.compact(feed.table)
    assert len(feed.table.pin().hot_paths) < with_empty
    assert feed.gap() == (10, 5, 5)


def test_ttl_removes_flushed_files_only(feed):
    feed.land(10).flush().land(5)
    assert maintenance.purge(feed.table) == 0  # nothing is seven days old
    assert maintenance.purge(feed.table, older_than_s=0) == 1
    assert feed.gap() == (15, 10, 5)
    assert maintenance.purge(feed.table, older_than_s=0) == 0
    feed.flush()
    assert feed.gap() == (15, 15, 0)


def test_ttl_finishes_what_a_crash_left(feed, monkeypatch):
    feed.land(10).land(10).flush()
    real, calls = maintenance.storage.delete, []

    def delete(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost the driver")
        return real(spark, path)

    monkeypatch.setattr(maintenance.storage, "delete", delete)
    with pytest.raises(OSError):
        maintenance.purge(feed.table, older_than_s=0)
    monkeypatch.setattr(maintenance.storage, "delete", real)
    assert maintenance.purge(feed.table, older_than_s=0) == 1
    assert feed.gap() == (20, 20, 0)


def _named(feed, name):
    """A standing reader that catches up and stops; what it has read so far."""
    checkpoint, out = f"{feed.root}/{name}-cp", f"{feed.root}/{name}-out"

    def run():
        rows = feed.table.stream(name, checkpoint)
        writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(**CATCH_UP)
        finish([writer.start(out)])
        return sorted(r.reading_id for r in feed.spark.read.schema(schemas.TELEMETRY).parquet(out).collect())

    return run


def test_purging_waits_for_standing_readers(feed):
    feed.land(10).flush()
    read = _named(feed, "slow")
    assert read() == list(range(10))
    feed.land(10).flush().land(5)
    assert maintenance.purge(feed.table, older_than_s=0) == 1  # the second flush is unread
    assert maintenance.purge(feed.table, older_than_s=0) == 0
    assert read() == list(range(25))
    feed.flush()
    assert maintenance.purge(feed.table, older_than_s=0) == 2
    assert feed.gap() == (25, 25, 0)
    feed.land(5)
    assert read() == list(range(30))


def test_a_reader_that_has_not_started_holds_everything(feed):
    feed.land(10).flush()
    feed.table.stream("late", f"{feed.root}/late-cp")
    assert maintenance.purge(feed.table, older_than_s=0) == 0
    assert _named(feed, "late")() == list(range(10))
    feed.table.leave("late")
    assert maintenance.purge(feed.table, older_than_s=0) == 1


def test_a_reader_that_begins_after_a_purge_gets_all_rows_and_restarts_alike(feed):
    for _ in range(2):
        feed.land(10).flush()
    maintenance.purge(feed.table, older_than_s=0)
    feed.land(5)
    feed.table.stream("new", f"{feed.root}/new-cp")  # entered, not yet run
    maintenance.compact(feed.table)
    assert maintenance.expire(feed.table, older_than_s=0) == []  # it still has to read both
    read = _named(feed, "new")
    assert read() == list(range(25))
    assert maintenance.expire(feed.table, older_than_s=0) == [1, 2]
    feed.land(5).flush()
    assert read() == list(range(30))


def test_a_reader_keeps_its_checkpoint(feed):
    feed.table.stream("one", "a")
    with pytest.raises(RuntimeError, match="another checkpoint"):
        feed.table.stream("one", "b")
    with pytest.raises(ValueError):
        feed.table.stream("two")


def test_untiered_log_just_ages_out(spark, root):
    import dataclasses

    feed = Feed(spark, root)
    feed.table = TieredTable(spark, root, dataclasses.replace(schemas.IOT_TELEMETRY, tiered=False)).create()
    feed.land(10)
    assert maintenance.purge(feed.table, older_than_s=0) == 1
    assert feed.table.read().count() == 0


def _streamed(spark, root, stream):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/s-cp").trigger(**CATCH_UP)
        .start(f"{root}/s-out")
    )
    finish([query])
    return sorted(r.reading_id for r in spark.read.schema(schemas.TELEMETRY).parquet(f"{root}/s-out").collect())


def test_stream_opens_with_what_is_there_and_then_climbs(feed, spark, root):
    feed.land(10).flush().land(5)
    assert _streamed(spark, root, feed.table.stream()) == list(range(15))
    feed.land(5).flush()
    assert _streamed(spark, root, feed.table.stream()) == list(range(20))


def test_peek_at_a_stream_gives_a_few_rows_and_no_more(feed, spark, root):
    feed.land(10)
    peek = lambda: analytics.peek(analytics.hotter_than(feed.table.stream(), 19.0))
    assert len(_streamed(spark, root, peek())) == 5
    feed.land(10)
    assert len(_streamed(spark, root, peek())) == 5


def test_stream_takes_purged_rows_from_the_cold_tier(feed, spark, root):
    for _ in range(2):
        feed.land(10).flush()
    maintenance.purge(feed.table, older_than_s=0)
    feed.land(10).flush().land(5)
    maintenance.compact(feed.table)  # purged and unpurged snapshots stay apart
    assert len(feed.table.pin().snapshots) == 2
    assert feed.gap() == (35, 30, 5)
    assert _streamed(spark, root, feed.table.stream()) == list(range(35))


def test_anti_join_names_what_only_hot_has(spark):
    columns = "reading_id bigint, device_id string, temperature double, anomaly_flag boolean"
    cold = spark.createDataFrame([(1, "a", 1.0, True), (2, "a", 1.0, None), (None, "a", 1.0, None)], columns)
    hot = spark.createDataFrame([(2, "b", 2.0, True), (3, "b", 2.0, False), (None, "b", 2.0, None)], columns)
    found = analytics.only_in_hot(hot, cold).collect()
    # As LEFT JOIN .. IS NULL says: a shared id hides the hot row, NULL ids match nothing on either side.
    assert sorted((r.reading_only_in_hot or 0, r.device_id) for r in found) == [(0, "a"), (0, "b"), (3, "b")]
    union = cold.unionByName(hot)
    lake = cold.select("reading_id").withColumnRenamed("reading_id", "lake_id")
    plain = union.join(lake, union.reading_id == lake.lake_id, "left").where("lake_id IS NULL")
    assert plain.count() == len(found)


def test_anti_join_of_a_large_hot_part_shuffles(spark, monkeypatch):
    columns = "reading_id bigint, device_id string, temperature double, anomaly_flag boolean"
    cold = spark.createDataFrame([(i, "a", 1.0, True) for i in range(5)], columns)
    hot = spark.createDataFrame([(i, "b", 2.0, True) for i in range(3, 9)], columns)
    monkeypatch.setattr(analytics, "HOT_IDS", 2)
    frame = analytics.only_in_hot(hot, cold)
    assert "strategy=broadcast" not in frame._jdf.queryExecution().analyzed().toString()
    assert sorted(r.reading_only_in_hot for r in frame.collect()) == [5, 6, 7, 8]


def test_lake_lag_and_flush_intervals(feed):
    feed.land(10).flush().land(5)
    lag = maintenance.lake_lag(feed.table).first()
    assert (lag.table_name, lag.rows_behind, lag.seconds_behind) == ("iot_telemetry", 5, 55)
    feed.flush()
    rows = maintenance.flush_intervals(feed.table).orderBy("snapshot_id").collect()
    assert rows[0].interval_s is None and rows[1].interval_s >= 0
    maintenance.compact(feed.table)
    maintenance.expire(feed.table, older_than_s=0)
    kept = maintenance.flush_intervals(feed.table).orderBy("snapshot_id").collect()
    assert kept == rows


@pytest.mark.parametrize("target,missed", [("30 seconds", False), ("1 minute", False), ("1 second", True)])
def test_flush_lag_reads_its_target_as_an_interval(feed, target, missed):
    import dataclasses

    feed.table.spec = dataclasses.replace(feed.table.spec, freshness=target)
    feed.land(3).flush()
    time.sleep(1.2)
    row = maintenance.flush_lag(feed.land(3).flush().table).first()
    assert (row.flushes, row.intervals, row.missed) == (2, 1, int(missed))
    assert row.target_s == maintenance.seconds_of(target) and row.longest_s >= 1.2
    with pytest.raises(ValueError):
        maintenance.seconds_of("soon")
