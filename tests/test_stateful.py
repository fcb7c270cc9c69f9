"""Keyed state, changes as rows, live joins and rankings: what a stream does, against what batch says."""

from __future__ import annotations

import math
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import at, drop_rows, readings, silver_rows
from tidemark import schemas
from tidemark.operators import changelog, quality
from tidemark.operators.health import health, health_stream
from tidemark.plans import analytics
from tidemark.sources.dimension import DeviceDimension
from tidemark.sources.tiered import TieredTable
from tidemark.streaming import live, stateful
from tidemark.streaming.jobs import CATCH_UP

CHANGE = "device_id string, arrived timestamp_ntz, temp_threshold double, model string"


def write(rows, out, trigger=CATCH_UP):
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(**trigger)
    return query.start(f"{out}/rows")


def stream(spark, like, path):
    return spark.readStream.schema(like.schema).parquet(f"{path}/*")


def test_a_change_applies_to_the_readings_after_it_alone(spark, root):
    """Before, with and after a change in one micro-batch; in the next run what was learned still holds."""
    arrive = lambda rows: readings(spark, rows).withColumn("arrived", F.col("event_time"))
    first = arrive([
        {"reading_id": 2**60 + i, "event_time": at(0, i), "device_id": d, "signal_strength": s}
        for i, (d, s) in enumerate([("device_1", 5), ("device_1", None), (None, 1), ("device_1", 2), ("new", 3), ("new", 4)])
    ])
    changes = spark.createDataFrame(
        [("device_1", at(0, 1), 24.0, "a"), ("device_1", at(0, 3), 25.0, None), (None, at(0), 1.0, "x"), ("new", at(0, 5), 9.0, "n")], CHANGE
    )
    drop_rows(first, f"{root}/readings/1")
    drop_rows(changes, f"{root}/changes/1")

    def run():
        found = stateful.lookup_per_reading(
            stream(spark, first, f"{root}/readings"), stream(spark, changes, f"{root}/changes"), "arrived",
            ["temp_threshold", "model"], spread=3,
        )
        write(found, root).awaitTermination()
        rows = spark.read.schema(found.schema).parquet(f"{root}/rows").collect()
        return {r.reading_id: (r.device_id, r.signal_strength, r.temp_threshold, r.model) for r in rows}

    assert run() == {
        2**60: ("device_1", 5, None, None), 2**60 + 1: ("device_1", None, 24.0, "a"), 2**60 + 2: (None, 1, None, None),
        2**60 + 3: ("device_1", 2, 25.0, None), 2**60 + 4: ("new", 3, None, None), 2**60 + 5: ("new", 4, 9.0, "n"),
    }
    drop_rows(arrive([{"reading_id": 7, "event_time": at(1)}, {"reading_id": 8, "event_time": at(1), "device_id": "new"}]), f"{root}/readings/2")
    drop_rows(spark.createDataFrame([("new", at(2), 10.0, "o")], CHANGE), f"{root}/changes/2")
    again = run()
    assert len(again) == 8 and again[7][2:] == (25.0, None) and again[8][2:] == (9.0, "n")


def test_windows_close_by_timers_and_count_readings_without_a_device(spark, root):
    """Readings land once; with no more to come their window closes, the same as in batch."""
    rows = silver_rows(spark, [
        {"reading_id": i, "device_id": d, "temperature": 20.0 + i, "model": m, "location_id": None, "vibration": v}
        for i, (d, m, v) in enumerate([("a", "x", 4.0), ("a", "y", None), (None, "x", 1.0), (None, None, 5.0), ("b", None, 1.0), ("", "z", 1.0)])
    ])
    drop_rows(rows, f"{root}/in/1")
    query = write(stateful.arrival_windows(stream(spark, rows, f"{root}/in"), "1 second", 500), root, {"processingTime": "200 milliseconds"})
    try:
        until = time.time() + 90
        closed = []
        while not closed:
            time.sleep(1)
            assert query.isActive and time.time() < until, query.exception()
            if query.lastProgress:  # the sink has a log to read
                closed = spark.read.schema(schemas.GOLD).parquet(f"{root}/rows").collect()
    finally:
        query.stop()
    one = rows.withColumn("ingest_time", F.lit(at(0)).cast("timestamp_ntz"))
    want = {tuple(r) for r in health(one).drop("window_start", "window_end").collect()}
    assert {tuple(r)[:1] + tuple(r)[3:] for r in closed} == want and len(closed) == 4


def test_ticks_are_told_from_readings_without_a_device(spark, root):
    rows = silver_rows(spark, [{"reading_id": i, "device_id": d, "ingest_time": at(i)} for i, d in enumerate([None, "a", None])])
    tick = spark.createDataFrame([(at(60), True)], "ingest_time timestamp_ntz, is_tick boolean")
    drop_rows(rows.unionByName(tick, allowMissingColumns=True), f"{root}/in/1")
    arriving = stream(spark, rows.withColumn("is_tick", F.lit(True)), f"{root}/in")
    write(health_stream(arriving, "ingest_time"), root).awaitTermination()
    got = {tuple(r) for r in spark.read.schema(schemas.GOLD).parquet(f"{root}/rows").collect()}
    assert got == {tuple(r) for r in health(rows).collect()} and len(got) == 3


def test_late_rows_are_marked_and_none_is_lost(spark, root):
    minutes = lambda ids: silver_rows(spark, [{"reading_id": i, "event_time": m} for i, m in ids])
    drop_rows(minutes([(0, at(10)), (1, at(11)), (2, at(12, 4))]), f"{root}/in/1")

    def run():
        write(stateful.tell_late(stream(spark, minutes([]), f"{root}/in"), "event_time", "5 seconds"), root).awaitTermination()
        rows = spark.read.parquet(f"{root}/rows").collect()
        return {r.reading_id: r.late for r in rows}

    assert run() == {0: False, 1: False, 2: False}
    # The watermark is 11:59, so the window that ends at 11:00 has closed and the one that ends at 12:00 has not.
    drop_rows(minutes([(3, at(1)), (4, at(10, 59, 999)), (5, at(11)), (6, at(11, 59)), (7, at(13)), (8, None)]), f"{root}/in/2")
    assert run() == {0: False, 1: False, 2: False, 3: True, 4: True, 5: False, 6: False, 7: False, 8: False}


# ---- changes of the dimension ----


def kinds(rows):
    return sorted((r.version, r.device_id, r[changelog.KIND], r.temp_threshold) for r in rows.collect())


def test_changelog_says_what_each_version_changed(spark):
    schema = "version bigint, device_id string, temp_threshold double, model string"
    rows = spark.createDataFrame([
        (1, "same", 1.0, None), (3, "same", 1.0, None), (4, "same", 1.0, None), (1, "gone", 2.0, "m"), (1, "back", 3.0, "m"),
        (4, "back", 3.0, "m"), (3, "new", 4.0, "m"), (4, "new", 4.0, None), (2, "never committed", 9.0, "m"),
    ], schema)
    found = changelog.changelog(rows, [4, 1, 3])
    assert kinds(found) == sorted([
        (1, "same", "+I", 1.0), (1, "gone", "+I", 2.0), (1, "back", "+I", 3.0), (3, "gone", "-D", 2.0), (3, "back", "-D", 3.0),
        (3, "new", "+I", 4.0), (4, "back", "+I", 3.0), (4, "new", "-U", 4.0), (4, "new", "+U", 4.0),
    ])
    again = sorted(tuple(r) for r in changelog.replayed(found).select("device_id", "temp_threshold", "model").collect())
    assert again == [("back", 3.0, "m"), ("new", 4.0, None), ("same", 1.0, None)]
    assert kinds(changelog.changelog(rows.limit(0), [])) == []


def test_replaying_the_changelog_rebuilds_the_dimension(spark, root):
    dim = DeviceDimension(spark, root, slices=2)
    assert dim.changelog().count() == 0
    dim.seed()
    row = ("plant_z", "Model-Z", "active")
    dim.upsert(spark.createDataFrame([("device_1", 99.0, *row), ("device_99", 1.0, *row)], schemas.DEVICE))
    seeded = {r.device_id: r for r in dim.changelog().where("version = 1").collect()}
    dim.upsert(spark.createDataFrame([(*list(seeded["device_2"])[2:],)], schemas.DEVICE))  # nothing new
    same = sorted(map(tuple, dim.current().collect()))
    assert sorted(map(tuple, changelog.replayed(dim.changelog()).collect())) == same
    later = dim.changelog(since=1)
    assert kinds(later) == [(2, "device_1", "+U", 99.0), (2, "device_1", "-U", 24.0), (2, "device_99", "+I", 1.0)]


def test_an_append_only_table_refuses_changes(spark, root):
    changes = spark.createDataFrame([("+I", "a"), ("+U", "b")], f"{changelog.KIND} string, device_id string")
    assert changelog.insert_only(changes.limit(1)).collect() == [("a",)]
    with pytest.raises(PySparkException, match="append-only"):
        changelog.insert_only(changes).collect()
    table = TieredTable(spark, root, schemas.IOT_TELEMETRY).create()
    with pytest.raises(ValueError, match="append-only"):
        table.append(changes, CATCH_UP)


# ---- exact difference, live join, ranking, histogram ----


def test_exact_difference_counts_copies_and_does_not_trust_ids(spark):
    schema = "reading_id bigint, device_id string, temperature double"
    cold = [(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0), (None, None, None), (3, "c", float("nan"))]
    hot = [(1, "z", 9.0), (1, "a", 1.0), (None, None, None), (3, "c", float("nan")), (4, "d", 4.0), (4, "d", 4.0)]
    lake = spark.createDataFrame(cold, schema)
    found = analytics.only_in_hot_exact(lake.union(spark.createDataFrame(hot, schema)), lake)
    got = sorted(((r.reading_id, r.device_id, r.copies) for r in found.collect()), key=str)
    assert got == sorted([(1, "z", 1), (1, "a", 1), (None, None, 1), (3, "c", 1), (4, "d", 2)], key=str)
    assert "partial_sum" in found._jdf.queryExecution().executedPlan().toString()
    assert analytics.only_in_hot_exact(lake, lake).count() == 0


def test_live_failures_meet_their_window_and_state_expires(spark, root):
    """Failures before and after their window; once the watermarks are past them neither side is kept."""
    hours = lambda n: at(60 * n)
    blank = spark.createDataFrame([], schemas.EVENTS)
    event = lambda h, d="a": (d, hours(h), "failure", "motor", "wear")
    some = "device_id string, event_time timestamp_ntz, event_type string, component string, root_cause string"
    events = lambda rows: blank.unionByName(spark.createDataFrame(rows, some), allowMissingColumns=True)
    none = spark.createDataFrame([], schemas.GOLD)
    window = "device_id string, window_start timestamp_ntz, max_temperature double"
    gold = lambda rows: none.unionByName(spark.createDataFrame(rows, window), allowMissingColumns=True)
    drops = [
        ([event(1), event(2), event(2, "b"), event(3, None)], [("a", hours(1), 1.0)]),
        ([event(40), event(1, "late")], [("a", hours(2), 2.0), ("b", hours(2), 3.0), (None, hours(3), 4.0), ("a", hours(40), 5.0)]),
        ([event(80, "c")], [("c", hours(80), 6.0)]), ([event(81, "d")], [("d", hours(82), 6.0)]),
    ]
    kept, landed = [], []
    for n, (failed, windows) in enumerate(drops):
        drop_rows(events(failed), f"{root}/events/{n}")
        drop_rows(gold(windows), f"{root}/gold/{n}")
        landed.append(len(failed) + len(windows))
        joined = live.failures_in_context(stream(spark, blank, f"{root}/events"), stream(spark, none, f"{root}/gold"), "1 hour")
        query = write(joined, root)
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.device_id, r.max_c) for r in spark.read.schema(joined.schema).parquet(f"{root}/rows").collect())
    assert got == [("a", 1.0), ("a", 2.0), ("a", 5.0), ("b", 3.0), ("c", 6.0)]
    assert sum(landed) == 15 and kept[-1] <= 5


def test_ranking_is_bounded_and_a_repeated_batch_changes_nothing(spark, root):
    def rows(counts):
        return silver_rows(spark, [
            {"device_id": d, "temperature": 30.0 + n, "anomaly_flag": True} for d, m in counts.items() for n in range(m)
        ])

    ranking = live.HotRanking(spark, f"{root}/ranking", f"{root}/checkpoint", k=2)
    assert ranking.current().count() == 0
    expected = []
    for n, counts in enumerate([{"a": 3, "b": 2, "c": 1}, {"c": 3, "d": 1}, {"b": 1, "d": 2, "e": 1}]):
        drop_rows(rows(counts), f"{root}/in/{n}")
        ranking.start(stream(spark, rows({"a": 1}), f"{root}/in"), CATCH_UP).awaitTermination()
        everything = spark.read.schema(schemas.SILVER).parquet(f"{root}/in/*")
        expected.append([tuple(r) for r in analytics.hot_devices(everything).limit(2).collect()])
        assert [tuple(r) for r in ranking.current().collect()] == expected[-1]
    changed = spark.createDataFrame([("b", 3, 31.0), ("d", 3, 31.0), ("e", 1, 30.0)], "device_id string, anomalies bigint, worst_temp double")
    ranking._replace(changed, 2)
    assert [tuple(r) for r in ranking.current().collect()] == expected[-1]


def test_histograms_of_every_instant_equal_the_batch_one(spark, root):
    rows = silver_rows(spark, [
        {"event_time": at(0, s, ms), "ingest_time": at(0, s + lag, ms)} for s, ms, lag in
        [(0, 0, 1), (0, 1, 1), (10, 0, 2), (10, 500, 0), (20, 0, 1), (59, 999, 3), (60, 0, 1), (75, 0, 2)]
    ])
    drop_rows(rows, f"{root}/in/1")
    drop_rows(silver_rows(spark, [{"event_time": at(60), "ingest_time": at(60)}]), f"{root}/in/2")
    found = live.lag_histograms(stream(spark, rows, f"{root}/in"), "10 seconds")
    write(found, root).awaitTermination()
    got = {}
    for r in spark.read.schema(found.schema).parquet(f"{root}/rows").collect():
        got.setdefault(r.as_of, {})[r.lag_s] = r.readings
    for s in range(0, 140, 10):
        want = analytics.lag_histogram(rows.where(F.col("event_time") <= F.lit(at(0, s).isoformat()).cast("timestamp_ntz")), at(0, s))
        assert got.get(at(0, s), {}) == {r.lag_s: r.readings for r in want.collect()}


# ---- measured against expected ----


def test_tail_probabilities():
    """Against the series and the error function of Python."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    xs = [0.0, 0.1, 1.0, 2.5, 7.0, 30.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for freedom in range(1, 8):
        got = [r.p for r in df.select("x", quality.chi_square_tail(F.col("x"), freedom).alias("p")).orderBy("x").collect()]
        for x, p in zip(xs, got):
            # The density integrated by midpoints, beyond x.
            if freedom == 1:
                want = math.erfc(math.sqrt(x / 2))
            else:
                n, top = 40_000, 200.0
                step = (top - x) / n
                want = sum(
                    (x + (i + 0.5) * step) ** (freedom / 2 - 1) * math.exp(-(x + (i + 0.5) * step) / 2) for i in range(n)
                ) * step / (2 ** (freedom / 2) * math.gamma(freedom / 2))
            assert abs(p - want) < 2e-4, (freedom, x)
    for x, p in df.select("x", quality.two_sided(F.col("x")).alias("p")).collect():
        assert abs(p - math.erfc(x / math.sqrt(2))) < 2e-7


def test_a_shifted_mix_is_refused(spark):
    def mix(failures, maintenances, inspections, others=0):
        kinds = {"failure": failures, "maintenance": maintenances, "inspection": inspections, "other": others}
        rows = [(k,) for k, n in kinds.items() for _ in range(n)]
        return quality.type_mix_fit(spark.createDataFrame(rows, "event_type string")).first()

    assert mix(100, 300, 600).p_value == 1.0 and mix(110, 290, 600).p_value > 0.4
    assert mix(200, 250, 550).p_value < 1e-6
    assert (mix(100, 300, 600, 1).p_value, mix(100, 300, 600, 1).unexpected) == (0.0, 1)
    assert (mix(0, 0, 0).n, mix(0, 0, 0).p_value) == (0, 1.0)


def test_a_shifted_rate_is_refused(spark):
    def rates(threshold, over, spikes, n=1200):
        rows = [{"temp_threshold": threshold, "anomaly_flag": i < over, "vibration_spike": i < spikes} for i in range(n)]
        return {r.rate: r.p_value for r in quality.rate_fit(silver_rows(spark, rows)).collect()}

    fair = rates(24.0, 600, 60)
    assert fair["anomaly"] > 0.99 and fair["spike"] > 0.99
    off = rates(24.0, 700, 120)
    assert off["anomaly"] < 1e-6 and off["spike"] < 1e-6
    assert rates(30.0, 0, 60)["anomaly"] == 1.0 and rates(31.0, 1, 60)["anomaly"] == 0.0
