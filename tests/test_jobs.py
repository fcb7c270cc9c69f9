from __future__ import annotations

import json
import time

import pytest

from tests.helpers import at, drop_lines, message
from tidemark import schemas
from tidemark.plans import analytics, registry
from tidemark.sources import messages, storage
from tidemark.streaming import live
from tidemark.streaming.jobs import CATCH_UP, Lakehouse, finish
from tidemark.streaming.monitor import FreshnessMonitor
from tidemark.streaming.watch import LandingHealth


def failure(device_id, when):
    return json.dumps({"device_id": device_id, "event_time": when.isoformat(timespec="milliseconds"), "severity": "high",
                       "event_type": "failure", "error_code": "ERR1000", "component": "motor", "root_cause": "wear"})


@pytest.fixture
def house(spark, root):
    house = Lakehouse(spark, f"{root}/tables")
    house.dimension.seed()
    house.inbox = lambda topic: messages.from_folder(spark, f"{root}/inbox/{topic}/*")
    return house


def land(house):
    finish(house.start_landing(house.inbox("telemetry"), house.inbox("events"), CATCH_UP))


def test_from_messages_to_both_tiers(spark, root, house):
    drop_lines(spark, f"{root}/inbox/telemetry/1", [
        message(1, temperature=25.0), message(2, "device_12", temperature=99.0), "garbage", message(3, temperature="x"),
    ])
    drop_lines(spark, f"{root}/inbox/events/1", [failure("device_1", at(0))])
    land(house)
    assert house.telemetry.read().count() == 3
    assert house.events.read().first().component == "motor"
    assert [r.reason for r in house.quarantined(house.telemetry).collect()] == ["not_json"]

    finish([house.start_enrichment(CATCH_UP)])
    silver = {r.reading_id: r for r in house.silver.read().collect()}
    assert (silver[1].anomaly_flag, silver[2].anomaly_flag, silver[3].anomaly_flag) == (True, None, None)

    finish(house.start_tiering(CATCH_UP))
    land(house)  # nothing new
    assert analytics.freshness_gap(house.silver.read(tagged=True)).first().rows_only_in_hot == 0

    house.register_views()
    name = schemas.DEVICE_TELEMETRY.name
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 3
    assert spark.sql(f"SELECT count(*) FROM `{name}$lake`").first()[0] == 3
    assert spark.sql(f"SELECT snapshot_id, operation FROM `{name}$lake$snapshots`").collect() == [(1, "append")]
    assert spark.sql(f"SELECT operation FROM {name}__lake__snapshots").first()[0] == "append"
    hot = spark.sql(f"SELECT device_id, count(*) AS anomalies FROM {name} WHERE anomaly_flag GROUP BY device_id").collect()
    assert hot == [("device_1", 1)]
    assert spark.sql("SELECT count(*) FROM dim_device").first()[0] == 11


def test_standing_jobs_side_by_side(spark, root, house):
    """All jobs run at once on short triggers; a reading reaches the cold tier and its window closes on the clock."""
    fast = {"processingTime": "200 milliseconds"}
    drop_lines(spark, f"{root}/inbox/telemetry/1", [message(i) for i in range(20)])
    drop_lines(spark, f"{root}/inbox/events/1", [failure("device_1", at(0))])
    running = house.start_landing(house.inbox("telemetry"), house.inbox("events"), fast, quarantine=False)
    running += [house.start_enrichment(fast), house.start_health(fast, size="2 seconds")]
    running += house.start_tiering(fast)
    running.append(live.running_count(house.silver.stream(), "hot_plus_cold", "live_silver", fast))
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            windows = house.gold.read("cold").count()
            if windows and house.silver.read("cold").count() == 20 and house.events.read("cold").count() == 1:
                break
            time.sleep(0.5)
        assert all(q.exception() is None for q in running)
    finally:
        for query in running:
            query.stop()
    assert house.gold.read("cold").selectExpr("sum(cnt_points)").first()[0] == 20
    assert spark.table("live_silver").first().hot_plus_cold == 20


def test_monitor_samples_a_pinned_gap_per_round(spark, root, house):
    monitor = FreshnessMonitor(spark, f"{root}/gap")
    drop_lines(spark, f"{root}/inbox/telemetry/1", [message(i) for i in range(4)])
    drop_lines(spark, f"{root}/inbox/events/1", [failure("device_1", at(0))])
    land(house)
    monitor.sample(house.telemetry)
    finish(house.start_tiering(CATCH_UP))
    FreshnessMonitor(spark, f"{root}/gap").sample(house.telemetry)  # goes on after a restart
    rows = monitor.samples().orderBy("round").collect()
    assert [(r.round, r.hot_plus_cold, r.cold_only, r.rows_only_in_hot) for r in rows] == [(1, 4, 0, 4), (2, 4, 4, 0)]


def test_another_time_zone_is_refused(spark, root):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            Lakehouse(spark, root)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.from_topic(spark, "localhost:1", "iot-telemetry")


def test_arrival_query_raises_when_its_stream_has_failed(spark, sf, monkeypatch):
    class Failed:
        isActive = False

        def exception(self):
            return RuntimeError("the stream was lost")

        def stop(self):
            pass

    monkeypatch.setattr(Lakehouse, "start_health", lambda self, *args, **how: Failed())
    with pytest.raises(RuntimeError, match="the stream was lost"):
        registry.queries()["stream_gold_arrival"](spark, sf)


def test_rows_and_what_is_set_aside_are_one_commit(spark, root, house):
    """A landing that broke off after its write, before its checkpoint said so, repeats the micro-batch: nothing doubles."""
    lines = [message(1), "garbage", message(2), json.dumps({"reading_id": 3})]
    drop_lines(spark, f"{root}/inbox/telemetry/1", lines)
    drop_lines(spark, f"{root}/inbox/events/1", [failure("device_1", at(0)), "{"])
    running = house.start_landing(house.inbox("telemetry"), house.inbox("events"), CATCH_UP)
    assert len(running) == 2  # a query per topic
    finish(running)

    def landed():
        aside = sorted((r.value, r.reason) for r in house.quarantined(house.telemetry).collect())
        return sorted(r.reading_id for r in house.telemetry.read().collect()), aside, house.events.read().count()

    once = ([1, 2], sorted([("garbage", "not_json"), (lines[3], "no_device_id")]), 1)
    assert landed() == once
    for table in (house.telemetry, house.events):
        storage.delete(spark, f"{table.append_checkpoint}/commits/0")
    land(house)
    assert landed() == once
    finish([house.telemetry.flush(CATCH_UP), house.events.flush(CATCH_UP)])
    assert sorted(r.reading_id for r in house.telemetry.read("cold").collect()) == [1, 2]
    assert landed() == once and house.telemetry.read("hot").count() == 0
    assert sorted(r.reading_id for r in stream_once(spark, house.telemetry, root)) == [1, 2]
    assert spark.read.parquet(house.telemetry.data).columns == [*schemas.TELEMETRY.names, "snapshot_id"]


def stream_once(spark, table, root):
    query = table.stream().writeStream.format("parquet").option("checkpointLocation", f"{root}/once").trigger(**CATCH_UP)
    finish([query.start(f"{root}/streamed")])
    return spark.read.schema(table.spec.schema).parquet(f"{root}/streamed").collect()


def test_a_broken_landing_shows_while_it_runs(spark, root, house):
    """An enrichment whose readings have lost their times is told by the figures of the micro-batch alone."""
    seen = LandingHealth(spark, f"{root}/health")
    spark.streams.addListener(seen)
    try:
        drop_lines(spark, f"{root}/inbox/telemetry/1", [message(1), message(2, "device_77")])
        land(house)
        finish([house.start_enrichment(CATCH_UP)])
        seen.wait(1)
        lost = [message(n, "device_77").replace("T00:", " 00:") for n in (3, 4)]
        drop_lines(spark, f"{root}/inbox/telemetry/2", lost)
        land(house)
        finish([house.start_enrichment(CATCH_UP)])
        rows = seen.wait(2).rows().orderBy("batch_id").collect()
    finally:
        spark.streams.removeListener(seen)
    assert [(r.readings, r.null_event_time, r.null_threshold) for r in rows] == [(2, 0, 1), (2, 2, 2)]
    assert [(r.timestamps_lost, r.dimension_missing) for r in rows] == [(False, False), (True, True)]
    with pytest.raises(TimeoutError):
        seen.wait(3, seconds=0.1)
