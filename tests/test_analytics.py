from __future__ import annotations

import datetime as dt

from tests.helpers import at, silver_rows
from tidemark import schemas
from tidemark.operators import quality
from tidemark.operators.health import health
from tidemark.plans import analytics


def events(spark, rows):
    blank = dict.fromkeys(schemas.EVENTS.names)
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], schemas.EVENTS)


def failed(when, device_id="device_1", **more):
    return {"device_id": device_id, "event_time": when, "event_type": "failure", "severity": "low",
            "error_code": "ERR1000", "component": "motor", "root_cause": "wear", **more}


def test_failure_meets_the_half_open_window(spark):
    gold = health(silver_rows(spark, [{"ingest_time": at(5, 30)}]))
    rows = events(spark, [
        failed(at(4, 59, 999)), failed(at(5)), failed(at(5, 59, 999)), failed(at(6)),
        failed(at(5, 1), "device_2"), failed(at(5, 2), event_type="inspection"), failed(None),
    ])
    found = analytics.failures_in_context(rows, gold)
    assert found.count() == 2
    plain = rows.alias("e").join(
        gold.alias("h"),
        (rows.device_id == gold.device_id) & (rows.event_time >= gold.window_start) & (rows.event_time < gold.window_end),
    ).where("e.event_type = 'failure'")
    assert plain.count() == 2


def test_failure_context_takes_the_newest(spark):
    gold = health(silver_rows(spark, [{"ingest_time": at(m), "reading_id": m} for m in range(30)]))
    rows = events(spark, [failed(at(m, 10)) for m in range(30)])
    top = analytics.failure_context(rows, gold, k=20).collect()
    assert [r.window_start for r in top] == [at(m) for m in range(29, 9, -1)]


def test_lag_is_in_whole_elapsed_seconds(spark):
    rows = silver_rows(spark, [
        {"event_time": at(0, 0, 900), "ingest_time": at(0, 2, 100)},  # 1.2 s
        {"event_time": at(0, 0, 100), "ingest_time": at(0, 0, 999)},  # 0.9 s
        {"event_time": at(0, 1), "ingest_time": at(0, 2)},
    ])
    assert analytics.lag_histogram(rows, at(0, 30)).collect() == [(0, 1), (1, 2)]


def test_relative_time_filters_use_the_clock_by_default(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = silver_rows(spark, [
        {"event_time": now - dt.timedelta(seconds=20), "ingest_time": now},
        {"event_time": now - dt.timedelta(minutes=5), "ingest_time": now},
    ])
    assert analytics.lag_histogram(rows).selectExpr("sum(readings)").first()[0] == 1
    windows = health(rows, "event_time")
    assert analytics.recent_windows(windows).count() == 2
    assert analytics.recent_windows(windows, back="2 MINUTE").count() == 1


def test_feed_follows_three_valued_logic(spark):
    flags = [(True, None), (None, True), (None, None), (False, None), (False, False), (True, False)]
    rows = silver_rows(spark, [
        {"reading_id": i, "anomaly_flag": a, "vibration_spike": v} for i, (a, v) in enumerate(flags)
    ])
    assert analytics.anomaly_feed(rows).count() == 3


def test_share_ranks_devices_not_flags(spark):
    rows = [{"device_id": "device_1", "ingest_time": at(0, s), "temperature": t} for s, t in enumerate((25.0, 20.0, 20.0))]
    rows += [{"device_id": "device_2", "ingest_time": at(0, s), "temperature": 25.0} for s in range(2)]
    ranked = analytics.pct_over_threshold(health(silver_rows(spark, rows))).collect()
    assert [(r.device_id, r.pct_over_threshold, r.anomalous_readings) for r in ranked] == [
        ("device_2", 100.0, 2), ("device_1", 33.3, 1),
    ]


def test_contract_counts_every_kind_of_leak(spark):
    rows = events(spark, [
        failed(at(0)),
        failed(at(0), component=None),                  # a field of its own is missing
        failed(at(0), technician="tech-1"),             # another type's field leaked in
        failed(at(0), event_type="explosion"),
        failed(at(0), severity=None),
    ])
    broken = {r.rule: r.violations for r in quality.event_contract(rows).collect() if r.violations}
    assert broken == {
        "event_type_known": 1, "severity_known": 1, "failure_fields_present": 1,
        "failure_fields_exclusive": 1, "maintenance_fields_exclusive": 1,
    }


def test_landing_health_names_the_symptom(spark):
    rows = silver_rows(spark, [{"event_time": None, "temp_threshold": None}])
    none = spark.createDataFrame([], schemas.GOLD)
    row = quality.landing_health(rows, none).first()
    assert (row.timestamps_lost, row.dimension_missing, row.windows_missing) == (True, True, True)
    fine = silver_rows(spark, [{"event_time": at(0), "ingest_time": at(0)}])
    row = quality.landing_health(fine, health(fine)).first()
    assert (row.timestamps_lost, row.dimension_missing, row.windows_missing) == (False, False, False)
    empty = quality.landing_health(fine.limit(0), none).first()
    assert not (empty.timestamps_lost or empty.dimension_missing or empty.windows_missing)


def test_expected_anomaly_rate_on_uniform_temperatures(spark):
    """Temperatures uniform over 18-30 exceed a threshold T at a rate of (30 - T) / 12."""
    grid = spark.range(12_000).selectExpr("id AS reading_id", "18 + id * 12D / 12000 AS temperature")
    rows = grid.selectExpr(
        "24D AS temp_threshold", "temperature > 24D AS anomaly_flag", "CAST(NULL AS BOOLEAN) AS vibration_spike"
    )
    row = quality.rate_profile(rows).first()
    assert abs(row.anomalies / row.readings - 0.5) < 0.001


def test_peek_reads_few_rows(spark):
    rows = silver_rows(spark, [{"reading_id": i, "temperature": 20.0 + i} for i in range(20)])
    assert analytics.peek(rows).count() == 5
    assert analytics.peek(analytics.hotter_than(rows, 29.0), 50).count() == 10
