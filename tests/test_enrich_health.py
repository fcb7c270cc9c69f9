from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import at, drop_rows, readings, silver_rows
from tidemark import schemas
from tidemark.operators.enrich import silver
from tidemark.operators.health import health, health_stream
from tidemark.plans import bindings
from tidemark.sources.dimension import seed_rows
from tidemark.streaming.jobs import CATCH_UP


def test_flags_are_strict_and_null_for_an_unknown_device(spark):
    rows = readings(
        spark,
        [
            {"reading_id": 1, "temperature": 24.0, "vibration": 3.0},
            {"reading_id": 2, "temperature": 24.1, "vibration": 3.1},
            {"reading_id": 3, "device_id": "device_12", "temperature": 99.0},
            {"reading_id": 4, "temperature": None, "vibration": None},
        ],
    )
    out = silver(rows, seed_rows(spark), F.lit(at(1)).cast("timestamp_ntz"))
    assert out.schema.names == schemas.SILVER.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.SILVER]
    got = {r.reading_id: r for r in out.collect()}
    assert (got[1].anomaly_flag, got[1].vibration_spike) == (False, False)
    assert (got[2].anomaly_flag, got[2].vibration_spike) == (True, True)
    assert (got[3].anomaly_flag, got[3].temp_threshold, got[3].model) == (None, None, None)
    assert (got[4].anomaly_flag, got[4].vibration_spike) == (None, None)


def test_ingest_stamp_is_now_in_milliseconds(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=1)
    stamp = silver(readings(spark, [{}]), seed_rows(spark)).first().ingest_time
    assert before < stamp < before + dt.timedelta(minutes=1)
    assert stamp.microsecond % 1000 == 0


def test_unknown_device_has_points_but_no_anomalies(spark):
    rows = silver_rows(spark, [
        {"device_id": "device_12", "ingest_time": at(0, 1), "temperature": 99.0, "temp_threshold": None,
         "location_id": None, "model": None},
        {"device_id": "device_12", "ingest_time": at(0, 59, 999), "temperature": 20.0, "temp_threshold": None,
         "location_id": None, "model": None},
    ])
    row = health(rows).first()
    assert (row.cnt_points, row.cnt_anomalies, row.anomaly_flag, row.location_id) == (2, 0, None, None)
    assert (row.window_start, row.window_end) == (at(0), at(1))


def test_threshold_changed_mid_window_gives_one_row(spark):
    rows = silver_rows(spark, [
        {"ingest_time": at(0, 1), "temperature": 25.0, "temp_threshold": 24.0, "location_id": "plant_a"},
        {"ingest_time": at(0, 2), "temperature": 25.0, "temp_threshold": 26.0, "location_id": "plant_b"},
        {"ingest_time": at(0, 3), "temperature": None, "energy_usage": None, "temp_threshold": 26.0, "model": None},
    ])
    found = health(rows).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.cnt_points, row.cnt_anomalies, row.threshold_used, row.location_id) == (3, 1, 26.0, "plant_b")
    assert (row.avg_temperature, row.avg_energy_usage, row.anomaly_flag, row.model) == (25.0, 1.0, False, "Model-A")


def test_all_null_measures_average_to_null(spark):
    row = health(silver_rows(spark, [{"ingest_time": at(0), "temperature": None, "energy_usage": None}])).first()
    assert (row.cnt_points, row.avg_temperature, row.avg_energy_usage) == (1, None, None)


def test_gold_schema(spark):
    frame = health(silver_rows(spark, [{"ingest_time": at(0)}]))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schemas.GOLD]


def _run(spark, root, stream):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp").trigger(**CATCH_UP)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    return query, spark.read.schema(schemas.GOLD).parquet(f"{root}/out")


def test_stream_and_batch_agree(spark, root, sf):
    rows = silver(bindings.telemetry(spark, sf), seed_rows(spark), bindings.arrival())
    drop_rows(rows, f"{root}/in/1")
    drop_rows(silver_rows(spark, [{"device_id": None, "ingest_time": dt.datetime(2025, 1, 1)}]), f"{root}/in/2")
    stream = health_stream(spark.readStream.schema(schemas.SILVER).parquet(f"{root}/in/*"))
    _, out = _run(spark, root, stream)
    fix = lambda df: df.withColumns({c: F.round(c, 9) for c in ("avg_temperature", "avg_energy_usage")})
    assert out.count() == health(rows).count()
    assert fix(out).exceptAll(fix(health(rows))).count() == 0


def test_late_row_is_dropped_and_its_window_kept(spark, root):
    """Event time with five seconds of patience: a row fifty seconds late is not counted."""
    put = lambda name, *times: drop_rows(
        silver_rows(spark, [{"event_time": t} for t in times]), f"{root}/in/{name}"
    )
    stream = lambda: health_stream(
        spark.readStream.schema(schemas.SILVER).parquet(f"{root}/in/*"), "event_time", "5 seconds"
    )
    put("1", at(0, 10), at(1, 20))
    _run(spark, root, stream())
    put("2", at(0, 30), at(1, 40))  # the first is behind the watermark of 1:15 and in a closed window
    query, out = _run(spark, root, stream())
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    put("3", at(9))
    _, out = _run(spark, root, stream())
    counts = {r.window_start: r.cnt_points for r in out.collect()}
    assert counts == {at(0): 1, at(1): 2}
    assert dropped == 1


def test_out_of_order_within_patience_is_counted(spark, root):
    rows = [{"event_time": t} for t in (at(0, 58), at(1, 2), at(0, 59))]
    drop_rows(silver_rows(spark, rows[:2]), f"{root}/in/1")
    stream = lambda: health_stream(
        spark.readStream.schema(schemas.SILVER).parquet(f"{root}/in/*"), "event_time", "5 seconds"
    )
    _run(spark, root, stream())
    drop_rows(silver_rows(spark, rows[2:]), f"{root}/in/2")
    _run(spark, root, stream())
    drop_rows(silver_rows(spark, [{"event_time": at(5)}]), f"{root}/in/3")
    _, out = _run(spark, root, stream())
    assert {r.window_start: r.cnt_points for r in out.collect()} == {at(0): 2, at(1): 1}


def test_an_idle_source_releases_its_window_on_a_tick(spark, root):
    drop_rows(silver_rows(spark, [{"ingest_time": at(0, 10)}]), f"{root}/in/1")
    stream = lambda: health_stream(spark.readStream.schema(schemas.SILVER).parquet(f"{root}/in/*"))
    _, out = _run(spark, root, stream())
    assert out.count() == 0
    drop_rows(silver_rows(spark, [{"device_id": None, "ingest_time": at(1)}]), f"{root}/in/2")
    _, out = _run(spark, root, stream())
    assert [(r.window_start, r.cnt_points) for r in out.collect()] == [(at(0), 1)]
