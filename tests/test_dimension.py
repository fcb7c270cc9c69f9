from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import at, drop_rows, readings
from tidemark import schemas
from tidemark.operators.enrich import enriched
from tidemark.sources import dimension, storage
from tidemark.sources.dimension import DeviceDimension
from tidemark.streaming.jobs import CATCH_UP, Lakehouse, finish


def device(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.DEVICE)


def test_seed_and_upsert(spark, root):
    dim = DeviceDimension(spark, root, slices=3)
    assert dim.version() is None and dim.current().count() == 0
    dim.seed()
    assert dim.current().count() == 11
    dim.upsert(device(spark, ("device_1", 20.0, "plant_z", "Model-Z", "active"), ("device_12", 21.0, "p", "m", "active")))
    rows = {r.device_id: r.temp_threshold for r in dim.current().collect()}
    assert (len(rows), rows["device_1"], rows["device_12"], rows["device_2"]) == (12, 20.0, 21.0, 24.5)
    assert dim.version() == 2
    assert dim.history().count() == 13


def test_vacuum_keeps_the_newest_versions_and_every_change(spark, root):
    dim = DeviceDimension(spark, root)
    for threshold in range(4):
        dim.upsert(device(spark, ("device_1", float(threshold), "p", "m", "active")))
    assert dim.vacuum(keep=2) == [1, 2]
    assert dim.version() == 4
    assert dim.current().first().temp_threshold == dim.live().first().temp_threshold == 3.0
    assert dim.history().count() == 4
    assert dim.seed() == 5


def test_last_change_per_device_wins(spark, root):
    dim = DeviceDimension(spark, root)
    changes = spark.createDataFrame(
        [("a", 1.0, "p", "m", "active", at(2)), ("a", 2.0, "p", "m", "active", at(1))],
        "device_id string, temp_threshold double, location_id string, model string, status string, valid_from timestamp_ntz",
    )
    dim.upsert(changes)
    assert dim.current().first().temp_threshold == 1.0


def test_uncommitted_version_is_invisible(spark, root):
    dim = DeviceDimension(spark, root)
    dim.seed()
    device(spark, ("x", 1.0, "p", "m", "active")).write.parquet(f"{dim.path}/versions/version=2")
    assert dim.current().count() == 11
    assert dim.live().count() == 11
    dim.upsert(device(spark, ("device_12", 1.0, "p", "m", "active")))
    assert dim.current().count() == dim.live().count() == 12


def test_two_upserts_at_a_time_lose_no_change(spark, root, monkeypatch):
    dim, other = DeviceDimension(spark, root), DeviceDimension(spark, root)
    dim.seed()
    real, inside = dimension.latest_per_device, []

    def while_another_commits(*args):
        if not inside:
            inside.append(True)
            other.upsert(device(spark, ("b", 2.0, "p", "m", "active")))
        return real(*args)

    monkeypatch.setattr(dimension, "latest_per_device", while_another_commits)
    with pytest.raises(RuntimeError, match="repeat this one"):
        dim.upsert(device(spark, ("a", 1.0, "p", "m", "active")))
    assert dim.current().count() == 12 and dim.history().count() == 12
    dim.upsert(device(spark, ("a", 1.0, "p", "m", "active")))
    assert dim.current().count() == 13 and dim.history().count() == 13


def test_live_source_serves_every_slice_once(spark, root):
    dim = DeviceDimension(spark, root, slices=4)
    dim.seed()
    assert sorted(r.device_id for r in dim.live().collect()) == sorted(d[0] for d in schemas.DEVICE_SEED)


@pytest.mark.parametrize("broadcast", [True, False])
def test_each_micro_batch_sees_the_dimension_of_its_time(spark, root, broadcast):
    """A change applies to later readings only; earlier rows keep what they got."""
    dim = DeviceDimension(spark, root, slices=2)
    dim.seed()

    def put(reading_id, device_id):
        drop_rows(readings(spark, [{"reading_id": reading_id, "device_id": device_id}]), f"{root}/in/{reading_id}")

    put(1, "device_1")
    stream = spark.readStream.schema(schemas.TELEMETRY).parquet(f"{root}/in/*")
    query = (
        enriched(stream, dim.live(broadcast), broadcast)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/cp")
        .start(f"{root}/out")
    )
    try:
        query.processAllAvailable()
        put(2, "device_12")
        query.processAllAvailable()
        dim.upsert(device(spark, ("device_12", 30.0, "p", "m", "active"), ("device_1", 10.0, "p", "m", "active")))
        put(3, "device_12")
        put(4, "device_1")
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.reading_id: r.temp_threshold for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {1: 24.0, 2: None, 3: 30.0, 4: 10.0}


def test_broadcast_bound_is_checked_by_every_read(spark, root, monkeypatch):
    monkeypatch.setattr(dimension, "BROADCAST_ROWS", 5)
    dim = DeviceDimension(spark, root)
    dim.seed()
    drop_rows(readings(spark, [{}]), f"{root}/in/1")
    stream = spark.readStream.schema(schemas.TELEMETRY).parquet(f"{root}/in/*")
    query = (
        enriched(stream, dim.live(), True).writeStream.format("noop").option("checkpointLocation", f"{root}/cp").start()
    )
    with pytest.raises(StreamingQueryException, match="may be broadcast with"):
        query.processAllAvailable()
    query.stop()
    assert dim.live(broadcast=False).count() == 11


def test_a_stream_outlives_a_dimension_past_the_broadcast_bound(spark, root, monkeypatch):
    house = Lakehouse(spark, root)
    house.dimension.seed()
    drop_rows(readings(spark, [{"reading_id": 1}]), f"{root}/in/1")
    land = lambda: finish([house.telemetry.append(
        spark.readStream.schema(schemas.TELEMETRY).parquet(f"{root}/in/*"), CATCH_UP)])
    land()
    query = house.start_enrichment({"processingTime": "100 milliseconds"})
    try:
        query.processAllAvailable()
        monkeypatch.setattr(dimension, "BROADCAST_ROWS", 20)
        house.dimension.upsert(device(spark, *[(f"x{i}", 1.0, "p", "m", "active") for i in range(50)]))
        drop_rows(readings(spark, [{"reading_id": 2, "device_id": "x49"}]), f"{root}/in/2")
        land()
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.reading_id: r.temp_threshold for r in house.silver.read().collect()}
    assert got == {1: 24.0, 2: 1.0}


def test_vacuums_leave_no_trail_of_marks(spark, root):
    """Many upserts: claims go, what was retired is one list, and the history is whole, broken-off upserts left out."""
    dim = DeviceDimension(spark, root, slices=1)
    for n in range(4):
        dim.upsert(spark.createDataFrame([("d", float(n), "l", "m", "active")], schemas.DEVICE))
        dim.vacuum(keep=2)
    assert storage.names(spark, f"{dim.path}/claims") == []
    assert storage.names(spark, f"{dim.path}/retired") == ["upto=2"]
    spark.createDataFrame([("broken", 1.0, "l", "m", "active")], schemas.DEVICE).withColumn(
        "valid_from", F.localtimestamp()
    ).write.parquet(f"{dim.path}/changes/version=9")
    assert sorted((r.device_id, r.temp_threshold) for r in dim.history().collect()) == [("d", float(n)) for n in range(4)]
    assert dim.vacuum(keep=2) == []
