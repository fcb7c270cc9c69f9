"""The physical plans the engine counts on at scale."""

from __future__ import annotations

import re

import pytest

from tidemark.operators.health import health
from tidemark.plans import analytics, bindings, registry
from tidemark.schemas import GOLD, SILVER
from tidemark.operators.enrich import silver
from tidemark.sources.dimension import seed_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    rows = silver(bindings.telemetry(spark, "/root/testdata/sf0.001"), seed_rows(spark), bindings.arrival())
    rows.write.parquet(f"{root}/silver")
    health(rows).write.parquet(f"{root}/gold")
    bindings.iot_events(spark, "/root/testdata/sf0.001").write.parquet(f"{root}/events")
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    return read


def test_gold_hashes_its_readings_and_sorts_only_partial_rows(spark, tables):
    text = plan(health(tables("silver")))
    scan_side = text[text.index("cnt_points"):]
    first = scan_side.rindex("HashAggregate")
    assert "Sort [" not in scan_side[first:]  # nothing is sorted below the first aggregation
    assert "partial_count(1)" in text


def test_time_filters_reach_the_scan(spark, tables):
    import datetime as dt

    as_of = dt.datetime(2024, 1, 30)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(event_time", plan(analytics.lag_histogram(tables("silver"), as_of)))
    assert re.search(
        r"PushedFilters: \[.*GreaterThanOrEqual\(window_start", plan(analytics.recent_windows(tables("gold"), as_of))
    )
    assert re.search(r"PushedFilters: \[.*GreaterThan\(event_time", plan(analytics.lag_histogram(tables("silver"))))


def test_scans_read_only_what_the_query_names(spark, tables):
    text = plan(analytics.hot_devices(tables("silver")))
    assert "ReadSchema: struct<device_id:string,temperature:double,anomaly_flag:boolean>" in text
    assert "ReadSchema: struct<>" in plan(analytics.row_count(tables("silver"), "n"))
    assert "EqualTo(anomaly_flag,true)" in text


def test_failure_context_joins_on_equality_and_keeps_twenty(spark, tables):
    text = plan(analytics.failure_context(tables("events"), tables("gold")))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "TakeOrderedAndProject(limit=20" in text
    assert "EqualTo(event_type,failure)" in text


def test_anti_join_scans_one_cold_column_and_shuffles_neither_tier(spark, tables):
    silver_rows = tables("silver")
    text = plan(analytics.only_in_hot(silver_rows.where("reading_id > 500"), silver_rows))
    assert "LeftAnti, BuildRight" in text and "LeftSemi, BuildRight" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<reading_id:bigint>" in text
    # the one exchange is of cold ids that were found among the hot ones
    assert text.count("hashpartitioning") == 1


def test_lookup_does_not_shuffle_readings(spark, sf):
    text = plan(registry.queries()["lookup_join"](spark, sf))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_schemas_match_what_the_operators_write(tables):
    assert tables("silver").schema.names == SILVER.names
    assert tables("gold").schema.names == GOLD.names


def test_streaming_windows_hash_raw_readings(spark, tables, tmp_path):
    from tidemark.operators.health import health_stream

    rows = spark.readStream.schema(SILVER).parquet(tables("silver").inputFiles()[0].rsplit("/", 1)[0])
    query = (
        health_stream(rows, "event_time", "5 seconds").writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    scan_side = text[text.rindex("cnt_points"):] if "cnt_points" in text else text
    assert "SortAggregate" not in scan_side[scan_side.rindex("HashAggregate"):]
    assert text.count("StateStoreSave") == 2


def test_the_shuffled_lookup_shuffles(spark):
    text = plan(registry.queries()["lookup_join_shuffled"](spark, "/root/testdata/sf0.001"))
    join = next(line for line in text.splitlines() if "_salt" in line and "Join" in line)
    assert "SortMergeJoin" in join


def test_sizes_are_counted_where_the_rows_are(spark):
    from tidemark.functions.sizing import at_most

    df = spark.range(1000).repartition(4)
    assert at_most(df, 1000) and not at_most(df, 999)


def test_gold_of_dense_windows_combines_before_the_shuffle(spark, tables):
    text = plan(health(tables("silver"), size="1 day"))
    first = text[: text.rindex("Exchange hashpartitioning")]
    assert "partial_count(1)" in text[len(first):]
