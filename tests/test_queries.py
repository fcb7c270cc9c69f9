"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import oracles, registry

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


# One row per flush of one table is numbered in order.
ONE_TASK = {"flush_lag"}


def single_partition_inputs(plan: str) -> list[str]:
    """What feeds each exchange into one partition."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    theirs = con.sql(SQL[name])
    assert sorted(theirs.columns) == columns
    expected = Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("Cartesian", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert costly not in plan
    if name not in ONE_TASK:
        for fed_by in single_partition_inputs(plan):
            # A row per task, or a report's few rows.
            assert "partial_" in fed_by or "Aggregate(keys=[], functions=[])" in fed_by or "LocalLimit 5" in fed_by, plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["device_id", "anomalies", "worst_temp"]
    assert df.count() > 0
