"""Every registered query against its SQL on the same tables, all rows compared."""

import math
import os
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from fiscalframe import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime) or (isinstance(value, date)):
        return value.isoformat()
    return value


def rows_by_column_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    sortable = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(sortable, key=repr)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, SF_DIR)
    # No operator needs rows dealt out evenly.
    assert "RoundRobin" not in got._jdf.queryExecution().executedPlan().toString()
    want = duck.sql(ORACLES[name])
    got_names, got_rows = rows_by_column_name(got.columns, got.collect())
    want_names, want_rows = rows_by_column_name(want.columns, want.fetchall())
    assert got_names == want_names
    assert len(got_rows) == len(want_rows)
    assert got_rows == want_rows
    assert got_rows, "an empty result proves nothing"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
