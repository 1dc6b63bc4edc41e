"""All queries of the order business against their reference SQL at the smallest scale."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from parcelworks.plans.oracle import ORACLE
from parcelworks.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    got = entry_points.entry(spark)
    assert got.columns == ["final_status", "n_lines", "units", "value"]
    assert got.count() > 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, str(FOLDER))
    cursor = database.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    want = _sorted(cursor.fetchall(), columns)
    assert sorted(df.columns) == sorted(columns)
    assert _sorted([tuple(r) for r in df.collect()], df.columns) == want
