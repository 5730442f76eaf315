"""Every registered query against its SQL on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from areastats.registered import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 25
