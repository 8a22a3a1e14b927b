"""Every registered query against its SQL twin, over the smallest tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = db.sql(sql)
    assert sorted(want.columns) == sorted(df.columns)
    assert got == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
