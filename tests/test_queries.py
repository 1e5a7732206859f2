"""Every registered query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tallybook.oracles import ORACLES
from tallybook.queries import QUERIES

SAMPLE = "/root/testdata/sf0.001"
TABLES = ("events", "customer", "orders", "lineitem", "part")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SAMPLE}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, SAMPLE)
    columns = sorted(df.columns)
    result = sql.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = sorted((tuple(str(row[i]) for i in places) for row in result.fetchall()))
    found = sorted(tuple(str(row[column]) for column in columns) for row in df.collect())
    assert found == expected
    assert found


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "fecha", "monto", "tipo", "anomalia", "observacion"]
    ids = [row.id for row in df.collect()]
    assert ids and ids == sorted(ids)
