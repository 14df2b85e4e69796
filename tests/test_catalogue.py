"""Registered queries against their SQL at the smallest scale, and the shape of the catalogue."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, normal

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) >= 128


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, folder, name):
    df = QUERIES[name](spark, folder)
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(normal(v) for v in row) for row in result.fetchall())
    got = sorted(tuple(normal(row[c]) for c in columns) for row in df.collect())
    assert got == want


def test_entry(spark):
    assert {r.section for r in entry.entry(spark).collect()} == {"total", "risk", "vip"}
