"""Every query with SQL is compared with DuckDB."""

import duckdb
import pytest

from triagelake.llm.oracles import ORACLES
from triagelake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    columns = sorted(got.columns)
    place = [expected.columns.index(c) for c in columns]
    ours = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    theirs = sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=str)
    assert ours == theirs
