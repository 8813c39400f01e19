"""Every query with SQL is compared with DuckDB; plans are checked for one-task and pairwise steps."""

import math

import duckdb
import pytest

from triagelake.operators import metrics, portfolio
from triagelake.plans.oracles import ORACLES
from triagelake.plans.queries import QUERIES
from triagelake.sources import testtables

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    columns = sorted(got.columns)
    place = [expected.columns.index(c) for c in columns]
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    theirs = sorted((tuple(plain(r[i]) for i in place) for r in expected.fetchall()), key=str)
    assert ours == theirs


ROW_LEVEL = ["small_bins_capacity", "small_bins_deciles", "small_bins_roc", "investigation_queue", "threshold_sweep", "stratified_split",
             "smote_rows", "numeric_describe", "scaled_features", "category_codes", "validation_records"]


# Tables below one bin need no bins; small bins show the plan of a large table.
CLAIMS = lambda spark: (testtables.core_claims(spark, FOLDER), "score", "label")
SMALL_BINS = {
    "small_bins_capacity": lambda spark: portfolio.capacity_summary(*CLAIMS(spark), "claim_id", rows_per_bin=100),
    "small_bins_deciles": lambda spark: portfolio.lift_by_decile(*CLAIMS(spark), "claim_id", rows_per_bin=100),
    "small_bins_roc": lambda spark: metrics.roc_points(*CLAIMS(spark), rows_per_bin=100),
}


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_plans_have_no_pairwise_or_one_task_step(spark, name):
    df = SMALL_BINS[name](spark) if name in SMALL_BINS else QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Window [") and "windowspecdefinition(specifiedwindowframe" in line:
            # A window without partition key may only run on a table of totals.
            below = next(x for x in lines[i + 1:] if not x.startswith(("Window", "Project", "Filter", "Generate")))
            assert below.startswith("Aggregate"), line
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["confusion"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_orderkey", "o_custkey", "o_orderpriority"}
