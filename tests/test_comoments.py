"""Blocked co-moments against NumPy on complete rows of each pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators.comoments import comoments, correlations, merge_comoments, shifts


def table_of(spark, values):
    names = [f"c.{i}" if i == 3 else f"c{i}" for i in range(values.shape[1])]
    rows = [[None if np.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)] for i, r in enumerate(values)]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).toDF(*[n.replace(".", "_") for n in names])


def expected(values, a, b):
    both = np.isfinite(values[:, a]) & np.isfinite(values[:, b])
    x, y = values[both, a], values[both, b]
    if len(x) < 2 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return len(x), None
    return len(x), np.corrcoef(x, y)[0, 1]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[:, 1] += 0.7 * x[:, 0]
    x[:, 2] = 1e9 + x[:, 0] * 1e-1 + rng.normal(size=900) * 1e-1  # a mean ten powers above the deviation
    x[:, 4] = 5.1  # constant
    x[:, 5] = np.nan  # never there
    x[rng.random((900, 8)) < 0.1] = np.nan
    x[:, 4] = 5.1
    x[7, 6] = np.inf
    x[:, 7] = np.nan
    x[3, 7] = 1.0  # once
    return x


def test_pairs_equal_numpy(spark, values):
    df = table_of(spark, values)
    got = correlations(comoments(df, df.columns, shifts(df, df.columns)), df.columns).collect()
    assert len(got) == 8 * 7 // 2
    for r in got:
        a, b = df.columns.index(r["feature_b"]), df.columns.index(r["feature_a"])
        n, value = expected(values, a, b)
        assert a < b and r["n"] == n
        assert (r["correlation"] is None) == (value is None)
        assert value is None or r["correlation"] == pytest.approx(value, abs=1e-6)


def test_parts_add_up(spark, values):
    df = table_of(spark, values).withColumn("i", F.monotonically_increasing_id())
    names = df.columns[:-1]
    at = shifts(df, names)
    parts = [comoments(df.where(F.col("i") % 3 == k), names, at) for k in range(3)]
    whole = {(r["a"], r["b"]): r for r in comoments(df, names, at).collect()}
    for r in merge_comoments(*parts).collect():
        w = whole[r["a"], r["b"]]
        assert r["n"] == w["n"] and r["p"] == pytest.approx(w["p"], abs=1e-9) and r["q"]["b"] == pytest.approx(w["q"]["b"], abs=1e-9)


def test_two_hundred_columns_in_one_short_plan(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 10)) @ rng.normal(size=(10, 200)) + rng.normal(size=(400, 200))
    df = spark.createDataFrame([r.tolist() for r in x], ", ".join(f"c{i} double" for i in range(200)))
    sums = comoments(df, df.columns, shifts(df, df.columns))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 1
    direct = np.corrcoef(x.T)
    got = {(int(r["feature_b"][1:]), int(r["feature_a"][1:])): r["correlation"] for r in correlations(sums, df.columns).collect()}
    assert len(got) == 200 * 199 // 2
    assert max(abs(got[a, b] - direct[a, b]) for a, b in got) < 1e-9


def test_empty_table(spark, values):
    df = table_of(spark, values).limit(0)
    got = correlations(comoments(df, df.columns, shifts(df, df.columns)), df.columns).collect()
    assert len(got) == 28 and {(r["n"], r["correlation"]) for r in got} == {(0, None)}
