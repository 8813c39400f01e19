"""Mergeable profiles against exact counts, one pass over all rows and several rounds of merging."""

import random

import pytest
from pyspark.sql import functions as F

from triagelake.operators.profile_sketches import merge_sketches, read_sketches, sketch_parts
from triagelake.session import stage

SCHEMA = "day int, amount double, flat int, none double, word string, rare string"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for k in range(30_000):
        day = 0 if k % 3 else rng.randrange(1, 12)  # one part holds two thirds
        amount = None if k % 50 == 0 else float("nan") if k % 50 == 1 else rng.paretovariate(1.2)
        word = None if k % 10 == 0 else f"w{min(int(rng.expovariate(0.2)), 60)}"
        rows.append((day, amount, 7, None, word, f"r{rng.randrange(20_000)}"))
    return spark.createDataFrame(rows, SCHEMA).cache()


NUMERIC, CATEGORICAL = ["amount", "flat", "none"], ["word", "rare"]


def profile_of(sketches):
    return {r["feature"]: r for r in read_sketches(sketches, [0.01, 0.25, 0.5, 0.75, 0.99]).collect()}


def test_merged_parts_within_the_bounds(spark, table):
    parts = stage(sketch_parts(table, F.col("day"), NUMERIC, CATEGORICAL), "test-sketches")
    assert parts.count() == 12 * 5
    # Merged at once and in two rounds (a part merged of parts is a part).
    once, twice = profile_of(merge_sketches(parts)), profile_of(merge_sketches(merge_sketches(parts, F.col("part") % 3)))
    whole = profile_of(merge_sketches(sketch_parts(table, F.lit(0), NUMERIC, CATEGORICAL)))
    good = sorted(r[0] for r in table.where("amount IS NOT NULL AND NOT isnan(amount)").select("amount").collect())
    for got in (once, twice, whole):
        assert (got["amount"]["rows"], got["amount"]["missing"]) == (30_000, 30_000 - len(good))
        assert (got["amount"]["low"], got["amount"]["high"]) == (good[0], good[-1])
        for p, q in zip([0.01, 0.25, 0.5, 0.75, 0.99], got["amount"]["quantiles"]):
            assert abs(sum(v <= q for v in good) / len(good) - p) < 0.02
        for name, column in (("word", "word"), ("rare", "rare")):
            exact = table.where(F.col(column).isNotNull()).select(column).distinct().count()
            assert abs(got[name]["distinct_values"] - exact) <= max(1, 0.05 * exact)
        counts = table.where("word IS NOT NULL").groupBy("word").count().orderBy(F.desc("count"), "word").limit(8).collect()
        assert [tuple(x) for x in got["word"]["frequent"]] == [tuple(r) for r in counts]
        assert got["word"]["missing"] == 3000 and got["word"]["quantiles"] is None and got["amount"]["frequent"] is None
        assert got["none"]["missing"] == 30_000 and got["none"]["distinct_values"] == 0 and got["none"]["quantiles"] is None
        assert got["flat"]["distinct_values"] == 1 and set(got["flat"]["quantiles"]) == {7.0}
    # The same registers, however the parts were cut.
    assert all(once[c]["distinct_values"] == whole[c]["distinct_values"] == twice[c]["distinct_values"] for c in once)


def test_appended_part_equals_a_new_profile(spark, table):
    old = stage(sketch_parts(table.where("day < 9"), F.col("day"), NUMERIC, CATEGORICAL), "test-sketches")
    new = sketch_parts(table.where("day >= 9"), F.col("day"), NUMERIC, CATEGORICAL)
    got = profile_of(merge_sketches(old.unionByName(new)))
    full = profile_of(merge_sketches(sketch_parts(table, F.col("day"), NUMERIC, CATEGORICAL)))
    for c in full:
        assert [got[c][k] for k in ("rows", "missing", "low", "high", "distinct_values", "frequent")] == [
            full[c][k] for k in ("rows", "missing", "low", "high", "distinct_values", "frequent")] or c == "rare"


def test_empty_table_null_part_and_repeated_names(spark, table):
    assert merge_sketches(sketch_parts(table.limit(0), F.col("day"), NUMERIC, CATEGORICAL)).count() == 0
    nulls = sketch_parts(table.limit(5), F.lit(None).cast("int"), ["flat"], [])
    assert [(r["part"], r["rows"]) for r in nulls.collect()] == [(None, 5)]
    with pytest.raises(ValueError):
        sketch_parts(table, F.col("day"), ["flat"], ["flat"])


def test_one_pass_without_row_expansion(spark, table):
    plan = sketch_parts(table, F.col("day"), NUMERIC, CATEGORICAL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # map-side sketches, one row per part and task is sent
