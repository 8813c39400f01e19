"""Ranks, quantiles and running totals against brute force, with heavy ties and small bins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators import metrics, ordering, portfolio, queue


def tied_scores(spark, n=3000, seed=1):
    """A third of all rows share one score, another sixth a second one."""
    r = random.Random(seed)
    score = lambda i: 0.5 if i % 3 == 0 else 0.1 if i % 6 == 1 else round(r.random(), 3)
    ids = r.sample(range(10 * n), n)
    rows = [(ids[i], score(i), int(r.random() < 0.1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, s double, y int")


@pytest.mark.parametrize("rows_per_bin", [10**6, 50, 7])
def test_boundaries_match_brute_force(spark, rows_per_bin):
    rows, df = tied_scores(spark)
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r["percentage"]: r["fraud_selected"] for r in portfolio.capacity_summary(
        df, "s", "y", "id", (0.01, 1, 5, 33, 50, 100), rows_per_bin).collect()}
    expected = {float(p): sum(r[2] for r in ordered[: portfolio.top_k_count(len(rows), p)]) for p in (0.01, 1, 5, 33, 50, 100)}
    assert got == expected
    deciles = {r["decile"]: (r["claims"], r["fraud_cases"]) for r in portfolio.lift_by_decile(
        df, "s", "y", "id", rows_per_bin).collect()}
    brute = {d: [0, 0] for d in range(1, 11)}
    for i, r in enumerate(ordered, 1):
        d = math.ceil(i * 10 / len(rows))
        brute[d][0] += 1
        brute[d][1] += r[2]
    assert deciles == {d: tuple(v) for d, v in brute.items()}


def test_heavy_tie_is_cut_along_the_tie_break(spark):
    _, df = tied_scores(spark)
    keyed = df.select(ordering.descending("s").alias("key"), F.col("id").alias("tie"))
    cuts = ordering.find_cuts(keyed, "key", "tie", 50)
    largest = ordering.add_bins(keyed, cuts, "key", "tie").groupBy("bin", "tie_bin").count().agg(F.max("count")).first()[0]
    assert -0.5 in cuts.heavy and largest <= 200


@pytest.mark.parametrize("rows_per_bin", [10**6, 20])
def test_quantiles(spark, rows_per_bin):
    r = random.Random(2)
    values = {g: [r.choice([1.0, 2.0, r.gauss(0, 50)]) for _ in range(n)] for g, n in (("a", 999), ("b", 4), ("c", 1))}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("a", None), ("a", float("nan"))], "g string, v double")
    got = {x["g"]: x["q"] for x in ordering.quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0], rows_per_bin).collect()}
    for g, vs in values.items():
        for p in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert got[g][p] == pytest.approx(np.quantile(vs, p), abs=1e-9)


def test_global_rank(spark):
    rows, df = tied_scores(spark, 2000, 3)
    ranked = {r["id"]: r["rank"] for r in ordering.global_rank(df, [F.desc("s"), F.asc("id")], partitions=7).collect()}
    assert ranked == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert ordering.global_rank(df.limit(0), [F.asc("id")]).count() == 0


@pytest.mark.parametrize("rows_per_bin", [10**6, 25])
def test_curve_areas(spark, rows_per_bin):
    rows, df = tied_scores(spark, 1500, 4)
    pos = [r[1] for r in rows if r[2]]
    neg = [r[1] for r in rows if not r[2]]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    area, seen, hits, last = 0.0, 0, 0, 0
    for s in sorted({r[1] for r in rows}, reverse=True):
        seen += sum(r[1] == s for r in rows)
        hits += sum(r[1] == s and r[2] for r in rows)
        area += (hits - last) / len(pos) * hits / seen
        last = hits
    got = metrics.ranking_metrics(df, "s", "y", None, rows_per_bin).first()
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12) and got["pr_auc"] == pytest.approx(area, abs=1e-12)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    assert metrics.ranking_metrics(df, "s", "y").first()["roc_auc"] is None


def test_nan_scores_rank_last(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.1), (3, None), (4, 0.9)], "id long, s double")
    assert [r["id"] for r in queue.top_share_rows(df, "s", "id", 50).orderBy("rank").collect()] == [4, 2]
