"""The projection index against brute force and the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators.neighbour_index import ProjectionTrees, approximate_neighbours, fit_trees, recall
from triagelake.operators.neighbours import nearest_neighbours
from triagelake.operators.resample import oversampler


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")


def test_buckets_are_even_and_probes_are_others():
    x = np.random.default_rng(1).normal(size=(4000, 6))
    model = fit_trees(x, 3, 5)
    own, near = model.paths(x, 4)
    for t in range(3):
        sizes = np.bincount(own[:, t], minlength=model.buckets)
        assert sizes.min() > 60 and sizes.max() < 190  # 125 each where medians are exact
        assert (near[:, t] != own[:, t, None]).all()
    # The probe of a turn is the bucket of the point moved across its cut.
    tree = ProjectionTrees(np.array([[[1.0, 0.0], [0.0, 1.0]]]), np.array([[0.0, 0.0, 5.0]]))
    own, near = tree.paths(np.array([[-0.1, 1.0]]), 2)
    assert own[0, 0] == 1 and near[0, 0].tolist() == [2, 0]


@pytest.mark.parametrize("dims, least", [(4, 0.97), (29, 0.9)])
def test_recall(spark, dims, least):
    rng = np.random.default_rng(dims)
    centres = rng.normal(scale=3, size=(40, dims))
    x = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, dims))
    df = points(spark, x)
    exact = nearest_neighbours(df, "id", "vec", 5)
    found = approximate_neighbours(df, "id", "vec", 5, bucket_rows=400)
    got = recall(exact, found).first()[0]
    assert got >= least, got
    for r in found.limit(200).collect():
        assert len(r["neighbours"]) == 5 and r["id"] not in [n["id"] for n in r["neighbours"]]
        for n in r["neighbours"]:
            assert n["distance"] == pytest.approx(float(((x[r["id"]] - x[n["id"]]) ** 2).sum()), abs=1e-8)
        assert [(n["distance"], n["id"]) for n in r["neighbours"]] == sorted((n["distance"], n["id"]) for n in r["neighbours"])


def test_one_bucket_is_the_exact_search_even_in_blocks(spark):
    x = np.random.default_rng(5).integers(0, 6, size=(700, 3))  # many copies and ties
    df = points(spark, x)
    rows = lambda f: {r["id"]: [(n["distance"], n["id"]) for n in r["neighbours"]] for r in f.collect()}
    exact = rows(nearest_neighbours(df, "id", "vec", 4))
    assert rows(approximate_neighbours(df, "id", "vec", 4, trees=1, bucket_rows=10_000)) == exact
    assert rows(approximate_neighbours(df, "id", "vec", 4, trees=1, bucket_rows=10_000, block_rows=37)) == exact


def test_hot_vector_and_small_tables(spark):
    x = np.concatenate([np.zeros((2000, 2)), np.random.default_rng(6).normal(size=(1000, 2))])
    found = approximate_neighbours(points(spark, x), "id", "vec", 3, bucket_rows=100)
    hot = [r for r in found.collect() if r["id"] < 2000]
    assert len(hot) == 2000 and all(n["distance"] == 0 for r in hot for n in r["neighbours"])
    assert [len(r["neighbours"]) for r in approximate_neighbours(points(spark, [[1.0]]), "id", "vec", 3).collect()] == [0]
    with pytest.raises(ValueError, match="no points"):
        approximate_neighbours(points(spark, [[1.0]]).limit(0), "id", "vec")


def test_oversampling_beyond_the_exact_size_uses_the_index(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, int(i % 4 == 0), *map(float, rng.normal(size=3))) for i in range(400)], "id long, y int, a double, b double, c double")
    exact, index = (oversampler(df, ["a", "b", "c"], "y", "id", exact_rows=n) for n in (1000, 10))
    rows = lambda o: sorted(map(tuple, o.synthetic(0.8).collect()))
    assert rows(index) == rows(exact)  # one bucket holds all
    small, large = ({(r["base_id"], r["copy"]) for r in exact.synthetic(q).collect()} for q in (0.5, 0.9))
    assert small < large
    assert exact.oversampled(0.8).where(F.col("y") == 1).count() == int(0.8 * 300)
