"""Cells of the exact neighbour search: few stay open, and what they leave out changes nothing."""

import numpy as np
from pyspark.sql import functions as F

from triagelake.operators import neighbours, resample
from triagelake.operators.neighbour_index import approximate_neighbours


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")


def brute(x, k):
    gaps = np.zeros((len(x), len(x)))
    for d in range(x.shape[1]):
        gaps += (x[:, d, None] - x[None, :, d]) ** 2
    gaps = np.round(gaps, neighbours.DIGITS)
    return {a: [int(b) for b in np.lexsort((np.arange(len(x)), gaps[a])) if b != a][:k] for a in range(len(x))}


def lists(found):
    return {r["id"]: [n["id"] for n in r["neighbours"]] for r in found.collect()}


def coded(rows):
    """Standardised codes as the claims have them: many features of few values, some rare."""
    draw = np.random.default_rng(11)
    x = np.column_stack([draw.random(rows) < p for p in (0.05, 0.1, 0.15, 0.25, 0.3, 0.5)] + [draw.integers(0, n, rows) for n in (3, 4, 5, 7, 12, 19)])
    return (x - x.mean(axis=0)) / x.std(axis=0)


def test_a_search_visits_few_points(spark, monkeypatch):
    """Distances per point must not grow with the number of points; with cells around pivots nearly all cells stayed open."""
    share, search = [], neighbours._search

    def counted(queries, cells, sizes, k, block_rows):
        per_cell = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
        share.append(sum(n * sizes[c] for c, n in per_cell.items()) / sum(sizes.values()) ** 2)
        return search(queries, cells, sizes, k, block_rows)

    monkeypatch.setattr(neighbours, "_search", counted)
    x = coded(4000)
    assert lists(neighbours.nearest_neighbours(points(spark, x), "id", "vec", 5, 100)) == brute(x, 5)
    assert len(share) == 2 and sum(share) < 0.3, share


def test_many_open_cells_make_larger_ones(spark, monkeypatch):
    calls, fit = [], neighbours.fit_cells
    monkeypatch.setattr(neighbours, "fit_cells", lambda sample, n: calls.append(n) or fit(sample, n))
    x = np.random.default_rng(3).normal(size=(1500, 20))  # no cell is far from anything
    assert lists(neighbours.nearest_neighbours(points(spark, x), "id", "vec", 4, 30)) == brute(x, 4)
    assert calls == [50, 5]


def test_only_numbers_leave_a_search_task(spark):
    asking = points(spark, [[0.0], [1.0]]).select("id", "vec", F.lit(0).alias("cell"), F.col("id").alias("pid"), F.lit(None).cast("double").alias("limit"))
    held = asking.select("cell", "pid", "vec", (F.col("id") + 7).alias("num"))
    found = neighbours.search_groups(asking, held, ["cell"], 1, 3)
    assert sorted(map(tuple, found.collect())) == [(0, 1.0, 1, 8), (1, 1.0, 0, 7)]


def test_block_best_by_definition():
    x = np.random.default_rng(4).integers(0, 5, size=(900, 3)).astype(float)  # many equal distances
    who = np.arange(900)
    gaps = np.round(((x[:, None] - x[None]) ** 2).sum(axis=2), neighbours.DIGITS)
    gaps[who, who] = np.inf
    limit = np.where(who % 3 == 0, 1.0, np.inf)
    q, p, d = neighbours.block_best(x, who, x, who, 4, limit)
    for a in range(900):
        near = [b for b in np.lexsort((who, gaps[a])) if np.isfinite(gaps[a, b]) and gaps[a, b] <= limit[a]][:4]
        got = p[q == a].tolist()
        assert got[:len(near)] == near and (d[q == a] == gaps[a, got]).all()
    x[7, 1] = np.nan
    assert [len(v) for v in neighbours.block_best(x, who, x, who, 4)] == [0, 0, 0]  # as before


def test_index_gives_the_exact_lists_on_coded_points(spark):
    x = coded(1500)
    found = lists(approximate_neighbours(points(spark, x), "id", "vec", 5, trees=6, probes=3, bucket_rows=400))
    exact = brute(x, 5)
    assert sum(len(set(found[a]) & set(exact[a])) for a in exact) >= 0.9 * 5 * len(x)


def test_oversampling_is_exact_for_any_number_of_rows(spark, monkeypatch):
    """Beyond 2,000,000 minority rows the approximate index used to take the place of the search."""
    asked = []

    def exact(points, *_):
        asked.append(points.count())
        return points.limit(0)

    monkeypatch.setattr(resample, "nearest_neighbours", exact)
    df = spark.range(2_000_010).selectExpr("id", "int(id < 2000005) AS y", "double(id % 7) AS a")
    resample.oversampler(df, ["a"], "y", "id")
    assert asked == [2_000_005]


def test_leaves_of_a_block_leave_out_nothing():
    """Ties, copies, ids that are no part of the block, limits and a missing coordinate: the same lists, far fewer pairs."""
    draw = np.random.default_rng(8)
    x = coded(3000)
    x[draw.integers(0, 3000, 200)] = x[5]
    who, asker = np.arange(3000) * 2, np.arange(0, 4000, 3)
    here = np.concatenate([x[draw.integers(0, 3000, 1200)], x[:len(asker) - 1200] + 0.1])
    here[3, 2] = np.nan
    for limit in (np.full(len(asker), np.inf), np.where(asker % 2 == 0, 2.0, np.inf)):
        best = lambda f, **kw: list(zip(*(v.tolist() for v in f(here, asker, x, who, 5, limit, **kw))))
        exact, fast = best(neighbours.block_best), best(neighbours.leaf_best, leaf_rows=64)
        near = lambda found: [f for f in found if f[2] <= limit[f[0]]]
        assert near(fast) == near(exact)


def test_a_block_is_measured_in_few_leaves(monkeypatch):
    pairs, measure = [], neighbours.block_best
    monkeypatch.setattr(neighbours, "block_best", lambda here, asker, there, *a: pairs.append(len(here) * len(there)) or measure(here, asker, there, *a))
    x, who = coded(8000), np.arange(8000)
    neighbours.leaf_best(x, who, x, who, 5, np.full(8000, np.inf), leaf_rows=64)
    assert sum(pairs) < 0.3 * 8000 ** 2, sum(pairs) / 8000 ** 2
