"""Approximate k nearest neighbours through an index of projection buckets.

A tree cuts space by random directions: at each level a point goes left or right of the median
of its projection, so a path of ``depth`` turns names a bucket of about ``bucket_rows`` points.
Several trees with other directions give each point several buckets. A point searches its own
bucket in every tree and the ``probes`` buckets that it missed by the smallest margins
(multi-probe); whatever is found there is measured exactly and ranked by the same rule as the
exact search. So an answer is wrong only where a true neighbour shares none of those buckets,
and every distance in the result is exact.

The cuts are medians of a bounded sample (``SAMPLE`` points, the smallest in hash order), so the
model is small; every point is indexed. A bucket that comes out too large is cut into blocks and
its visitors into slices, and only numbers of the best k per visitor and block leave a task. Own
buckets come first; their k-th distance bounds what the visited ones may send. Work and shuffle
grow in proportion to points * trees * (1 + probes). Beyond ``SAMPLE / 16`` buckets they grow
larger instead of more. Copies of a point are folded first, so a hot vector is one row.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .neighbours import best_k, fold_copies, kth_distance, search_groups, stacked, task_count, with_copies
from .split import SEED

TREES, PROBES = 8, 4
BUCKET_ROWS, BLOCK_ROWS = 2_000, 8_000
SAMPLE = 65_536

# Task-side helpers travel with the job instead of being imported on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ProjectionTrees:
    """Directions (trees x depth x dimensions) and medians (trees x inner nodes, heap order)."""

    directions: np.ndarray
    cuts: np.ndarray

    @property
    def buckets(self) -> int:
        return 1 << self.directions.shape[1]

    def paths(self, vectors: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """Own bucket (rows x trees) and the buckets on the other side of the closest turns (rows x trees x probes)."""
        trees, depth, _ = self.directions.shape
        probes = min(probes, depth)
        own = np.zeros((len(vectors), trees), np.int64)
        near = np.zeros((len(vectors), trees, probes), np.int64)
        for t in range(trees):
            seen = vectors @ self.directions[t].T
            margin = np.empty((len(vectors), depth))
            node = np.zeros(len(vectors), np.int64)
            for level in range(depth):
                margin[:, level] = seen[:, level] - self.cuts[t, (1 << level) - 1 + node]
                node = 2 * node + (margin[:, level] > 0)
            own[:, t] = node
            closest = np.argsort(np.abs(margin), axis=1)[:, :probes]
            for j in range(probes):
                near[:, t, j] = self._other_side(t, seen, node, closest[:, j])
        return own, near

    def _other_side(self, t: int, seen: np.ndarray, node: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """The bucket reached when one turn is taken the other way and all later ones by the point's own projections."""
        depth = self.directions.shape[1]
        at = np.zeros(len(node), np.int64)
        for level in range(depth):
            taken = (node >> (depth - 1 - level)) & 1
            there = seen[:, level] > self.cuts[t, (1 << level) - 1 + at]
            at = 2 * at + np.where(level < turn, taken, np.where(level == turn, 1 - taken, there))
        return at


def fit_trees(sample: np.ndarray, trees: int, depth: int, seed: int = SEED) -> ProjectionTrees:
    """Random directions with the sample's medians as cuts; an empty node cuts at 0."""
    draw = np.random.default_rng(seed)
    directions = draw.normal(size=(trees, depth, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts = np.zeros((trees, (1 << depth) - 1 if depth else 1))
    for t in range(trees):
        seen, node = sample @ directions[t].T, np.zeros(len(sample), np.int64)
        for level in range(depth):
            order = np.argsort(node, kind="stable")
            edges = np.searchsorted(node[order], np.arange((1 << level) + 1))
            for k in range(1 << level):
                rows = order[edges[k]:edges[k + 1]]
                if len(rows):
                    cuts[t, (1 << level) - 1 + k] = np.median(seen[rows, level])
            node = 2 * node + (seen[:, level] > cuts[t, (1 << level) - 1 + node])
    return ProjectionTrees(directions, cuts)


def _with_buckets(folded: DataFrame, model: ProjectionTrees, probes: int) -> DataFrame:
    """pid, vec, num and the numbers of the own bucket and of the visited ones, over all trees."""
    first = np.arange(model.directions.shape[0]) * model.buckets

    @F.pandas_udf("own array<int>, near array<int>")
    def place(vec: pd.Series) -> pd.DataFrame:
        own, near = model.paths(stacked(vec), probes)
        near = (near + first[None, :, None]).reshape(len(own), -1)
        return pd.DataFrame({"own": list((own + first).astype("int32")), "near": list(near.astype("int32"))})

    return folded.withColumn("b", place("vec")).select("pid", "vec", "num", "b.own", "b.near")


def approximate_neighbours(df: DataFrame, row_id: str, vector: str, k: int = 5, trees: int = TREES, probes: int = PROBES,
                           bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """(id, vec, neighbours) like ``nearest_neighbours``; a row may get fewer than k entries where its buckets hold fewer."""
    points = df.select(F.col(row_id).alias("id"), F.col(vector).alias("vec"))
    folded = stage(fold_copies(points, k), "points")
    total = folded.count()
    if not total:
        raise ValueError("no points to search")
    rows = folded.orderBy(F.xxhash64("vec"), "pid").limit(SAMPLE).select("vec").toPandas()
    depth = max(0, math.ceil(math.log2(max(1.0, min(total / bucket_rows, SAMPLE / 16)))))
    model = fit_trees(stacked(rows["vec"]), trees, depth, seed)
    placed = stage(_with_buckets(folded, model, probes), "buckets")
    held = placed.select(F.explode("own").alias("bucket"), "pid", "vec", "num")

    def search(asking: DataFrame) -> DataFrame:
        """Candidates from the buckets that ``asking`` (bucket, pid, vec, limit) names; one found in several counts once."""
        rows = lambda df, name: df.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
        cut = rows(held, "points").join(rows(asking, "visitors"), "bucket")
        cut = cut.withColumns({"blocks": F.ceil(F.col("points") / block_rows), "slices": F.ceil(F.col("visitors") / (block_rows * (1 + probes)))})
        cut = stage(cut, "bucket-sizes")
        size = cut.agg(F.coalesce(F.expr("sum(points * slices + visitors * blocks)"), F.lit(0)).alias("rows"),
                       F.coalesce(F.expr("sum(blocks * slices)"), F.lit(0)).alias("groups")).first()
        cut = cut.drop("points", "visitors")
        # Points repeat once per slice of visitors and visitors once per block of the bucket.
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        there = held.join(cut, "bucket").withColumn("slice", upto("slices")).withColumn("block", F.pmod(F.xxhash64("pid", "vec"), "blocks"))
        asked = asking.join(cut, "bucket").withColumn("block", upto("blocks")).withColumn("slice", F.pmod(F.xxhash64("pid", "vec", F.lit(1)), "slices"))
        key = ["bucket", "block", "slice"]
        tasks = task_count(df.sparkSession, size["rows"], size["groups"])
        return search_groups(asked.select(*key, "pid", "vec", "limit"), there.select(*key, "pid", "vec", "num"), key, k, tasks).distinct()

    first = stage(best_k(search(placed.select(F.explode("own").alias("bucket"), "pid", "vec", F.lit(None).cast("double").alias("limit"))), k), "near")
    others = placed.join(kth_distance(first, k), "pid", "left").select(F.explode(F.array_except("near", "own")).alias("bucket"), "pid", "vec", "limit")
    return with_copies(points, folded, best_k(first.unionByName(search(others)).distinct(), k), k)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """One row: share of the exact neighbours that the approximate lists hold."""
    ids = lambda df, name: df.select("id", F.transform("neighbours", lambda n: n["id"]).alias(name))
    both = ids(exact, "e").join(ids(approximate, "a"), "id", "left")
    hit = F.coalesce(F.size(F.array_intersect("e", "a")), F.lit(0))
    return both.agg((F.sum(hit) / F.sum(F.size("e"))).alias("recall"))
