"""Exact k nearest neighbours inside one set of points, without a cross join.

Points are spread over cells: the leaves of a tree of cuts along single features, each cut
where it takes away most of the variance. Every point is compared with its own cell first; the
k-th distance found there bounds the search, and only cells whose box (smallest and largest
value of each feature) comes as close are visited afterwards, with that bound. The tree is
fitted on a bounded sample; it steers work, never results. Where many cells stay open, points
are dealt to fewer, larger ones, so that visits do not outgrow the comparisons they save.
Large cells are cut into blocks and their visitors into slices, so a task never holds more than
two bounded blocks. In a task the block is cut by a tree of its own into leaves of a few hundred
points, and only leaves whose box comes near are measured, the nearest first. Only numbers of the best k candidates per point and block leave a task;
their vectors are joined once at the end. Identical points are folded before the search: of any
group of copies only the k + 1 smallest ids can be somebody's neighbour.

Order of neighbours: squared distance (summed from the first feature to the last,
rounded to nine digits), then id.
"""

from __future__ import annotations

import heapq
import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..session import stage

DIGITS = 9
POINTS_PER_CELL = 20_000
BLOCK_ROWS = 40_000
MAX_CELLS = 1024
#: Sampled points per cell, from which the cuts are made.
SAMPLE_PER_CELL = 64
#: Visits per point beyond which cells are made COARSER times as large.
MOST_VISITS, COARSER = 24, 10
#: Rows that a task of the search reads, on the average.
TASK_ROWS = 100_000
SLACK = 1e-6
#: Points per leaf within a block, and the leaves that are measured first for a bound.
LEAF_ROWS, NEAREST_LEAVES = 256, 3

# The helpers below run in tasks: ship their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _squared_pairs(left: np.ndarray, right: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances of selected pairs, adding features in a fixed order."""
    total = np.zeros(len(rows))
    for d in range(left.shape[1]):
        gap = left[rows, d] - right[others, d]
        total += gap * gap
    return total


def block_best(here: np.ndarray, asker: np.ndarray, there: np.ndarray, who: np.ndarray, k: int,
               limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in here, place in there, distance) of the best k points for each query, itself left out.

    ``who`` is sorted, so equal distances keep the order of ids. Points beyond a query's ``limit``
    (a squared distance) are of no interest and may be left out. A block with a missing
    coordinate has no best points.
    """
    if np.isnan(there).any():
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    step = max(1, 1_000_000 // len(there))
    norms, itself = np.einsum("ij,ij->i", there, there), np.isin(asker, who)
    right = np.concatenate([there.T, np.ones((1, len(there))), norms[None, :]])
    # The k-th smallest of minima over disjoint groups of points is no smaller than the k-th distance.
    width = max(1, len(there) // (16 * k))
    groups = len(there) // width
    picked_q, picked_p, picked_d = [], [], []
    for start in range(0, len(here), step):
        part = here[start:start + step]
        sizes = np.einsum("ij,ij->i", part, part)[:, None]
        rough = np.concatenate([-2 * part, sizes, np.ones_like(sizes)], axis=1) @ right
        own = np.flatnonzero(itself[start:start + step])
        if len(own):
            rows, places = np.nonzero(asker[start + own, None] == who[None, :])
            rough[own[rows], places] = np.inf
        # The product form is fast but rounds differently: it only preselects, with room
        # for its error, and the selected pairs are measured again feature by feature.
        room = 1e-8 + 1e-13 * part.shape[1] * (sizes[:, 0] + norms.max())
        least = rough[:, :groups * width].reshape(len(part), width, groups).min(axis=1)
        most = np.partition(least, min(k, groups) - 1, axis=1)[:, min(k, groups) - 1] if groups >= k else np.full(len(part), np.inf)
        if limit is not None:
            most = np.minimum(most, limit[start:start + step])
        q, p = np.divmod(np.flatnonzero(rough <= (most + room)[:, None]), len(there))
        finite = np.isfinite(rough[q, p])
        q, p = q[finite], p[finite]
        d = np.round(_squared_pairs(part, there, q, p), DIGITS)
        order = np.lexsort((p, d, q))  # p follows the id order
        q, p, d = q[order], p[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        picked_q.append(q[keep] + start), picked_p.append(p[keep]), picked_d.append(d[keep])
    return np.concatenate(picked_q), np.concatenate(picked_p), np.concatenate(picked_d)


def box_bounds(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest squared distance that a point of each box can have from each row of ``x``."""
    out, step = np.empty((len(x), len(low))), max(1, 200_000 // len(low))
    for start in range(0, len(x), step):
        part = x[start:start + step]
        lower = np.zeros((len(part), len(low)))
        for d in range(x.shape[1]):
            here = part[:, d, None]
            gap = np.maximum(np.maximum(low[None, :, d] - here, here - high[None, :, d]), 0.0)
            lower += gap * gap
        out[start:start + step] = lower
    return out


def leaf_best(here: np.ndarray, asker: np.ndarray, there: np.ndarray, who: np.ndarray, k: int, limit: np.ndarray,
              leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``block_best``, measuring only leaves of a tree over ``there`` that may hold one of the best."""
    leaves = len(there) // leaf_rows
    if leaves <= NEAREST_LEAVES or np.isnan(there).any():
        return block_best(here, asker, there, who, k, limit)
    place = fit_cells(there[::max(1, leaf_rows // 16)], leaves).place(there)
    order = np.argsort(place, kind="stable")  # ids stay in order within a leaf
    starts = np.flatnonzero(np.diff(place[order], prepend=-1))
    ends, points, ids = np.append(starts[1:], len(order)), there[order], who[order]
    low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
    step, out = max(1, 4_000_000 // len(starts)), []
    for start in range(0, len(here), step):
        part, asks, most = (v[start:start + step] for v in (here, asker, limit))
        bounds = box_bounds(part, low, high)

        def measured(visits: np.ndarray, most: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
            for leaf in np.flatnonzero(visits.any(axis=0)):
                rows, span = np.flatnonzero(visits[:, leaf]), slice(starts[leaf], ends[leaf])
                q, p, d = block_best(part[rows], asks[rows], points[span], ids[span], k, most[rows])
                found.append((rows[q], order[span][p], d))
            return found

        first = np.zeros(bounds.shape, bool)
        nearest = np.argpartition(bounds, min(NEAREST_LEAVES, len(starts)) - 1, axis=1)[:, :NEAREST_LEAVES]
        np.put_along_axis(first, nearest, True, axis=1)
        near = measured(first & (bounds <= most[:, None] + SLACK), most)
        q, _, d = _ranked(near, k)
        size = np.bincount(q, minlength=len(part))
        full = np.flatnonzero(size >= k)
        most = most.copy()
        most[full] = np.minimum(most[full], d[np.cumsum(size)[full] - 1])
        q, p, d = _ranked(near + measured(~first & (bounds <= most[:, None] + SLACK), most), k)
        out.append((q + start, p, d))
    return tuple(np.concatenate(v) for v in zip(*out))


def _ranked(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of several results of ``block_best`` for each query."""
    q, p, d = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((p, d, q))
    q, p, d = q[order], p[order], d[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], p[keep], d[keep]


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def fold_copies(points: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with its k + 1 smallest ids and a number (to be written before it is used)."""
    # The partial window limit keeps k + 1 rows per vector and task before the shuffle.
    first = F.row_number().over(W.partitionBy("vec").orderBy("id"))
    few = points.withColumn("r", first).filter(F.col("r") <= k + 1)
    folded = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return folded.select("vec", "ids", F.element_at("ids", 1).alias("pid"), F.monotonically_increasing_id().alias("num"))


@dataclass(frozen=True)
class CellTree:
    """Cuts in node order: a point beyond ``cut`` on ``axis`` goes to ``right``; a leaf has axis -1 and a cell number."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cell: np.ndarray

    def place(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), np.int64)
        while len(inner := np.flatnonzero(self.axis[node] >= 0)):
            at = node[inner]
            node[inner] = np.where(vectors[inner, self.axis[at]] > self.cut[at], self.right[at], self.left[at])
        return self.cell[node]


def _best_cut(rows: np.ndarray) -> tuple[int, float] | None:
    """(axis, value) of the cut that leaves the least variance in its two halves; None for copies of one point."""
    best, n, below = (0.0, 0, 0.0), len(rows), np.arange(1, len(rows))
    for a in range(rows.shape[1]):
        values = np.sort(rows[:, a])
        if n < 2 or not values[0] < values[-1]:
            continue
        sums = np.cumsum(values - values.mean())[:-1]
        gain = np.where(values[1:] > values[:-1], sums * sums / (below * (n - below)), 0.0)
        at = int(gain.argmax())
        middle = (values[at] + values[at + 1]) / 2
        if gain[at] > best[0]:
            best = (gain[at], a, middle if middle < values[at + 1] else values[at])
    return best[1:] if best[0] > 0 else None


def fit_cells(sample: np.ndarray, n_cells: int) -> CellTree:
    """At most ``n_cells`` leaves; the leaf with most points of the sample is cut next."""
    sample = sample[~np.isnan(sample).any(axis=1)]
    axis, cut, left, right, leaves = [-1], [0.0], [0], [0], 1
    heap = [(-len(sample), 0, sample)]
    while heap and leaves < n_cells:
        _, node, rows = heapq.heappop(heap)
        found = _best_cut(rows)
        if found is None:
            continue
        axis[node], cut[node] = found
        beyond = rows[:, axis[node]] > cut[node]
        left[node], right[node], leaves = len(axis), len(axis) + 1, leaves + 1
        for half in (rows[~beyond], rows[beyond]):
            heapq.heappush(heap, (-len(half), len(axis), half))
            axis.append(-1), cut.append(0.0), left.append(0), right.append(0)
    number = np.cumsum(np.array(axis) < 0) - 1
    return CellTree(*map(np.array, (axis, cut, left, right)), number)


def _with_cells(folded: DataFrame, tree: CellTree) -> DataFrame:
    @F.pandas_udf("int")
    def place(vec: pd.Series) -> pd.Series:
        return pd.Series(tree.place(stacked(vec)).astype("int32"))

    return folded.withColumn("cell", place("vec"))


def _boxes(cells: DataFrame, n_cells: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each feature in each cell; an empty box has no reach."""
    low, high = np.full((n_cells, dims), np.inf), np.full((n_cells, dims), -np.inf)
    value = F.nanvl("value", F.lit(None).cast("double"))  # NaN is no border
    for r in cells.select("cell", F.posexplode("vec").alias("axis", "value")).groupBy("cell", "axis").agg(
            F.min(value).alias("low"), F.max(value).alias("high")).where("low IS NOT NULL").collect():
        low[r["cell"], r["axis"]], high[r["cell"], r["axis"]] = r["low"], r["high"]
    return low, high


def task_count(spark: SparkSession, rows: int, groups: int) -> int:
    """Tasks of a search: as many as its rows need, no more than it has groups."""
    usual = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return max(1, min(groups, max(usual, math.ceil(rows / TASK_ROWS))))


def search_groups(asking: DataFrame, held: DataFrame, key: list[str], k: int, tasks: int) -> DataFrame:
    """(pid, distance, other, num): the best k of ``held`` (key, pid, vec, num) for each row of ``asking``
    (key, pid, vec, limit) within each group; those beyond the limit may be missing."""
    pid = asking.schema["pid"].dataType
    schema = T.StructType([T.StructField("pid", pid), T.StructField("distance", T.DoubleType()),
                           T.StructField("other", pid), T.StructField("num", T.LongType())])

    def best(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or there.empty:
            return pd.DataFrame({n: [] for n in ("pid", "distance", "other", "num")})
        there = there.sort_values("pid", ignore_index=True)
        who, asker = there["pid"].to_numpy(), asked["pid"].to_numpy()
        limit = asked["limit"].astype(float).fillna(np.inf).to_numpy()
        q, p, d = leaf_best(stacked(asked["vec"]), asker, stacked(there["vec"]), who, k, limit)
        return pd.DataFrame({"pid": asker[q], "distance": d, "other": who[p], "num": there["num"].to_numpy()[p]})

    # Both sides may come from one table: fresh columns tell them apart.
    asking, held = (x.toDF(*x.columns).repartition(tasks, *key) for x in (asking, held))
    return asking.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(best, schema)


def _search(queries: DataFrame, points: DataFrame, sizes: dict[int, int], k: int,
            block_rows: int) -> DataFrame:
    """Best k points per query within its target cell."""
    visits = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    visits = visits or {-1: 1}  # a literal map must not be empty
    blocks = {c: math.ceil(n / block_rows) for c, n in sizes.items()}
    slices = {c: math.ceil(n / block_rows) for c, n in visits.items()}
    literal = lambda table: F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    n_blocks = F.element_at(literal(blocks), F.col("cell"))
    n_slices = F.coalesce(F.try_element_at(literal(slices), F.col("cell")), F.lit(0))
    # Points repeat once per slice of visitors and queries once per block of the cell.
    right = points.select(
        "cell", F.pmod(F.xxhash64("vec"), n_blocks).cast("int").alias("block"), "pid", "vec", "num",
        F.explode(F.when(n_slices > 0, F.sequence(F.lit(0), n_slices - 1))).alias("slice"))
    left = queries.select(
        "cell", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"), "pid", "vec", "limit",
        F.pmod(F.xxhash64("pid", "vec"), n_slices).cast("int").alias("slice"))
    pairs = [(n, sizes.get(c, 0), blocks.get(c, 0), slices[c]) for c, n in visits.items()]
    tasks = task_count(queries.sparkSession, sum(n * b + size * s for n, size, b, s in pairs), sum(b * s for *_, b, s in pairs))
    return search_groups(left, right, ["cell", "block", "slice"], k, tasks)


def best_k(candidates: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("pid").orderBy("distance", "other"))
    return candidates.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def kth_distance(found: DataFrame, k: int) -> DataFrame:
    """(pid, limit): how far the k-th of the candidates is; null where there are fewer."""
    return found.groupBy("pid").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("limit"))


def _open_cells(cells: DataFrame, limits: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """pid, vec, limit and the other cells that may hold a point as close as the limit of the query."""

    @F.pandas_udf("array<int>")
    def open_cells(vec: pd.Series, own: pd.Series, limit: pd.Series) -> pd.Series:
        x, mine = stacked(vec), own.to_numpy()
        most = limit.astype(float).fillna(np.inf).to_numpy()
        lower = box_bounds(x, low, high)
        visit = (lower <= most[:, None] + SLACK) & np.isfinite(lower)
        visit[np.arange(len(lower)), mine] = False
        return pd.Series([np.flatnonzero(row).astype("int32") for row in visit])

    limited = cells.join(limits, "pid", "left")
    return limited.select("pid", "vec", "limit", open_cells("vec", "cell", "limit").alias("open"))


def nearest_neighbours(df: DataFrame, row_id: str, vector: str, k: int = 5,
                       points_per_cell: int = POINTS_PER_CELL, block_rows: int | None = None) -> DataFrame:
    """(id, neighbours) with exactly k entries (distance, id, vec) per row, nearest first.

    Needs at least k + 1 rows. ``distance`` is the squared Euclidean distance.
    """
    points = df.select(F.col(row_id).alias("id"), F.col(vector).alias("vec"))
    folded = stage(fold_copies(points, k), "points")
    total = folded.count()
    if not total:
        raise ValueError("no points to search")
    if block_rows is None:  # small sets are cut finer, so that all cores take part
        cores = df.sparkSession.sparkContext.defaultParallelism
        block_rows = min(BLOCK_ROWS, max(512, math.ceil(total / (2 * math.sqrt(cores)))))
    n_cells = min(MAX_CELLS, max(1, math.ceil(total / points_per_cell)))
    # A bounded number of points chosen by hash.
    every = max(1, total // (SAMPLE_PER_CELL * n_cells))
    sample = folded.where(F.pmod(F.xxhash64("vec"), F.lit(every)) == 0).select("vec").toPandas() if n_cells > 1 else []
    tree = fit_cells(stacked(sample["vec"]), n_cells) if len(sample) else fit_cells(np.empty((0, 1)), 1)
    n_cells = int(tree.cell.max()) + 1
    cells = stage(_with_cells(folded, tree), "cells") if n_cells > 1 else folded.withColumn("cell", F.lit(0))
    sizes = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = cells.select("pid", "vec", F.lit(None).cast("double").alias("limit"), "cell")
    found = best_k(_search(first, cells, sizes, k, block_rows), k)
    if len(sizes) > 1:
        found = stage(found, "near")
        opened = _open_cells(cells, kth_distance(found, k), *_boxes(cells, n_cells, len(sample["vec"].iloc[0])))
        opened = stage(opened, "open")
        if opened.agg(F.sum(F.size("open"))).first()[0] > MOST_VISITS * total:
            return nearest_neighbours(df, row_id, vector, k, points_per_cell * COARSER, block_rows)
        visits = opened.select("pid", "vec", "limit", F.explode("open").alias("cell"))
        found = best_k(found.unionByName(_search(visits, cells, sizes, k, block_rows)), k)
    return with_copies(points, folded, found, k)


def with_copies(points: DataFrame, folded: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(id, vec, neighbours) of all points from the best ``found`` for one of each group of copies."""
    held = folded.select("num", F.col("ids").alias("other_ids"), F.col("vec").alias("other_vec"))
    others = found.join(held, "num").groupBy("pid").agg(F.collect_list(F.struct("distance", "other_ids", "other_vec")).alias("o"))
    entry = lambda d, i, v: F.struct(d.alias("distance"), i.alias("id"), v.alias("vec"))
    expanded = others.select("pid", F.flatten(F.transform("o", lambda s: F.transform(
        s["other_ids"], lambda i: entry(s["distance"], i, s["other_vec"])))).alias("far"))
    table = folded.select("pid", "vec", "ids").join(expanded, "pid", "left")
    # Each row takes the list of its vector; hot vectors are a skewed side for adaptive execution.
    joined = points.join(table, "vec")
    twins = F.transform(F.filter("ids", lambda i: i != F.col("id")), lambda i: entry(F.lit(0.0), i, F.col("vec")))
    far = F.coalesce("far", F.filter(F.transform("ids", lambda i: entry(F.lit(0.0), i, F.col("vec"))), lambda s: F.lit(False)))
    nearest = F.slice(F.sort_array(F.concat(twins, far)), 1, k)
    return joined.select("id", "vec", nearest.alias("neighbours"))
