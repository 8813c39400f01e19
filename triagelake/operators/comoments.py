"""Correlations of wide tables from co-moments that are gathered in blocks and merged by addition.

Each task turns its Arrow batches into matrix products: for every pair of columns the number of
rows that hold both, the sums and sums of squares of the one where the other is present, and the
sum of products. Their size is that of the columns squared, whatever the number of rows. One
plan serves any number of columns, and sums of parts may be kept and added later as long as they
were taken with the same shifts.

Values are shifted by a constant per column before they are multiplied, so that a large mean
does not eat up the digits. The shifts change the rounding only, never the result otherwise.

Cases: nulls, NaN and infinite values are missing; a row counts for the pairs of which it holds
both; a pair with fewer than two such rows or without deviation has a null correlation; a
deviation below 3e-7 of the distance between mean and shift is taken for rounding; a table
without rows gives pairs with n = 0 and null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SHIFT_ROWS = 1000
_SUMS = ["n", "s", "q", "p"]


def shifts(df: DataFrame, columns: list[str]) -> list[float]:
    """A value near the mean of each column, from the first ``SHIFT_ROWS`` rows; 0 where they hold none."""
    number = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    row = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(columns)]).limit(SHIFT_ROWS).agg(
        *[F.avg(f"v{i}") for i in range(len(columns))]).first()
    return [x or 0.0 for x in row]


def comoments(df: DataFrame, columns: list[str], shift: list[float]) -> DataFrame:
    """One row per pair of columns, a <= b by position: n, and s, q, p of the shifted values.

    ``s`` and ``q`` are structs: the sum and the sum of squares of a and of b over the n rows.
    """
    k, at = len(columns), np.array(shift)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - at
            there = np.isfinite(x)
            x[~there] = 0
            m = there.astype(float)
            sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        if sums[0].any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32))] + [pa.array(list(s), pa.list_(pa.float64())) for s in sums]
                + [pa.array(list(sums[i].T), pa.list_(pa.float64())) for i in (1, 2)],
                names=["a", *_SUMS, "s_of_b", "q_of_b"])

    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    rows = values.mapInArrow(products, "a int, " + ", ".join(f"{c} array<double>" for c in [*_SUMS, "s_of_b", "q_of_b"]))
    pairs = rows.select("a", F.posexplode(F.arrays_zip(*_SUMS, "s_of_b", "q_of_b")).alias("b", "x")).where("a <= b")
    return _added(pairs.select(
        "a", "b", F.col("x.n").cast("long").alias("n"), F.struct(F.col("x.s").alias("a"), F.col("x.s_of_b").alias("b")).alias("s"),
        F.struct(F.col("x.q").alias("a"), F.col("x.q_of_b").alias("b")).alias("q"), F.col("x.p").alias("p")))


def _added(pairs: DataFrame) -> DataFrame:
    both = lambda c: F.struct(F.sum(f"{c}.a").alias("a"), F.sum(f"{c}.b").alias("b")).alias(c)
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), both("s"), both("q"), F.sum("p").alias("p"))


def merge_comoments(*parts: DataFrame) -> DataFrame:
    """Sums of several inputs, all taken with the same columns and shifts."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _added(rows)


def correlations(sums: DataFrame, columns: list[str]) -> DataFrame:
    """feature_a, feature_b (the one further left), n and correlation of every pair of different columns."""
    name = lambda c: F.get(F.array(*[F.lit(x) for x in columns]), F.col(c))
    k = len(columns)
    grid = sums.sparkSession.range(k * k).select(
        F.expr(f"cast(id div {k} AS int)").alias("a"), F.expr(f"cast(id % {k} AS int)").alias("b")).where("a < b")
    n = F.col("n")
    spread = lambda c: F.col(f"q.{c}") - F.col(f"s.{c}") * F.col(f"s.{c}") / n
    together = F.col("p") - F.col("s.a") * F.col("s.b") / n
    # What remains of a constant column after shifting is rounding: relative to its squares.
    flat = F.lit(False)
    for c in ("a", "b"):
        flat = flat | (spread(c) <= 1e-13 * F.col(f"q.{c}"))
    value = F.when((n > 1) & ~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), together / F.sqrt(spread("a") * spread("b")))))
    return grid.join(sums, ["a", "b"], "left").select(
        name("b").alias("feature_a"), name("a").alias("feature_b"), F.coalesce(n, F.lit(0).cast("long")).alias("n"), value.alias("correlation"))
