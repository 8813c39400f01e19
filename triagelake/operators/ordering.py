"""Exact ranks, order statistics and running totals without a one-task sort.

A window with no partition key sends every row to one task. The functions here
cut the value range into bins at approximate quantiles first. Bin borders never
change a result, they only decide how work is spread: each bin gets an offset
from the (small) table of bin totals, and sorting happens inside bins.

A value that holds a large share of the rows gets a bin of its own, which is cut
again along the tie-break key, so no bin is hot even if a third of all rows tie.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..session import stage

MAX_BINS = 4096
ROWS_PER_BIN = 200_000
LAST = sys.float_info.max


def descending(score: str | Column) -> Column:
    """Ascending sort key for 'highest score first'; null and NaN come last."""
    flipped = F.lit(0.0) - (F.col(score) if isinstance(score, str) else score)
    return F.coalesce(F.nanvl(flipped, F.lit(LAST)), F.lit(LAST))


@dataclass(frozen=True)
class Cuts:
    """Bin borders for a key and, for heavy ties, for the tie-break column."""

    key: list[float]
    heavy: list[float]
    tie: list[float]


def _splits(values: list[float]) -> list[float]:
    inner = [v for v in sorted(set(values)) if not math.isinf(v)]
    return [-math.inf, *inner, math.inf]


def _sketch(df: DataFrame, column: Column, bins: int) -> list[float]:
    grid = ", ".join(f"{i / bins!r}D" for i in range(1, bins))
    text = f"percentile_approx(__v, array({grid}), {max(10_000, 5 * bins)})"
    return [float(v) for v in df.select(column.cast("double").alias("__v")).agg(F.expr(text)).first()[0]]


def find_cuts(df: DataFrame, key: str, tie: str | None = None,
              rows_per_bin: int = ROWS_PER_BIN, max_bins: int = MAX_BINS) -> Cuts:
    """A count, then a mergeable quantile sketch; at most ``max_bins`` numbers reach the driver.

    Tables that fit in one bin stop after the count. The tie-break column is only
    sketched when some key value fills whole bins.
    """
    bins = min(max_bins, math.ceil(df.count() / rows_per_bin))
    if bins <= 1:
        return Cuts([], [], [])
    values = _sketch(df, F.col(key), bins)
    heavy = sorted({v for v, after in zip(values, values[1:]) if v == after})
    ties = _sketch(df, F.col(tie), bins) if tie is not None and heavy else []
    return Cuts(sorted(set(values)), heavy, sorted(set(ties)))


def add_bins(df: DataFrame, cuts: Cuts, key: str, tie: str | None = None) -> DataFrame:
    """Add ``bin`` and ``tie_bin``; rows of a lower bin sort before rows of a higher one."""
    if not cuts.key:
        return df.withColumns({"bin": F.lit(0), "tie_bin": F.lit(0)})
    borders = list(cuts.key) + [math.nextafter(v, math.inf) for v in cuts.heavy]
    out = Bucketizer(splits=_splits(borders), inputCol=key, outputCol="__b", handleInvalid="keep").transform(df)
    out = out.withColumn("bin", F.col("__b").cast("int")).drop("__b")
    if not cuts.tie:
        return out.withColumn("tie_bin", F.lit(0))
    out = Bucketizer(splits=_splits(cuts.tie), inputCol="__t", outputCol="__b", handleInvalid="keep").transform(
        out.withColumn("__t", F.col(tie).cast("double")))
    tied = F.col(key).isin([float(v) for v in cuts.heavy])
    return out.withColumn("tie_bin", F.when(tied, F.col("__b").cast("int")).otherwise(F.lit(0))).drop("__b", "__t")


def bin_totals(binned: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """Totals per bin, of all earlier bins and of the group: a few thousand rows per group.

    The windows run on this small table, never on raw rows.
    """
    totals = binned.groupBy(*by, "bin", "tie_bin").agg(*[c.alias(n) for n, c in sums.items()])
    group = W.partitionBy(*by)
    before = group.orderBy("bin", "tie_bin").rowsBetween(W.unboundedPreceding, -1)
    extra = {f"{n}_before": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums}
    return totals.withColumns({**extra, **{f"{n}_total": F.sum(n).over(group) for n in sums}})


def _bins_with_ranks(totals: DataFrame, ranks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Bins that contain a wanted rank; never more rows than ranks were asked for."""
    inside = lambda r: (r > F.col("n_before")) & (r <= F.col("n_before") + F.col("n"))
    return ranks(totals).withColumn("wanted", F.filter("wanted", inside)).filter(F.size("wanted") > 0)


def locate_ranks(binned: DataFrame, ranks: Callable[[DataFrame], DataFrame], key: list[str],
                 by: list[str] | None = None, measure: str | None = None) -> DataFrame:
    """Rows that stand at requested 1-based ranks, with running sums up to them.

    ``ranks`` receives the table of bin totals (``n_total``, ``m_total`` per group) and
    adds the array column ``wanted``. Only bins that contain a wanted rank are
    sorted; all other rows are merely counted.
    """
    by = list(by or [])
    group = by or ["__all"]
    if not by:
        binned = binned.withColumn("__all", F.lit(0))
    value = F.col(measure) if measure else F.lit(0)
    totals = bin_totals(binned, group, {"n": F.count(F.lit(1)), "m": F.sum(value)})
    hits = _bins_with_ranks(totals, ranks).select(
        *group, "bin", "tie_bin", "n_before", "m_before", "n_total", "m_total", "wanted")
    rows = binned.join(hits, [*group, "bin", "tie_bin"])
    inner = W.partitionBy(*group, "bin", "tie_bin").orderBy(*key)
    found = (
        rows.withColumn("rank", F.col("n_before") + F.row_number().over(inner))
        .withColumn("m_upto", F.col("m_before") + F.sum(value).over(
            inner.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .filter(F.array_contains("wanted", F.col("rank")))
    )
    return found.select(*by, "rank", *key, "m_upto", "n_total", "m_total")


def score_boundaries(scored: DataFrame, score: str, row_id: str, label: str,
                     ranks: Callable[[DataFrame], DataFrame], rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Cumulative positives at given ranks of 'score descending, row id ascending'.

    Row ids must be numbers: heavy ties are cut along them.
    """
    if not isinstance(scored.schema[row_id].dataType, T.NumericType):
        raise TypeError(f"row id {row_id} must be numeric")
    keyed = scored.select(descending(score).alias("key"), F.col(row_id).alias("tie"), F.col(label).alias("y"))
    cuts = find_cuts(keyed, "key", "tie", rows_per_bin)
    binned = add_bins(keyed, cuts, "key", "tie")
    return locate_ranks(binned, ranks, ["key", "tie"], measure="y")


def quantiles(long: DataFrame, by: list[str], value: str, probabilities: list[float],
              rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Exact linearly interpolated quantiles per group; nulls and NaN are left out.

    Returns one row per group with ``q`` as map from probability to value. Bins are
    cut on the pooled values, which bounds every (group, bin) as well.
    """
    rows = long.select(*by, F.col(value).cast("double").alias("key")).filter(
        F.col("key").isNotNull() & ~F.isnan("key"))
    binned = add_bins(rows, find_cuts(rows, "key", None, rows_per_bin), "key")

    def wanted(whole: DataFrame) -> DataFrame:
        ends = []
        for p in probabilities:
            place = (F.col("n_total") - 1) * F.lit(p)
            ends += [F.floor(place) + 1, F.ceil(place) + 1]
        return whole.withColumn("wanted", F.array_distinct(F.array(*[e.cast("long") for e in ends])))

    found = _values_at_ranks(binned, wanted, by)
    table = found.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "key"))).alias("at"), F.first("n_total").alias("n"))
    entries = []
    for p in probabilities:
        place = (F.col("n") - 1) * F.lit(p)
        low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
        a, b = F.element_at("at", low + 1), F.element_at("at", high + 1)
        entries += [F.lit(p), a + (b - a) * (place - low)]
    return table.select(*by, F.col("n"), F.create_map(*entries).alias("q"))


def _values_at_ranks(binned: DataFrame, ranks: Callable[[DataFrame], DataFrame], by: list[str]) -> DataFrame:
    """Like ``locate_ranks`` for plain values: copies are counted before the shuffle, not sorted."""
    hits = _bins_with_ranks(bin_totals(binned, by, {"n": F.count(F.lit(1))}), ranks).select(
        *by, "bin", "tie_bin", "n_before", "n_total", "wanted")
    values = binned.join(hits, [*by, "bin", "tie_bin"]).groupBy(
        *by, "bin", "tie_bin", "n_before", "n_total", "wanted", "key").agg(F.count(F.lit(1)).alias("c"))
    upto = F.col("n_before") + F.sum("c").over(W.partitionBy(*by, "bin", "tie_bin").orderBy("key"))
    covered = lambda r: (r > F.col("upto") - F.col("c")) & (r <= F.col("upto"))
    return values.withColumn("upto", upto).select(
        *by, F.explode(F.filter("wanted", covered)).alias("rank"), "key", "n_total")


def score_groups(scored: DataFrame, score: str, label: str, by: list[str] | None = None,
                 rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """One row per distinct score, highest first, with counts before it.

    Columns: ``score, n, tp, n_before, tp_before, n_total, tp_total`` per group.
    Rows are pre-aggregated by score before the shuffle, so a score shared by many
    rows is one partial row per task.
    """
    by = list(by or [])
    group = by or ["__all"]
    rows = scored.select(*by, descending(score).alias("key"), F.col(score).alias("score"), F.col(label).alias("y"))
    if not by:
        rows = rows.withColumn("__all", F.lit(0))
    binned = add_bins(rows, find_cuts(rows, "key", None, rows_per_bin), "key")
    sums = {"n": F.count(F.lit(1)), "tp": F.sum("y")}
    offsets = bin_totals(binned, group, sums).drop(*sums)
    values = binned.groupBy(*group, "bin", "tie_bin", "key").agg(
        F.first("score").alias("score"), *[c.alias(n) for n, c in sums.items()])
    before = W.partitionBy(*group, "bin", "tie_bin").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    inner = values.withColumns({f"{n}_in": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums})
    out = inner.join(offsets, [*group, "bin", "tie_bin"])
    return out.select(
        *by, "score", "n", "tp",
        (F.col("n_before") + F.col("n_in")).alias("n_before"),
        (F.col("tp_before") + F.col("tp_in")).alias("tp_before"),
        "n_total", "tp_total")


def global_rank(df: DataFrame, order: list[Column], rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """Row-level rank 1..n over the whole frame.

    Rows are range-partitioned on the full sort key, sorted inside partitions and
    written once to the shared folder together with (partition, position). The
    rank is then position plus the size of all earlier partitions. End the key with
    a unique column: ties are impossible then and every range can be balanced.
    """
    # Without a number, adaptive execution merges neighbouring small ranges.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = stage(placed, "ranked")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    # One offset row per partition.
    return placed.join(F.broadcast(offsets), "__part").select(
        (F.col("__before") + F.col("__pos") + 1).alias(rank), *df.columns)
