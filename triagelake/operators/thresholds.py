"""Threshold search: one counting pass serves every point of a grid."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.ratios import ratio, smoothed
from .metrics import evaluate, ranking_metrics, ratios_from_counts

# The search grid 0.10 … 0.90 in double steps, the plot grid and the
# short list of the report. Grid points are doubles such as 0.23999999999999994 and
# must not be replaced by decimals.
SEARCH_GRID = [float(t) for t in np.arange(0.10, 0.91, 0.01)]
PLOT_GRID = [float(t) for t in np.linspace(0.1, 0.9, 80)]
REPORT_GRID = [0.20, 0.25, 0.30, 0.35, 0.40, 0.50]
DEFAULT_THRESHOLD = 0.5


def slotted(scored: DataFrame, score: str, label: str, grid: list[float], by: list[str] | None = None) -> DataFrame:
    """by, slot and y of each row, without a shuffle: the slot is the number of grid points not above the score."""
    # A missing score is never flagged, so it belongs below the first grid point.
    value = F.coalesce(F.nanvl(F.col(score), F.lit(-1.0)), F.lit(-1.0)).cast("double")
    rows = scored.select(*(by or []), value.alias("v"), F.col(label).cast("long").alias("y"))
    return Bucketizer(splits=[-math.inf, *grid, math.inf], inputCol="v", outputCol="slot").transform(rows).drop("v")


def slot_counts(scored: DataFrame, score: str, label: str, grid: list[float], by: list[str] | None = None) -> DataFrame:
    """pos and n per slot and group: at most ``len(grid) + 1`` rows a group, which add up over parts of the data."""
    rows = slotted(scored, score, label, grid, by)
    return rows.groupBy(*(by or []), "slot").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))


def counts_from_slots(slots: DataFrame, grid: list[float], by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp for each grid point (``grid_index`` from 0) and group, by suffix sums over the slots."""
    by = list(by or [])
    group = by or ["__all"]
    if not by:
        slots = slots.withColumn("__all", F.lit(0))
    # One row per group holding at most len(grid) + 1 slots.
    packed = slots.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("slot").cast("int"), F.struct("pos", "n")))).alias("slots"))
    points = packed.select(*group, "slots", F.posexplode(F.sequence(F.lit(0), F.lit(len(grid)))).alias("i", "slot"))
    got = F.try_element_at("slots", F.col("slot"))
    points = points.select(*group, "slot", F.coalesce(got["pos"], F.lit(0)).alias("pos"),
                           F.coalesce(got["n"], F.lit(0)).alias("n"))
    above = W.partitionBy(*group).orderBy(F.col("slot").desc())
    whole = W.partitionBy(*group)
    tp, flagged = F.sum("pos").over(above), F.sum("n").over(above)
    pos, total = F.sum("pos").over(whole), F.sum("n").over(whole)
    counted = points.select(
        *group, "slot", tp.alias("tp"), (flagged - tp).alias("fp"), (pos - tp).alias("fn"),
        (total - flagged - pos + tp).alias("tn"))
    thresholds = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("slot"))
    return counted.filter(F.col("slot") > 0).select(
        *by, (F.col("slot") - 1).alias("grid_index"), thresholds.alias("threshold"), "tn", "fp", "fn", "tp")


def grid_counts(scored: DataFrame, score: str, label: str, grid: list[float],
                by: list[str] | None = None) -> DataFrame:
    """Confusion counts for each grid point and group, from one map-side combined pass over the rows."""
    return counts_from_slots(slot_counts(scored, score, label, grid, by), grid, by)


def with_smoothed(counts: DataFrame) -> DataFrame:
    """Smoothed recall, precision and F1 plus accuracy beside the counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = counts.withColumns({
        "recall": smoothed(tp, tp + fn), "precision": smoothed(tp, tp + fp),
        "accuracy": ratio(tp + tn, tp + tn + fp + fn)})
    r, p = F.col("recall"), F.col("precision")
    return out.withColumn("f1", F.lit(2.0) * p * r / (p + r + F.lit(1e-8)))


def sweep(scored: DataFrame, score: str, label: str, grid: list[float] = SEARCH_GRID,
          by: list[str] | None = None) -> DataFrame:
    """Smoothed recall, precision and F1 plus accuracy at each grid point."""
    return with_smoothed(grid_counts(scored, score, label, grid, by))


def best_threshold(scored: DataFrame, score: str, label: str, optimize_for: str = "f1",
                   by: list[str] | None = None, grid: list[float] = SEARCH_GRID) -> DataFrame:
    """First grid point with the strictly best value; anything but ``f1`` means recall.

    Recall cannot rise with the threshold, so 'recall' always yields the first
    point. An empty input gives one ungrouped row with the default 0.5.
    """
    by = list(by or [])
    goal = "f1" if optimize_for == "f1" else "recall"
    points = sweep(scored, score, label, grid, by)
    best = points.groupBy(*by).agg(
        F.max_by("threshold", F.struct(F.col(goal), -F.col("grid_index"))).alias("threshold"),
        F.max(goal).alias("best_score"))
    return best.withColumn("threshold", F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)))


def threshold_table(scored: DataFrame, score: str, label: str, thresholds: list[float] = REPORT_GRID) -> DataFrame:
    """Exact (unsmoothed) metrics for a short list of thresholds."""
    return grid_counts(scored, score, label, sorted(thresholds)).select(
        "threshold", *[c.alias(n) for n, c in ratios_from_counts().items()])


def evaluate_at_validation_threshold(validation: DataFrame, test: DataFrame, score: str, label: str,
                                     optimize_for: str = "f1") -> DataFrame:
    """Choose the threshold on validation rows, freeze it, evaluate test rows once."""
    chosen = best_threshold(validation, score, label, optimize_for).first()["threshold"]
    return evaluate(test, score, label, chosen)


def validation_records(scored: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """Validation metrics of many candidates at once, each at its own best threshold."""
    points = sweep(scored, score, label, SEARCH_GRID, by)
    counts = F.struct("threshold", "tn", "fp", "fn", "tp")
    best = points.groupBy(*by).agg(F.max_by(counts, F.struct(F.col("f1"), -F.col("grid_index"))).alias("best"))
    at_best = best.select(*by, "best.*")
    values = ratios_from_counts()
    records = at_best.select(*by, "threshold", *[values[m].alias(m) for m in ("precision", "recall", "f1")])
    return records.join(ranking_metrics(scored, score, label, by), by).select(
        *by, F.col("pr_auc").alias("validation_pr_auc"), F.col("roc_auc").alias("validation_roc_auc"),
        F.col("precision").alias("validation_precision"), F.col("recall").alias("validation_recall"),
        F.col("f1").alias("validation_f1"), F.col("threshold").alias("validation_threshold"))
