"""Choosing winners among result rows and keeping comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.ratios import ratio

RESULT_COLUMNS = ["model", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "threshold",
                  "tn", "fp", "fn", "tp", "fit_seconds"]
SELECTION_KEYS = ["validation_pr_auc", "validation_f1", "validation_roc_auc"]


def results_projection(results: DataFrame) -> DataFrame:
    """The 13 scalar result columns."""
    return results.select(*RESULT_COLUMNS)


def winner(results: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """Best row by PR-AUC, then F1, then ROC-AUC; on a full tie the first in ``order``.

    A max over structs: one aggregation with map-side combine, also per group.
    """
    key = F.struct(*[F.col(c) for c in SELECTION_KEYS], (-F.col(order)).alias("__first"))
    row = F.struct(*[F.col(c) for c in results.columns])
    best = results.groupBy(*(by or [])).agg(F.max_by(row, key).alias("best"))
    return best.select("best.*")


def require_winner(results: DataFrame, order: str) -> DataFrame:
    if results.isEmpty():
        raise ValueError("at least one validation result is required")
    return winner(results, order)


def winner_configuration(winner_row: DataFrame, configurations: DataFrame, key: str = "candidate_id") -> DataFrame:
    """The configuration the winner was built from."""
    return winner_row.select(key).join(configurations, key)


def pooled(*stages: DataFrame) -> DataFrame:
    """Results of all stages in one table."""
    out = stages[0]
    for stage in stages[1:]:
        out = out.unionByName(stage)
    return out


def append_result(table: DataFrame, row: DataFrame) -> DataFrame:
    """Add a result to an earlier table in the columns of that table; gaps stay null."""
    return table.unionByName(row, allowMissingColumns=True).select(*table.columns)


def best_markers(results: DataFrame, metrics: list[str]) -> DataFrame:
    """Flag per metric which rows hold the best value, and caught and missed shares.

    ``results`` has one row per model, so the window covers a handful of rows.
    """
    everything = W.partitionBy(F.lit(0))
    out = results.withColumns({f"best_{m}": F.col(m) == F.max(m).over(everything) for m in metrics})
    return out.withColumns({
        "caught_share": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "missed_share": ratio(F.col("fn"), F.col("tp") + F.col("fn"))})


def model_comparison(results: DataFrame, metrics: list[str], name: str = "model") -> DataFrame:
    """One row per metric and one column per model."""
    models = [r[name] for r in results.select(name).distinct().orderBy(name).collect()]
    long = results.select(name, *metrics).unpivot([name], metrics, "metric", "value")
    return long.groupBy("metric").pivot(name, models).agg(F.first("value"))
