"""Classification metrics from scored rows; every function accepts group columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.policy import at_threshold
from ..functions.ratios import ratio
from .ordering import ROWS_PER_BIN, score_groups


def confusion_counts(scored: DataFrame, score: str, label: str, threshold: float | str,
                     by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn and tp in one aggregation; ``threshold`` is a number or a column name."""
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    flagged = F.col(score) >= limit
    count = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")
    positive = F.col(label) == 1
    return scored.groupBy(*(by or [])).agg(
        count(~flagged & ~positive).alias("tn"), count(flagged & ~positive).alias("fp"),
        count(~flagged & positive).alias("fn"), count(flagged & positive).alias("tp"))


def ratios_from_counts() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(tp * 2, tp * 2 + fp + fn),
    }


def ranking_metrics(scored: DataFrame, score: str, label: str, by: list[str] | None = None,
                    rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """ROC-AUC with ties counted half and step-wise average precision."""
    by = list(by or [])
    groups = score_groups(scored, score, label, by, rows_per_bin)
    pos, n, tp = F.col("tp_total").cast("double"), F.col("n").cast("double"), F.col("tp").cast("double")
    neg = F.col("n_total") - pos
    area = (n - tp) * (F.col("tp_before") + tp / 2)
    step = tp * ((F.col("tp_before") + tp) / (F.col("n_before") + n))
    return groups.groupBy(*by).agg(
        F.try_divide(F.sum(area), F.max(pos) * F.max(neg)).alias("roc_auc"),
        ratio(F.sum(step), F.max(pos)).alias("pr_auc"))


def evaluate(scored: DataFrame, score: str, label: str, threshold: float,
             rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """One row with all benchmark metrics at a fixed threshold."""
    counts = confusion_counts(scored, score, label, threshold)
    # Both sides are single rows.
    both = counts.withColumn("__k", F.lit(0)).join(
        F.broadcast(ranking_metrics(scored, score, label, None, rows_per_bin).withColumn("__k", F.lit(0))), "__k")
    return both.select(
        *[c.alias(n) for n, c in ratios_from_counts().items()], "roc_auc", "pr_auc",
        F.lit(float(threshold)).alias("threshold"), "tn", "fp", "fn", "tp")


def class_report(scored: DataFrame, score: str, label: str, threshold: float = 0.40) -> DataFrame:
    """Precision, recall, F1 and support per class plus the shared accuracy."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    entry = lambda name, hit, wrong, missed: F.struct(
        F.lit(name).alias("class"), ratio(hit, hit + wrong).alias("precision"),
        ratio(hit, hit + missed).alias("recall"), ratio(hit * 2, hit * 2 + wrong + missed).alias("f1"),
        (hit + missed).alias("support"))
    counts = confusion_counts(scored, score, label, threshold)
    return counts.select(
        F.explode(F.array(entry("Legitimate", tn, fn, fp), entry("Fraud", tp, fp, fn))).alias("row"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    ).select("row.*", "accuracy")


def roc_points(scored: DataFrame, score: str, label: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """One (fpr, tpr, threshold) row per distinct score."""
    tp = F.col("tp_before") + F.col("tp")
    seen = F.col("n_before") + F.col("n")
    return score_groups(scored, score, label, None, rows_per_bin).select(
        F.try_divide(seen - tp, F.col("n_total") - F.col("tp_total")).alias("fpr"),
        F.try_divide(tp, F.col("tp_total")).alias("tpr"), F.col("score").alias("threshold"))


def pr_points(scored: DataFrame, score: str, label: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """One (precision, recall, threshold) row per distinct score."""
    tp = F.col("tp_before") + F.col("tp")
    return score_groups(scored, score, label, None, rows_per_bin).select(
        ratio(tp, F.col("n_before") + F.col("n")).alias("precision"),
        ratio(tp, F.col("tp_total")).alias("recall"), F.col("score").alias("threshold"))


def with_prediction(scored: DataFrame, score: str, threshold: float) -> DataFrame:
    return scored.withColumn("prediction", at_threshold(score, threshold))
