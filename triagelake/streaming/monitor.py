"""Threshold counts of a stream of scored and labelled claims.

Repeats of a claim are dropped in the state store (a claim counts with the first row that
arrives; its id is forgotten once the watermark has passed). Each micro-batch adds one small
table of slot counts, at most one row per slot, in a folder of its own; a batch that runs again
after a failure overwrites it, so every claim counts exactly once. The sums of those tables are
the counts of all claims so far, from which every threshold of the grid follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.thresholds import SEARCH_GRID, counts_from_slots, slotted, with_smoothed
from .scoring import each_batch

SLOTS = "slot double, pos long, n long"


def first_reports(claims: DataFrame, claim_id: str, time: str, delay: str) -> DataFrame:
    """The first row of each claim among those within ``delay`` of each other; later ones are dropped."""
    return claims.withWatermark(time, delay).dropDuplicatesWithinWatermark([claim_id])


def watch_thresholds(claims: DataFrame, score: str, label: str, path: str, checkpoint: str,
                     grid: list[float] = SEARCH_GRID) -> StreamingQuery:
    """Keeps ``path`` up to date with the slot counts of a stream without repeats."""

    def count(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("slot").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")

    return each_batch(slotted(claims, score, label, grid), count, checkpoint)


def threshold_state(spark: SparkSession, path: str, grid: list[float] = SEARCH_GRID) -> DataFrame:
    """Counts and smoothed metrics per threshold over all batches so far."""
    parts = spark.read.schema(SLOTS).parquet(path)
    slots = parts.groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    return with_smoothed(counts_from_slots(slots, grid))
