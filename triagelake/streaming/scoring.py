"""Scoring on streams: row-level steps run unchanged, ranking runs per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.encode import Preprocessor
from ..operators.models import SCORE
from ..operators.queue import decided_claims, investigation_queue
from ..plans.jobs import probabilities


def claim_stream(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream of new files in a folder; the schema is stated, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(folder)


def stream_decisions(scored: DataFrame, score: str, source_row: str, reference: str) -> DataFrame:
    """Decision columns for a stream of scores. Bad scores pass with a null band instead of stopping the stream."""
    return decided_claims(scored, score, source_row, reference, strict=False)


def stream_probabilities(claims: DataFrame, fitted: Preprocessor, model: Transformer, keep: list[str],
                         on_bad: str = "null") -> DataFrame:
    """Stored parameters and model on a stream of raw claims, for example followed by ``stream_decisions``.

    By default a claim with a missing or malformed number passes without a score, so it neither
    stops the stream nor gets lost.
    """
    return probabilities(claims, fitted, model, keep, on_bad)


def write_decisions(decisions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append decisions exactly once to parquet, taking all files present and then stopping."""
    return (
        decisions.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def queue_per_batch(scored: DataFrame, source_row: str, reference: str | None, path: str,
                    checkpoint: str, score: str = SCORE) -> StreamingQuery:
    """A ranked queue per micro-batch; a repeated batch overwrites its own folder."""

    def rank(batch: DataFrame, batch_id: int) -> None:
        investigation_queue(batch, score, source_row, reference).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}")

    return each_batch(scored, rank, checkpoint)


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
