"""Reading, row keys and word classes shared by the training-data operators.

A document is identified by ``key``: its id together with a 64-bit hash of its text. Rows that
share an id but not the text therefore stay apart, exact repeats of a row share one key (and
one result), and a null id is an ordinary value that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters between words, for the contracts on letters-and-digits words (ASCII lower-cased).
LETTER_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: White space for the contracts on words between blanks.
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed(docs: DataFrame, *extra: Column) -> DataFrame:
    """``key``, ``doc_id`` and ``text`` (null: empty) of each row, and what ``extra`` names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(F.col("doc_id"), F.xxhash64(text).alias("tk")).alias("key"), "doc_id", text.alias("text"), *extra)


def packed(docs: DataFrame) -> DataFrame:
    """Each row whole in ``row``, beside its ``key`` and ``text``: no name of the input can clash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(F.col("doc_id"), F.xxhash64(text).alias("tk")).alias("key"), text.alias("text"), F.struct("*").alias("row"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def letter_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), LETTER_GAP), "")


def blank_words(text: Column) -> Column:
    """Words between blanks."""
    return F.array_remove(F.split(text, BLANK), "")


def places(text: Column, pattern: Column | str) -> Column:
    """Array of (start, end) of all matches, leftmost and without overlap: the text is split at them."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(F.arrays_zip(F.transform(found, lambda m: F.length(m)).alias("m"),
                                    F.slice(F.transform(between, lambda b: F.length(b)), 1, F.size(found)).alias("b")), none,
                       lambda a, x: F.struct((a["at"] + x["b"] + x["m"]).alias("at"), F.concat(a["spans"], F.array(F.struct(
                           (a["at"] + x["b"]).alias("start"), (a["at"] + x["b"] + x["m"]).alias("end")))).alias("spans")))["spans"]


def portions(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in smaller ones of about ``most`` bytes of a string or binary column."""
    for batch in batches:
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(sizes):
            until = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, until - at)
            at = until
