"""A training-corpus pipeline: five stages, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents; the last returns
the packed pieces instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triagelake.llm import decontaminate, linededup, neardup, packing, quality
from triagelake.llm.common import table
from triagelake.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of a run of lines are cut out of the texts; no document goes."""
    return linededup.rewrite(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it lies in which training sequence."""
    _, placed = packing.pack_documents(docs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("sequence packing", sequence_packing),
]
#: Tokenising and packing have no SQL; the tests rebuild the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
