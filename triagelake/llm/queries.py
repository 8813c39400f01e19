"""Queries that apply each operator to its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import staging_folder
from . import alignment, bpe, decontaminate, language, licenses, linededup, neardup, packing, quality, ranking, rans, secrets, shards
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op2_line_dedup(spark, folder):
    done = linededup.dedup_lines(table(spark, folder, "documents"))
    return done.select("row.doc_id", "n_lines", "n_removed", "text")


@query
def op9_quality_rules(spark, folder):
    done = quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return done.select("key.doc_id", *quality.BASE, "base_failed", "kept")


@query
def op10_minhash_near_dedup(spark, folder):
    done = neardup.near_duplicates(table(spark, folder, "documents"))
    return done.select("key.doc_id", "n_shingles", F.col("component.doc_id").alias("component_id"), "kept")


@query
def op6_decontamination(spark, folder):
    done = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return done.select(
        "key.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op4_best_fit_packing(spark, folder):
    _, placed = packing.pack_documents(table(spark, folder, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op1_sharding(spark, folder):
    return shards.assign_shards(table(spark, folder, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op3_license_scan(spark, folder):
    return licenses.scan(table(spark, folder, "documents")).drop("spans")


@query
def op5_secret_scan(spark, folder):
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op7_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.train(docs))


@query
def op8_rans_token_files(spark, folder):
    target = f"{staging_folder(spark)}/token-files-{uuid.uuid4().hex}"
    rans.write_files(rans.encode_ids(table(spark, folder, "documents")), target)
    return rans.read_files(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op11_tokenizer_alignment(spark, folder):
    rows = alignment.align(table(spark, folder, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    done = alignment.link_counts(rows.withColumn("groups_sha256", digest).drop("groups"))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_byte_bpe(spark, folder):
    ids = bpe.encode(table(spark, folder, "documents")).select("doc_id", "ids", bpe.decode("ids").alias("decoded"))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_ranked_search(spark, folder):
    found = ranking.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")
