"""Balanced shards by vector bin packing over bytes, tokens and rows.

Documents with equal texts form a group that should share a shard. A group heavier than
``1 / PARTS`` of a shard in any of the three sizes is split by row number into portions of
about that weight; such groups are few (at most 3 * shards * PARTS), which is what makes
their table safe to broadcast. Everything else is one portion.

Portions are dealt by hash to packers, which place them largest first: each goes to the bin
where the dot product of its size vector with the bin's residual capacity (both as shares of a
shard) is highest, among bins it still fits if there are any. A packer's capacity is its own
load over the number of shards, so its bins come out near equal. The bins of up to ``FAN``
packers are then packed again by the same rule, and so on until one packer is left: 40 bins.

Law: ``bytes`` (sizes of shards near equal). Cases: a null text counts as empty; rows that
repeat a document are split like other copies and get slots of their own; a null id is placed like any
other; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import BLANK

SHARDS = 40
PARTS = 50
GROUP, FAN = 100_000, 64
OVERHEAD = 16
SLOT_BLOCK = 4096
SIZES = ["bytes", "tokens", "rows"]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, group (two hashes and length of the text) and the size vector of each row."""
    text = F.coalesce("text", F.lit(""))
    length = F.octet_length(text).cast("long")
    return docs.select(
        "doc_id", (length + OVERHEAD).alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group_hash"), length.alias("group_length"),
        (F.size(F.split(text, BLANK)) + 1).cast("long").alias("tokens"), F.lit(1).cast("long").alias("rows"))


def dot_product_packing(sizes: np.ndarray, bins: int, capacity: np.ndarray) -> np.ndarray:
    """Bin of each size vector in turn; sizes and capacity share their unit, one column per resource."""
    scale = np.where(capacity > 0, capacity, 1.0)
    items, residual = sizes / scale, np.ones((bins, sizes.shape[1]))
    out = np.empty(len(items), np.int64)
    for k, item in enumerate(items):
        score = residual @ item
        fits = (residual >= item).all(axis=1)
        best = int(np.where(fits, score, -np.inf).argmax()) if fits.any() else int(score.argmax())
        residual[best] -= item
        out[k] = best
    return out


def _pack(shards: int):
    def run(portions: pd.DataFrame) -> pd.DataFrame:
        sizes = portions[SIZES].to_numpy(float)
        capacity = sizes.sum(axis=0) / shards
        order = np.lexsort((portions["tie"], -(sizes / np.where(capacity > 0, capacity, 1.0)).max(axis=1)))
        portions = portions.iloc[order].reset_index(drop=True)
        return portions.assign(bin=dot_product_packing(sizes[order], shards, capacity))

    return run


def _packed(portions: DataFrame, packers: int, shards: int) -> DataFrame:
    schema = ", ".join(f"{c} {t}" for c, t in portions.dtypes) + ", packer bigint, bin bigint"
    dealt = portions.withColumn("packer", F.pmod(F.xxhash64("tie", F.lit(packers)), F.lit(packers)).cast("long"))
    return stage(dealt.groupBy("packer").applyInPandas(_pack(shards), schema), "shard-bins")


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard and slot (gapless from 0 in a shard) of every row of ``docs``."""
    # Numbered when written, so rows that repeat a document are told apart.
    rows = stage(measure(docs).withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SIZES]).first()
    group = ["group_hash", "group_length", "text_crc32"]
    limit = [max(1.0, total[c] / (shards * PARTS)) for c in SIZES]
    weight = F.greatest(*[F.sum(c) / F.lit(x) for c, x in zip(SIZES, limit)])
    heavy = rows.groupBy(*group).agg(F.ceil(weight).alias("portions")).where("portions > 1")
    heavy = stage(heavy, "shard-heavy")
    # A document alone may outweigh the limit; it cannot be split, its portions just stay empty.
    rows = rows.join(F.broadcast(heavy), group, "left").withColumn(
        "portion", F.coalesce(F.pmod(F.xxhash64("row"), F.col("portions")), F.lit(0)))
    portion = [*group, "portion"]
    portions = rows.groupBy(*portion).agg(*[F.sum(c).alias(c) for c in SIZES]).withColumn("tie", F.xxhash64(*portion))
    portions = stage(portions, "shard-portions")
    level = _packed(portions, max(1, math.ceil(portions.count() / GROUP)), shards)
    packers = max(1, math.ceil(portions.count() / GROUP))
    maps = []
    bins = level
    while packers > 1:
        loads = bins.groupBy("packer", "bin").agg(*[F.sum(c).alias(c) for c in SIZES]).select(
            F.col("packer").alias("from_packer"), F.col("bin").alias("from_bin"), *SIZES, F.xxhash64("packer", "bin").alias("tie"))
        packers = math.ceil(packers / FAN)
        bins = _packed(loads, packers, shards)
        maps.append(bins.select("from_packer", "from_bin", "packer", "bin"))
    for up in maps:
        level = level.withColumnsRenamed({"packer": "from_packer", "bin": "from_bin"}).join(up, ["from_packer", "from_bin"])
    placed = rows.join(level.select(*portion, F.col("bin").cast("int").alias("shard")), portion)
    return _slots(placed, shards, total["rows"])


def _slots(placed: DataFrame, shards: int, n: int) -> DataFrame:
    """Number the rows of each shard: blocks of bounded size by row hash, rows inside by id."""
    blocks = max(1, math.ceil(n / (shards * SLOT_BLOCK)))
    placed = stage(placed.select(
        "doc_id", "row", F.col("bytes").alias("size"), "text_crc32", "shard",
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block")), "shard-placed")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "row"))
    return placed.withColumn("inside", inside).join(starts, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("inside") - 1).alias("slot"))
