"""Packing tokenised documents into fixed-length sequences by the sum-of-squares rule.

A piece goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest: into an open sequence with some gap or into a new one; equal choices take the
smallest gap. Only gap counts decide, so one placement costs one pass over an array.

Pieces are dealt by hash, so with lengths mixed, to groups of about ``GROUP`` pieces, each packed
largest first. A sequence is final when no open sequence left in any group fits its gap. The
others go on whole: the next round deals them to groups of as many pieces and packs them like
pieces of their size. Rounds end when one group holds the rest, or when a round leaves more
than ``SHRINK`` of its pieces open; its sequences are then final as its groups packed them, at
the price of a partial set per group. Rounds are written to shared storage, so nothing is
recomputed after a loss; the size of a group does not grow with the table.

Cases: a null or empty text is the end id alone; only documents longer than a sequence are cut;
rows that repeat a document are packed each by itself; a null id is an id like any other; an
empty table gives no sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import packed, portions
from .tokens import coder

LENGTH = 2048
GROUP = 50_000
SHRINK = 0.75
VOCABULARY, END = "word_bpe_49k.json", 0


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, length: int = LENGTH) -> DataFrame:
    """doc_id, tk (text hash), piece, start, length, ids_crc32 and ids (little-endian, 16 bits each) of each piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary).encode
        for batch in portions(batches, "text"):
            rows = []
            for row, ids in enumerate(encode(batch["text"])):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), length)):
                    part = ids[at:at + length]
                    rows.append((row, k, at, len(part), zlib.crc32(part.tobytes()), part.astype("<u2").tobytes()))
            row, piece, start, size, crc, raw = zip(*rows)
            own = [batch[c].take(pa.array(row)) for c in ("doc_id", "tk")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc)), pa.array(raw, pa.binary())],
                names=["doc_id", "tk", "piece", "start", "length", "ids_crc32", "ids"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return packed(docs).select("key.doc_id", "key.tk", "text").mapInArrow(
        cut, f"doc_id {id_type}, tk bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")


def sum_of_squares(sizes: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each size in turn, and the gap each sequence is left with."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences per gap; a full one counts nowhere
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    where, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for k, size in enumerate(sizes):
        now, then = count[size:capacity], count[:capacity - size]  # gap size.. becomes 0..; a gap of capacity is a new one
        change = np.where(now > 0, 2 * (then - now) + 2, 4 * len(sizes) + 4)
        change[:1] -= 1  # a full sequence is not counted where it arrives
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] <= 2 * count[capacity - size] + 1:
            gap = best + size
            sequence = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, sequence = capacity, len(gaps)
            gaps.append(capacity)
        where[k], offsets[k] = sequence, capacity - gap
        gaps[sequence] = gap - size
        if gap > size:
            count[gap - size] += 1
            open_by_gap[gap - size].append(sequence)
    return where, offsets, np.array(gaps, np.int64)


def _pack_group(level: int, capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        if level == 0:  # every piece is a block of its own, later an open sequence is one
            group = group.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
            block, sizes, order = np.arange(len(group)), group["length"].to_numpy(), np.arange(len(group))
        else:
            block = np.unique(group["sequence_id"], return_inverse=True)[1]
            sizes = np.bincount(block, weights=group["length"]).astype(np.int64)
            order = np.argsort(-sizes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        where, offsets, gaps = sum_of_squares(sizes[order].tolist(), capacity)
        number = (level << 54) + (int(group["pack"].iloc[0]) << 28) if len(group) else 0
        at = place[block]
        return group.assign(sequence_id=where[at] + number, offset=group["offset"] + offsets[at], gap=gaps[where[at]])

    return run


def pack(found: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The columns of ``pieces`` (without ids) with sequence_id and offset; ``found`` should be a written table."""
    columns = ["doc_id", "tk", "piece", "start", "length", "ids_crc32"]
    # Numbered when written: only numbers go through the packers, and pieces of equal rows are dealt apart.
    rows = stage(found.select(*columns, F.monotonically_increasing_id().alias("row")), "pack-rows")
    none = F.lit(0).cast("bigint")
    left, level, placed = rows.select("row", "length", none.alias("sequence_id"), none.alias("offset")), 0, None
    schema = "row bigint, length bigint, sequence_id bigint, offset bigint, pack bigint, gap bigint"
    n = left.count()
    while True:
        groups = max(1, math.ceil(n / group))
        dealt = left.withColumn("pack", F.pmod(F.xxhash64("sequence_id" if level else "row", F.lit(level)), F.lit(groups)))
        done = stage(dealt.groupBy("pack").applyInPandas(_pack_group(level, length), schema), "packed")
        smallest = done.where("gap > 0").agg(F.min(length - F.col("gap"))).first()[0]
        ends = (F.col("gap") == 0) | (F.col("gap") < F.lit(smallest))  # nothing left fits
        before, n = n, 0 if smallest is None else done.where(~ends).count()
        last = groups == 1 or n == 0 or n > SHRINK * before
        final = (done if last else done.where(ends)).select("row", "sequence_id", "offset")
        placed = final if placed is None else placed.unionByName(final)
        if last:
            return rows.join(placed, "row").drop("row")
        left, level = done.where(~ends).select("row", "length", "sequence_id", "offset"), level + 1


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Written pieces with their ids, and their places."""
    found = stage(pieces(docs, vocabulary, end, length), "pieces")
    return found, pack(found, length)


def sequences(found: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id, n_ids and ids (16 bits each) of every packed sequence."""
    ids = found.select("doc_id", "tk", "piece", "ids").dropDuplicates(["doc_id", "tk", "piece"])
    on = [placed["doc_id"].eqNullSafe(ids["doc_id"]), placed["tk"] == ids["tk"], placed["piece"] == ids["piece"]]
    parts = placed.join(ids, on).select("sequence_id", "offset", "length", ids["ids"])
    joined = F.aggregate(F.array_sort(F.collect_list(F.struct("offset", "ids"))), F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return parts.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))
