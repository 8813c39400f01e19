"""Token ids as binary files: a static range asymmetric numeral system in interleaved blocks.

One frequency table, counted over all ids, is shared by all blocks. A block holds the ids of
consecutive documents and is coded by many interleaved states at once (array operations over
``LANES`` states), on its own: it begins from the shared table and ends with its states, so
blocks are decoded in parallel. A checkpoint per document says where its ids begin in the block.

File format: a folder with Parquet tables. ``table``: id, frequency (they add up to 2**SCALE).
``blocks``: block number, first document place, ids before the block, number of ids, counts per
document (checkpoints), lane states (64 bits each, little-endian), the code words (32 bits each,
little-endian, in the order in which a decoder needs them) and the crc32 of the ids. Blocks lie
in ascending order of doc_id, then text hash.

Texts are tokenised where they are read; only ids are shuffled. Order over the whole corpus:
documents are range-partitioned by doc_id and text hash and sorted inside their range; a task
holds one block at a time; a table with one row per range gives what lies before it. The
checkpoints are the documents' numbers of ids: a block is decoded as a whole.

Cases: null text is empty (the end id alone); a null id comes first; ids may have any type that
can be ordered; rows that repeat a document are written each by itself; an empty table gives
files without blocks; a wrong checksum raises; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import stage
from .common import packed, portions
from .tokens import coder

VOCABULARY, END = "byte_bpe_50k.json", 2
SCALE = 22
LANES = 4096
BLOCK_IDS = 1 << 20
#: Ids of a range, on the average.
RANGE_IDS = 1 << 24
LOW = np.uint64(1 << 31)


def quantise(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of at least 1 for each counted id that add up to ``2**scale``."""
    total, size = int(counts.sum()), 1 << scale
    freq = np.maximum((counts.astype(object) * size // total).astype(np.int64), (counts > 0).astype(np.int64))
    over = int(freq.sum()) - size
    order = np.argsort(-freq, kind="stable")
    if over < 0:
        freq[order[0]] -= over
    for k in order:  # only ids rarer than 1 in 2**scale make the sum too large
        if over <= 0:
            break
        cut = min(over, int(freq[k]) - 1, max(1, int(freq[k]) // 2))
        freq[k] -= cut
        over -= cut
    return freq


class Table:
    """Frequencies, their running sums and the id of every slot."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.freq = np.zeros(int(ids.max()) + 1, np.uint64)
        self.freq[ids] = freq.astype(np.uint64)
        self.start = np.concatenate([[np.uint64(0)], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
        """Final states and code words; lane j codes ids j, j + lanes, ..., from the last to the first."""
        state = np.full(lanes, LOW, np.uint64)
        words = []
        bound = (LOW >> self.scale) << np.uint64(32)
        for at in reversed(range(0, len(ids), lanes)):
            part = ids[at:at + lanes]
            f, x = self.freq[part], state[:len(part)]
            full = x >= bound * f
            words.append(x[full].astype(np.uint32)[::-1])
            x = np.where(full, x >> np.uint64(32), x)
            quotient, rest = np.divmod(x, f)
            state[:len(part)] = (quotient << self.scale) + rest + self.start[part]
        out = np.concatenate(words)[::-1] if words else np.empty(0, np.uint32)
        return state, out

    def decode(self, n: int, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        state, lanes, used = state.copy(), len(state), 0
        mask = np.uint64((1 << int(self.scale)) - 1)
        out = np.empty(n, np.uint32)
        for at in range(0, n, lanes):
            x = state[:min(lanes, n - at)]
            low = x & mask
            found = self.slot[low]
            out[at:at + len(x)] = found
            x = self.freq[found] * (x >> self.scale) + low - self.start[found]
            short = np.flatnonzero(x < LOW)
            x[short] = (x[short] << np.uint64(32)) | words[used:used + len(short)]
            used += len(short)
            state[:len(x)] = x
        if used != len(words) or (state != LOW).any():
            raise ValueError("block does not end where it began")
        return out


def encode_ids(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """doc_id, tk and ids (16 bits each, end id included) of each row of ``docs``, written where the texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary).encode
        for batch in portions(batches, "text"):
            ids = [np.append(x, np.uint16(end)).astype("<u2").tobytes() for x in encode(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tk"], pa.array(ids, pa.binary())], names=["doc_id", "tk", "ids"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = packed(docs).select("key.doc_id", "key.tk", "text")
    return stage(rows.mapInArrow(run, f"doc_id {id_type}, tk bigint, ids binary"), "token-ids")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), "<u2"), minlength=1 << 16)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _blocks(ids: np.ndarray, freq: np.ndarray, block_ids: int, id_type: pa.DataType):
    """The blocks of one range, from its documents in order; a block is held at a time."""

    def block(table: Table, number: tuple[int, int], docs: list[tuple]) -> pa.RecordBatch:
        doc_ids, tks, raw = zip(*docs)
        values = np.frombuffer(b"".join(raw), "<u2").astype("<u4")
        state, words = table.encode(values, min(LANES, max(1, len(values))))
        row = [*number, list(doc_ids), list(tks), [len(x) // 2 for x in raw], len(values), state.astype("<u8").tobytes(), words.astype("<u4").tobytes(), zlib.crc32(values.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    names = ["range", "block", "doc_ids", "tks", "sizes", "n_ids", "states", "words", "ids_crc32"]
    types = [pa.int32(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, docs, held = TaskContext.get().partitionId(), 0, [], 0
        table = Table(ids, freq) if len(ids) else None
        for batch in batches:
            for doc in zip(*(batch[c].to_pylist() for c in ("doc_id", "tk", "ids"))):
                docs.append(doc)
                held += len(doc[2]) // 2
                if held >= block_ids:
                    yield block(table, (part, number), docs)
                    number, docs, held = number + 1, [], 0
        if docs:
            yield block(table, (part, number), docs)

    return run


def write_files(found: DataFrame, folder: str, block_ids: int = BLOCK_IDS, range_ids: int = RANGE_IDS) -> None:
    """Count, quantise and encode the ids of ``encode_ids`` into ``folder``."""
    spark = found.sparkSession
    # One row per id of the vocabulary.
    counted = found.select("ids").mapInArrow(_counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toArrow()
    ids, n = (counted[c].to_numpy() for c in ("id", "n"))
    freq = quantise(n) if len(n) else np.empty(0, np.int64)
    spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "frequency": pa.array(freq, pa.int64())})).coalesce(1).write.parquet(f"{folder}/table")
    # Ranges in order of the ids; their borders only decide how even the ranges are.
    ranges = max(1, math.ceil(int(n.sum()) / range_ids))
    dealt = found.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "tk").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tk")
    field = found.schema["doc_id"].dataType
    blocks = dealt.mapInArrow(
        _blocks(ids, freq, block_ids, to_arrow_type(field)),
        f"range int, block int, doc_ids array<{field.simpleString()}>, tks array<bigint>, sizes array<bigint>, n_ids bigint, states binary, words binary, ids_crc32 bigint")
    blocks.write.parquet(f"{folder}/blocks")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, tk, start (ids of all documents before), n_tokens, ids_crc32 and ids of each document, decoded."""
    table_rows = spark.read.parquet(f"{folder}/table").orderBy("id").toArrow()
    ids, freq = (table_rows[c].to_numpy() for c in ("id", "frequency"))
    blocks = spark.read.parquet(f"{folder}/blocks")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select("range", "block", "n_ids")
    ranges = heads.groupBy("range").agg(F.sum("n_ids").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = heads.withColumn("own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(ranges, "range").select(
        "range", "block", (F.col("base") + F.col("own")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(ids, freq) if len(ids) else None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch[c][k] for c in batch.schema.names}
                values = table.decode(row["n_ids"].as_py(), np.frombuffer(row["states"].as_buffer(), "<u8"), np.frombuffer(row["words"].as_buffer(), "<u4"))
                if zlib.crc32(values.astype("<u4").tobytes()) != row["ids_crc32"].as_py():
                    raise ValueError(f"range {row['range']}, block {row['block']}: wrong checksum")
                sizes = row["sizes"].values.to_numpy()
                ends = np.cumsum(sizes)
                parts = [values[e - n:e].astype("<u4") for e, n in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, row["tks"].values, pa.array(row["base"].as_py() + ends - sizes), pa.array(sizes),
                     pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["doc_id", "tk", "start", "n_tokens", "ids_crc32", "ids"])

    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.join(starts, ["range", "block"]).select("range", "block", "doc_ids", "tks", "sizes", "n_ids", "states", "words", "ids_crc32", "base").mapInArrow(
        run, f"doc_id {id_type}, tk bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
