"""Alignment of two tokenizers on the same text, by diagonal run skipping, and corpus-wide links.

Tokens of A and B are put in groups: the smallest stretches of tokens that cover the same bytes.
The two sorted arrays of token ends are compared at the current index shift (B place less A
place) over stretches that double in length while they agree and halve when they do not, down to
a few tokens, so long one-to-one stretches cost a few comparisons. Where the ends differ, the group is resolved
locally (the side that is behind advances until both end together) and the shift is updated.

A link is a pair of token occurrences, one of A and one of B, in one group. An id pair's count
is the number of documents that hold it linked. Documents are counted in blocks of bounded size:
each block keeps one row per distinct pair, so a pair that every document holds is one row a
block. These rows are summed over the corpus, joined with the sums, and brought back to their
block's documents. Nothing is broadcast or collected.

A is byte-level (its entries decoded by the byte alphabet) and encodes a blank and the text, with
strings of special tokens as ordinary text; its file lists the merges in the order of their ids,
so the entries are the ranks of ``bpe.Coder``. B is a piece model that adds the blank itself.

Cases: null and empty texts, and texts whose tokens of A or B do not join to a blank and the text
(B may change characters or blanks), have no tokens: all counts 0 and empty groups; each row is a
document of its own, also where rows repeat; a null id stays null; an empty table gives an empty
result; other columns are not looked at. Groups of very many tokens are expanded in parts of
bounded size and by distinct ids.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from . import bpe
from .common import packed, portions

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block of documents ends when it holds so many distinct pairs, counted per document.
BLOCK_PAIRS = 2_000_000
#: Links that are expanded at a time.
MOST_LINKS = 2_000_000
#: Probing begins with so many tokens.
SHORT = 4
#: A pair's code: A id << SHIFT | B id.
SHIFT = 32


class Pair:
    """Ids and bytes of both tokenizers."""

    def __init__(self, name_a: str, name_b: str):
        self.a = bpe.Coder(name_a, bpe.PATTERN)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name_b))
        self.bytes_a = [token for token, _ in sorted(bpe.ranks(name_a).items(), key=lambda x: x[1])]
        self.bytes_b = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode())
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        # Digits with what follows them: another token of the side, the end of the side's part of the group.
        self.digits = [f"{k}{end}" for k in range(len(self.bytes_a)) for end in ",|"] + [f"{k}{end}" for k in range(len(self.bytes_b)) for end in ",;"]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B for each text; None where the bytes are not those of a blank and the text."""
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1)):
            raw, ids = b" " + text.encode(), self.a.encode(" " + text)
            # Byte-level tokens can only be those of the text; pieces may not.
            same = int(self.sizes_a[ids].sum()) == len(raw) and b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw
            yield (ids, np.array(ids_b, np.int64)) if text and same else None


@functools.cache
def pair(name_a: str, name_b: str) -> Pair:
    """The worker's tokenizers, built once."""
    return Pair(name_a, name_b)


def irregular(ends_a: list[int], ends_b: list[int]) -> list[int]:
    """First and last place in A, first and last place in B of each group that is not one to one, all in one list.

    Both lists rise and have the same last number.
    """
    out: list[int] = []
    i = j = 0
    n = len(ends_a)
    while i < n:
        step = SHORT
        while ends_a[i:i + step] == ends_b[j:j + step]:
            i += step
            j += step
            step *= 2
            if i >= n:
                return out
        while step > SHORT:
            step //= 2
            if ends_a[i:i + step] == ends_b[j:j + step]:
                i += step
                j += step
        while ends_a[i] == ends_b[j]:
            i += 1
            j += 1
        x, y = i, j
        a, b = ends_a[x], ends_b[y]
        while a != b:
            if a < b:
                x += 1
                a = ends_a[x]
            else:
                y += 1
                b = ends_b[y]
        out += (i, x, j, y)
        i, j = x + 1, y + 1
    return out


def group_sizes(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group."""
    found = np.array(irregular(ends_a.tolist(), ends_b.tolist()), np.int64).reshape(-1, 4)
    sizes = []
    for n, first, last in ((len(ends_a), found[:, 0], found[:, 1]), (len(ends_b), found[:, 2], found[:, 3])):
        open_ = np.zeros(n + 1, np.int64)  # 1 where a token does not end its group
        np.add.at(open_, first, 1)
        np.subtract.at(open_, last, 1)
        sizes.append(np.diff(np.flatnonzero(np.cumsum(open_[:n]) == 0), prepend=-1))
    return sizes[0], sizes[1]


def _summed(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate(times))
    return found, total


def links(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, most: int = MOST_LINKS) -> tuple[np.ndarray, np.ndarray]:
    """Code and number of occurrences of each distinct linked id pair."""
    ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
    start_a, start_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
    n = sizes_a * sizes_b
    codes, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def put(code: np.ndarray, count: np.ndarray) -> None:
        codes.append(code), times.append(count)
        if sum(map(len, codes)) > 2 * most:
            both = _summed(codes, times)
            codes[:], times[:] = both[:1], both[1:]

    few = np.flatnonzero(n <= most)
    part = (np.cumsum(n[few]) - n[few]) // most
    for at in np.split(few, np.flatnonzero(np.diff(part)) + 1) if len(few) else []:
        count = n[at]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        width = np.repeat(sizes_b[at], count)
        a, b = np.repeat(start_a[at], count) + inside // width, np.repeat(start_b[at], count) + inside % width
        put(*np.unique(ids_a[a] << SHIFT | ids_b[b], return_counts=True))
    for g in np.flatnonzero(n > most):
        a, times_a = np.unique(ids_a[start_a[g]:start_a[g] + sizes_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[start_b[g]:start_b[g] + sizes_b[g]], return_counts=True)
        rows = max(1, most // len(b))
        for at in range(0, len(a), rows):
            put((a[at:at + rows, None] << SHIFT | b).ravel(), (times_a[at:at + rows, None] * times_b).ravel())
    return _summed(codes, times)


def written(both: Pair, ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> str:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""
    end_a, end_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    end_a[np.cumsum(sizes_a) - 1] = 1
    end_b[np.cumsum(sizes_b) - 1] = 1
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[np.arange(len(ids_a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)] = 2 * ids_a.astype(np.int64) + end_a
    code[np.arange(len(ids_b)) + np.repeat(np.cumsum(sizes_a), sizes_b)] = 2 * (len(both.bytes_a) + ids_b) + end_b
    return "".join(map(both.digits.__getitem__, code.tolist()))[:-1]


def _align(name_a: str, name_b: str, block_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, none = pair(name_a, name_b), np.empty(0, np.int64)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in portions(batches, "text", 4 << 20):
            rows = []
            for ids in both.encode(batch["text"].to_pylist()):
                if ids is None:
                    rows.append((block, 0, 0, 0, 0, "", none, none))
                    continue
                sizes = group_sizes(np.cumsum(both.sizes_a[ids[0]]), np.cumsum(both.sizes_b[ids[1]]))
                pairs, times = links(*ids, *sizes)
                rows.append((block, len(ids[0]), len(ids[1]), len(sizes[0]), int((sizes[0] * sizes[1]).sum()), written(both, *ids, *sizes), pairs, times))
                held += len(pairs)
                if held >= block_pairs:
                    block, held = block + 1, 0
            *numbers, groups, pairs, times = zip(*rows)
            offsets = np.cumsum([0, *map(len, pairs)]).astype(np.int32)
            lists = (pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *x]))) for x in (pairs, times))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tk"], *(pa.array(x, pa.int64()) for x in numbers), pa.array(groups, pa.string()), *lists],
                names=["doc_id", "tk", "block", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return run


def align(docs: DataFrame, name_a: str = VOCABULARY_A, name_b: str = VOCABULARY_B, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """doc_id, tk, n_a, n_b, n_groups, n_links and groups of each row, and what ``link_counts`` needs: block, pairs and times."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return packed(docs).select("key.doc_id", "key.tk", "text").mapInArrow(
        _align(name_a, name_b, block_pairs), f"doc_id {id_type}, tk bigint, block bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups string, pairs array<bigint>, times array<bigint>")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, pair and the number of its documents that hold the pair."""
    for batch in batches:
        block = batch["block"].to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(batch["pairs"]).to_numpy(zero_copy_only=False))]).astype(np.int64)
        pairs = batch["pairs"].flatten().to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for at, until in zip(cuts, cuts[1:]):
            found, n = np.unique(pairs[ends[at]:ends[until]], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), block[at] if len(block) else 0)), pa.array(found), pa.array(n)], names=["block", "pair", "n"])


def _look_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Links of each row whose count is the best of their A id, and the sum of the counts of its links."""
    pair_, count, best = (counts[c].to_numpy() for c in ("pair", "count", "best"))
    order = np.argsort(pair_)
    flat = lambda c: rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    at = order[np.searchsorted(pair_, flat("pairs"), sorter=order)]
    ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(rows["pairs"]).to_numpy())]).astype(np.int64)
    out = rows.drop_columns(["block", "pairs", "times"])
    for name, value in (("n_best", best[at].astype(np.int64)), ("count_sum", count[at])):
        sums = np.concatenate([[0], np.cumsum(value * flat("times"))])
        out = out.append_column(name, pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64()))
    return out


def link_counts(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` (with block, pairs, times) with n_best and count_sum in place of those columns."""
    rows = stage(aligned, "aligned")
    partial = rows.select("block", "pairs").mapInArrow(_block_pairs, "block bigint, pair bigint, n bigint")
    # A block's rows may have come in several batches.
    partial = stage(partial.groupBy("block", "pair").agg(F.sum("n").alias("n")), "aligned-pairs")
    counts = partial.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", SHIFT))
    best = F.max("count").over(Window.partitionBy("a"))  # at most one row for each id of B
    counts = counts.select("pair", "count", (F.col("count") == best).alias("best"))
    looked = partial.select("block", "pair").join(counts, "pair")
    out = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c not in ("block", "pairs", "times")) + ", n_best bigint, count_sum bigint"
    return rows.groupBy("block").cogroup(looked.groupBy("block")).applyInArrow(_look_up, out)
