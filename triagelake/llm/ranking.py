"""Ranked lexical search: blocked dense products of item weights and document impacts.

Score of a document for an item: over the item's distinct terms, the sum of the term's weight
``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` times its impact in the document,
``(10**9 tf) div (1000 tf + 20 m)`` with ``m = 100 - 50 + (50 n N) div L``.

1. Items are dealt by hash to blocks of about ``BLOCK_BYTES`` of distinct terms; each block is a
   pass over the documents, so the vocabulary that a task needs stays small however many items
   there are (an item is never cut: a block is at least as large as its largest one).
2. One scan counts in every whole text the terms of the block's vocabulary and all terms, and is
   written: one row per document with term numbers and counts.
3. Document frequencies, N and L come from that table, over all its rows.
4. Tasks multiply tiles: impacts of ``TILE_DOCS`` documents over the compact vocabulary of
   ``TILE_ITEMS`` items, ``depth`` terms at a time, by the items' weights. Both are whole numbers
   in float64, and ``depth`` keeps every partial sum of a product below 2**53, so it is exact in
   whatever order it is added; products are added up as 64-bit integers.
5. Of each portion of documents the best ``top`` of an item leave the task, equal scores by
   ascending id, which can lose none of the best; the rest is ranking those rows, in two steps.

Cases: null and empty texts have no terms and count nowhere; an item without terms, or whose
terms occur in no document, has no rows; equal scores rank by id, a null id first; rows that
repeat a document are ranked one after the other; rows that repeat an item (id and text) give one
ranking, items that share an id but not the text are ranked apart; empty tables give an empty
result; other columns are not looked at. ``50 n N`` must fit 64 bits.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import letter_words, packed, portions

TOP = 50
BLOCK_BYTES = 2 << 20
TILE_ITEMS, TILE_DOCS, TILE_TERMS = 64, 512, 4096
#: Impacts stay below this: tf and m are at least 1 and 50.
MOST_IMPACT = 10**6
#: Bytes between terms become blanks, A-Z become a-z; bytes of non-ASCII characters stay.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
Vocabulary = dict[bytes, int]


def _count(vocabulary: Vocabulary):
    """doc_id, n (all terms), terms and counts (numbers of the vocabulary's terms that occur)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            sizes, terms, counts = [], [], []
            for text in batch["text"].to_pylist():
                words = text.translate(_FOLD).split()
                found = Counter(words)
                sizes.append(len(words))
                both = [(vocabulary[w], found[w]) for w in found.keys() & vocabulary.keys()]
                terms.append([t for t, _ in both])
                counts.append([c for _, c in both])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return run


def depth_of(weights: np.ndarray) -> int:
    """Terms per product such that no sum of so many products of weight and impact reaches 2**53."""
    most = int(weights.max(initial=0)) * MOST_IMPACT
    return max(1, min(TILE_TERMS, (2**53 - 1) // max(1, most)))


def best(scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest scores above 0; of equal ones the first in order."""
    found = np.flatnonzero(scores > 0)
    if len(found) > top:
        least = np.partition(scores[found], len(found) - top)[len(found) - top]
        above = found[scores[found] > least]
        found = np.concatenate([above, found[scores[found] == least][:top - len(above)]])
    return found


class Tiles:
    """Weights of some items (numbers of their terms) over the compact vocabulary of each tile of them."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        self.n_terms, self.depth, self.parts = len(weights), depth_of(weights), []
        for at in range(0, len(items), TILE_ITEMS):
            own = items[at:at + TILE_ITEMS]
            terms = np.unique(np.concatenate(own))
            tile = np.zeros((len(terms), len(own)))
            for k, item in enumerate(own):
                tile[np.searchsorted(terms, item), k] = weights[item]
            self.parts.append((terms, tile))

    def scores(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """For each tile the scores (documents x items) of ``n`` documents with these impacts."""
        for own, tile in self.parts:
            place = np.full(self.n_terms, -1, np.int64)
            place[own] = np.arange(len(own))
            column = place[terms]
            total = np.zeros((n, tile.shape[1]), np.int64)
            for at in range(0, len(tile), self.depth):
                here = (column >= at) & (column < at + self.depth)
                dense = np.zeros((n, min(self.depth, len(tile) - at)))
                dense[rows[here], column[here] - at] = impacts[here]
                total += (dense @ tile[at:at + self.depth]).astype(np.int64)
            yield total


def _rank(ids: pa.Table, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """The columns of ``ids`` (one row an item), doc_id and score of the best documents of each portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(items, weights)
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch, sort_keys=[("doc_id", "ascending")], null_placement="at_start"))
            sizes = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            terms, tf = (batch[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "counts"))
            m = 50 + 50 * batch["n"].to_numpy(zero_copy_only=False) * n_docs // n_terms
            rows = np.repeat(np.arange(len(sizes)), sizes)
            impacts = 10**9 * tf // (1000 * tf + 20 * m[rows])
            whole: list[list[np.ndarray]] = [[] for _ in tiles.parts]
            for at in range(0, len(sizes), TILE_DOCS):
                until = min(at + TILE_DOCS, len(sizes))
                part = slice(ends[at], ends[until])
                for scored, scores in zip(whole, tiles.scores(rows[part] - at, terms[part], impacts[part], until - at)):
                    scored.append(scores)
            item, place, score = [], [], []
            for k, scored in enumerate(whole):
                scores = np.concatenate(scored)
                for j in range(scores.shape[1]):
                    found = best(scores[:, j], top)
                    item.append(np.full(len(found), k * TILE_ITEMS + j)), place.append(found), score.append(scores[found, j])
            named = ids.take(np.concatenate(item)).combine_chunks()
            columns = [*(c.combine_chunks() for c in named.columns), batch["doc_id"].take(pa.array(np.concatenate(place)))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(score))], names=[*ids.column_names, "doc_id", "score"])

    return run


def _block(docs: DataFrame, block: DataFrame, top: int) -> DataFrame:
    """item_id, item_tk, doc_id and score for the items of one block (item_id, item_tk, terms), some more than the best."""
    listed = block.toArrow()  # as many bytes as a block has
    vocabulary: Vocabulary = {}
    items = [np.array([vocabulary.setdefault(t.encode(), len(vocabulary)) for t in terms]) for terms in listed["terms"].to_pylist()]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = packed(docs).select("key.doc_id", F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(_count(vocabulary), f"doc_id {id_type}, n bigint, terms array<int>, counts array<bigint>")
    counted = stage(counted.where("n > 0"), "rank-counts")
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the vocabulary
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    fields = ", ".join(f"{c} {t}" for c, t in block.dtypes if c != "terms")
    return counted.where(F.size("terms") > 0).mapInArrow(
        _rank(listed.drop_columns("terms"), items, weights, n_docs, n_terms, top), f"{fields}, doc_id {id_type}, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, item_tk (hash of the item's text), rank, doc_id and score of the ``top`` documents of each item."""
    text = F.coalesce(F.col("text"), F.lit(""))
    asked = items.select("item_id", F.xxhash64(text).alias("item_tk"), F.array_distinct(letter_words(text)).alias("terms"))
    asked = asked.where(F.size("terms") > 0).dropDuplicates(["item_id", "item_tk"])
    size = F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t) + 16)
    blocks = max(1, math.ceil((asked.agg(F.sum(size)).first()[0] or 0) / block_bytes))
    dealt = stage(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "item_tk"), F.lit(blocks)).cast("int")), "rank-items", ["block"])
    found = None
    for k in range(blocks):
        block = dealt.where(F.col("block") == k).drop("block")
        if block.take(1):
            own = _block(docs, block, top)
            found = own if found is None else found.unionByName(own)
    if found is None:
        types = dict(dealt.dtypes) | dict(docs.select("doc_id").dtypes)
        found = docs.sparkSession.createDataFrame([], ", ".join(f"{c} {types[c]}" for c in ("item_id", "item_tk", "doc_id")) + ", score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    ranked = lambda *by: F.row_number().over(Window.partitionBy("item_id", "item_tk", *by).orderBy(*order))
    for part in (F.pmod(F.xxhash64("doc_id"), F.lit(64)), None):
        found = found.withColumn("rank", ranked(*([] if part is None else [part]))).where(F.col("rank") <= top)
    return found.select("item_id", "item_tk", "rank", "doc_id", "score")
