"""Byte-level BPE over overlapping chunks of texts, and decoding.

Merges never cross a pre-token, so a text is split into pre-tokens and each is encoded alone.
Where a pre-token begins depends on the text from the beginning of the text; but once two scans
that began at different places agree on one border, they agree on all later ones, because the
pattern looks only forward. So long texts are encoded in parallel:

1. A text is cut into windows of ``chunk`` characters, each with the first ``overlap``
   characters of the next one. Windows are rows, spread over the cluster and pre-tokenised
   from their own beginning.
2. Borders are compared where windows overlap: the first border that both scans found, and that
   the text behind the window cannot move, is where the later window takes over. Borders behind
   white space do not count, so that a piece alone splits as it does within its text.
3. A text with an overlap where the scans found no common border (inside one very long
   pre-token) is cut anew with the windows on both sides joined, until all its overlaps have one.
4. The pieces between those borders are encoded, and their ids joined in order.

Texts of one window go straight to step 4. The pattern must match every character and a match
may depend on what follows by no more than the next character and the first ``LOOK`` characters
of the match, which holds for the given one. Decoding concatenates the bytes of the tokens.

Cases: null is an empty text, an empty text has no ids and decodes to no bytes; a pre-token is
never cut, however long; rows that repeat a document are encoded each by itself; an empty table
gives an empty result; other columns are not looked at; a null id stays null. Decoding null
gives null; an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
import functools
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import packed, portions

VOCABULARY = "byte_bpe_50k.tiktoken"
PATTERN = public_tokenizers.PATTERN
CHUNK = 1 << 15
OVERLAP = 512
LOOK = 3
#: The library's own splitter needs stack for each blank of a run; it has failed beyond 300,000 of them.
MOST_BLANKS = 10_000


def byte_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: itself where it prints, else the next free one from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.cache
def ranks(name: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of ranks, or of a byte-level file whose ids follow its merges, special tokens left out."""
    if name.endswith(".json"):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            found = json.load(file)
        byte, model = byte_alphabet(), found["model"]
        special = {t["content"] for t in found["added_tokens"]}
        out = {bytes(byte[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
        merged = [out[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{name}: ids do not follow the merges")
        return out
    with open(public_tokenizers.path(name), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Coder:
    """Ids and pre-token borders of pieces of text for one vocabulary file."""

    def __init__(self, name: str, pattern: str):
        self.library = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks(name), special_tokens={})
        # Takes everything: it gets one pre-token at a time.
        self.single = tiktoken.Encoding(name, pat_str=r"[\s\S]+", mergeable_ranks=ranks(name), special_tokens={})
        self.pattern = regex.compile(pattern)
        self.blanks = regex.compile(rf"\s{{{MOST_BLANKS}}}")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if len(text) > MOST_BLANKS and self.blanks.search(text):
            return np.concatenate([self.single.encode_to_numpy(part) for part in self.pattern.findall(text)])
        return self.library.encode_to_numpy(text)

    def borders(self, window: str, last: bool) -> np.ndarray:
        """Beginnings of pre-tokens that neither the text behind the window nor a cut there can move."""
        ends = np.cumsum([0, *map(len, self.pattern.findall(window))])
        if not last:  # a match that came near the end might have gone on
            sure = (ends[1:] < len(window)) & (ends[:-1] + LOOK <= len(window))
            ends = ends[:1 + int(np.argmin(np.append(sure, False)))]
        return np.array([p for p in ends.tolist() if 0 < p < len(window) and not window[p - 1].isspace()], np.int64)


@functools.cache
def coder(name: str, pattern: str) -> Coder:
    """The worker's coder, built once."""
    return Coder(name, pattern)


def _encoded(vocabulary: str, pattern: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary, pattern).encode
        for batch in portions(batches, "text"):
            ids = [encode(text) for text in batch["text"].to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), lists], names=[*kept, "ids"])

    return run


def _scan(vocabulary: str, pattern: str, overlap: int):
    """Absolute places of the borders in the first and in the last overlap of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = coder(vocabulary, pattern).borders
        for batch in portions(batches, "text"):
            head, tail = [], []
            for text, at, own, last in zip(*(batch[c].to_pylist() for c in ("text", "at", "own", "last"))):
                found = borders(text, last)
                head.append(at + found[found < overlap])
                tail.append(at + found[found >= own] if not last else found[:0])
            arrays = [pa.array([x.tolist() for x in places], pa.list_(pa.int64())) for places in (head, tail)]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["at"], *arrays], names=["row", "at", "head", "tail"])

    return run


def _windows(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """One row per window: its text, where it lies, how much of it is its own, whether the text ends there."""
    size = F.length("text")
    begin = F.sequence(F.lit(0), F.greatest(size - overlap - 1, F.lit(0)), F.lit(chunk))
    cut = F.transform(begin, lambda at: F.struct(
        at.cast("bigint").alias("at"), F.substring("text", at + 1, F.lit(chunk + overlap)).alias("text"),
        (at + chunk + overlap >= size).alias("last")))
    out = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "tk", F.explode(cut).alias("w"))
    return out.select("row", "doc_id", "tk", "w.at", "w.text", F.when(F.col("w.last"), F.length("w.text")).otherwise(chunk).alias("own"), "w.last")


def pieces(rows: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """row, doc_id, tk, at and text: long texts (doc_id, tk, text) cut where pre-tokens begin."""
    windows, done = stage(_windows(rows, chunk, overlap), "bpe-windows"), None
    order = Window.partitionBy("row").orderBy("at")
    while True:
        found = windows.select("row", "at", "text", "own", "last").mapInArrow(
            _scan(vocabulary, pattern, overlap), "row bigint, at bigint, head array<bigint>, tail array<bigint>")
        first = F.lag("at").over(order).isNull()
        cut = F.when(first, F.lit(0)).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(order), "head")))
        cuts = found.select("row", "at", cut.cast("bigint").alias("cut")).withColumn("until", F.lead("cut").over(order))
        cuts = cuts.withColumn("whole", F.min(F.col("cut").isNotNull()).over(Window.partitionBy("row")))
        # Windows without a border of their own belong to the window before.
        cuts = stage(cuts.withColumn("block", F.count("cut").over(order)), "bpe-cuts")
        named = windows.join(cuts, ["row", "at"])
        text = F.expr("substring(text, int(cut - at + 1), int(coalesce(until, at + length(text)) - cut))")
        ready = named.where("whole").select("row", "doc_id", "tk", "at", text.alias("text"))
        done = ready if done is None else done.unionByName(ready)
        if not cuts.where("NOT whole").take(1):
            return done
        part = F.struct("at", F.expr("IF(last, text, substring(text, 1, own))").alias("own_text"), "text", "own", "last")
        parts = named.where("NOT whole").groupBy("row", "block").agg(
            F.first("doc_id").alias("doc_id"), F.first("tk").alias("tk"), F.array_sort(F.collect_list(part)).alias("p"))
        end = F.element_at("p", -1)
        before = F.array_join(F.transform(F.slice("p", 1, F.size("p") - 1), lambda p: p["own_text"]), "")
        joined = parts.select("row", "doc_id", "tk", F.col("p")[0]["at"].alias("at"), F.concat(before, end["text"]).alias("text"),
                              (F.length(before) + end["own"]).alias("own"), end["last"].alias("last"))
        windows = stage(joined, "bpe-windows")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, tk (hash of the text) and ids (array of int) of each row of ``docs``."""
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is at least one character and at most a chunk")
    rows = packed(docs).select("key.doc_id", "key.tk", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    long = F.length("text") > chunk + overlap
    short = rows.where(~long).mapInArrow(_encoded(vocabulary, pattern, ["doc_id", "tk"]), f"doc_id {id_type}, tk bigint, ids array<int>")
    parts = pieces(rows.where(long), vocabulary, pattern, chunk, overlap).mapInArrow(
        _encoded(vocabulary, pattern, ["row", "doc_id", "tk", "at"]), f"row bigint, doc_id {id_type}, tk bigint, at bigint, ids array<int>")
    joined = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("tk").alias("tk"),
                                      F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    return short.unionByName(joined.select("doc_id", "tk", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))


@functools.cache
def tokens(name: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks(name).items()}


def decode(ids: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """The bytes that an array of ids stands for."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        token = tokens(vocabulary).__getitem__
        return pa.array([b"".join(map(token, x.values.to_pylist())) if x.is_valid else None for x in lists], pa.binary())

    return run(ids)
