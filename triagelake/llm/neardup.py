"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document's set are its distinct five-word shingles. One permutation spreads the shingles over
the ring of 32-bit numbers, a second one, circularly shifted by 0, 1, 2, ..., gives all
signature coordinates: coordinate k is the smallest ``P2(P1(shingle) + k)``. Both permutations
are fixed bijections of the ring. 128 coordinates in 32 bands of four make a pair of exactly
0.75 similarity miss every band with a chance of 5 in a million, more similar pairs less often.

1. Documents with equal sets fold into the one with the smallest id, so copies cost one row.
2. Bands with two or more different sets keep their members; all else leaves.
3. In each bucket of a band every member is a candidate with the smallest fold. Candidates whose
   signatures agree enough are verified on full sets; links make components (smallest label by
   alternating stars, every round written to shared storage).
4. Buckets of three or more that still hold several components are searched for the other pairs
   with array operations, in blocks of bounded size (a larger bucket is cut into blocks and every
   pair of blocks is one group): first a spanning forest of the most similar pairs of different
   components is passed on and verified. Then the members that still have a possible partner in
   another component bring their full sets to their blocks, where each such pair is verified in
   its first common band and the components are joined on the spot. So no link between
   components is lost, and no more links than members ever leave a block.

Cases: null, empty and blank texts have no set, link with nothing and are kept; fewer than five
words make one shingle of the whole sequence; rows that repeat a document share its result; a
null id sorts first. Sets are compared by 64-bit shingle hashes, fold by 128-bit set hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType

from ..session import stage
from .common import packed, portions

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Pairs that agree in fewer coordinates are not verified: 0.75 * 128 less seven standard deviations.
LEAST_AGREE = 61
BLOCK, BLOCK_SHINGLES = 512, 1 << 21
BLOCK_KEY = ["band", "bucket", "low", "high"]

_BASE = 0x9E3779B97F4A7C55  # odd, so its powers can be divided out again
_BYTES = np.arange(256)
_IS_BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _mix32(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers: odd multipliers and shifted differences can be undone."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


_VALUES = _mix64(_FOLDED.astype(np.uint64) + np.uint64(1))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for later texts."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word in order: polynomial hashes cut out of one running sum over the bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    edge = np.diff(_IS_BLANK[raw].astype(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers_up_to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[:len(raw)], out=sums[1:])
    return _mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, min(len(h), WORDS), np.uint64)
    for j in range(min(WORDS, len(h))):
        out = _mix64(out ^ h[j:j + n])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    first = _mix64(hashes).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(COORDINATES, dtype=np.uint32)[:, None]
    for at in range(0, len(first), 512):
        np.minimum(out, _mix32(first[None, at:at + 512] + shifts).min(axis=1), out=out)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, "text"):
        sizes, folds, bands, low = [], [], [], []
        for text in batch["text"].to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            if not len(found):
                folds.append(None), bands.append(None), low.append(None)
                continue
            folds.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            coordinates = signature(found)
            key = np.zeros(BANDS, np.uint64)
            for j in range(ROWS):
                key = _mix64(key ^ coordinates[j::ROWS].astype(np.uint64) + np.uint64(j + 1))
            bands.append(key.view(np.int64))
            low.append(coordinates.astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["tk"], pa.array(sizes, pa.int64()), pa.array(folds, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())],
            names=["doc_id", "tk", "n_shingles", "fold", "bands", "signature"])


def describe(docs: DataFrame) -> DataFrame:
    """key, n_shingles, fold (hash of the set), band keys and signature of each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = packed(docs).select("key.doc_id", "key.tk", "text")
    out = rows.mapInArrow(_describe, f"doc_id {id_type}, tk bigint, n_shingles bigint, fold binary, bands array<bigint>, signature binary")
    return out.select(F.struct("doc_id", "tk").alias("key"), "n_shingles", "fold", "bands", "signature")


# ---- candidate pairs ------------------------------------------------------------

class Block:
    """Members of one block of a bucket, or of two blocks that meet, in order of their folds."""

    def __init__(self, rows: pa.Table):
        columns = ["fold", "signature", "n_shingles", "label", "side", *(c for c in ("bands", "shingles") if c in rows.column_names)]
        order = rows["fold"].combine_chunks().to_numpy(zero_copy_only=False).argsort(kind="stable")
        taken = rows.select(columns).take(order)
        self.folds, labels = taken["fold"].to_pylist(), taken["label"].to_pylist()
        self.bits = np.frombuffer(b"".join(taken["signature"].to_pylist()), np.uint16).reshape(-1, COORDINATES)
        self.sizes, self.side = (taken[c].to_numpy() for c in ("n_shingles", "side"))
        number: dict[bytes, int] = {}
        self.label = np.array([number.setdefault(x, len(number)) for x in labels])
        self.bands = taken["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS) if "bands" in columns else None
        self.sets = [np.frombuffer(x, np.uint64) for x in taken["shingles"].to_pylist()] if "shingles" in columns else None
        self.band = rows["band"][0].as_py() if len(rows) else 0

    def pairs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """i, all j > i of other labels that may be linked with it, and in how many coordinates they agree."""
        for i in range(len(self.folds) - 1):
            rest = np.arange(i + 1, len(self.folds))
            rest = rest[((self.side[rest] != self.side[i]) | (self.side[i] < 0)) & (self.label[rest] != self.label[i])]
            low, high = np.minimum(self.sizes[rest], self.sizes[i]), np.maximum(self.sizes[rest], self.sizes[i])
            rest = rest[100 * low >= PERCENT * high]
            agree = (self.bits[rest] == self.bits[i]).sum(axis=1)
            rest, agree = rest[agree >= LEAST_AGREE], agree[agree >= LEAST_AGREE]
            if self.bands is not None:  # pairs that meet in several bands belong to the first
                own = (self.bands[rest] == self.bands[i]).argmax(axis=1) == self.band
                rest, agree = rest[own], agree[own]
            if len(rest):
                yield i, rest, agree

    def forest(self, linked=lambda i, j: True) -> list[tuple[int, int]]:
        """Pairs that join different labels and pass ``linked``, most similar first; never more than labels less one."""
        found = [(i, j, n) for i, rest, agree in self.pairs() for j, n in zip(rest.tolist(), agree.tolist())]
        parent = list(range(int(self.label.max(initial=-1)) + 1))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for i, j, _ in sorted(found, key=lambda p: (-p[2], p[0], p[1])):
            a, b = root(int(self.label[i])), root(int(self.label[j]))
            if a != b and linked(i, j):
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
        return out

    def links(self, found: list[tuple[int, int]]) -> pa.Table:
        return pa.table({"a": pa.array([self.folds[i] for i, _ in found], pa.binary()), "b": pa.array([self.folds[j] for _, j in found], pa.binary())})


def _likely(rows: pa.Table) -> pa.Table:
    """A spanning forest of the most similar pairs of different labels, by signature."""
    block = Block(rows)
    return block.links(block.forest())


def _partnered(rows: pa.Table) -> pa.Table:
    """The members that have a possible partner in their block."""
    block, named = Block(rows), set()
    for i, rest, _ in block.pairs():
        named.update([i, *rest.tolist()])
    kept = {block.folds[k] for k in named}
    return rows.filter(pa.array([x in kept for x in rows["fold"].to_pylist()], pa.bool_()))


def _united(rows: pa.Table) -> pa.Table:
    """Links that join the labels of a block, each verified on full sets: pairs whose labels are joined already are left out."""
    block = Block(rows)
    return block.links(block.forest(lambda i, j: _similar(block.sets[i], block.sets[j])))


def _blocked(members: DataFrame) -> DataFrame:
    """Members (band, bucket, ...) with ``low`` and ``high``, the blocks of their bucket that meet, and their side.

    A bucket is cut into blocks of about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles.
    """
    sizes = members.groupBy("band", "bucket").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    own = F.pmod(F.xxhash64("fold"), F.col("blocks"))
    # Block pair (low, high): with one block all is compared, else a member meets every other block and its own.
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, own).alias("low"), F.greatest(o, own).alias("high")))
    side = F.when(F.col("low") == F.col("high"), -1).when(F.col("low") == F.col("own"), 0).otherwise(1)
    dealt = members.join(sizes, ["band", "bucket"]).withColumn("own", own).select("*", F.inline(met))
    return dealt.withColumn("side", side).drop("own", "blocks")


def _candidates(members: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b by fold, from members (band, bucket, fold, n_shingles, signature, label)."""
    found = _blocked(members).groupBy(*BLOCK_KEY).applyInArrow(_likely, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _last_links(docs: DataFrame, folds: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) that join the different labels left in a bucket; no more rows than members leave a block."""
    blocked = _blocked(members)
    schema = ", ".join(f"{c} {t}" for c, t in blocked.dtypes)
    named = stage(blocked.groupBy(*BLOCK_KEY).applyInArrow(_partnered, schema), "neardup-partnered")
    whole = named.join(_sets(docs, folds, named.select("fold").distinct()), "fold")
    return whole.groupBy(*BLOCK_KEY).applyInArrow(_united, "a binary, b binary").distinct()


def _alike(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""
    side = lambda k: about.select(F.col("fold").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("signature").alias(f"signature_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    return both.where(sizes).where(_agree("signature_a", "signature_b") >= LEAST_AGREE).select("a", "b")


# ---- verification ---------------------------------------------------------------

@F.pandas_udf(IntegerType())
def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, COORDINATES) for s in (a, b))
    return pd.Series((x == y).sum(axis=1, dtype=np.int32))


@F.pandas_udf(BinaryType())
def _set_bytes(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: shingles(t).tobytes())


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    if len(x) > len(y):
        x, y = y, x
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


@F.pandas_udf(BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("fold").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("fold").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").where(_linked("set_a", "set_b")).select("a", "b")


def _sets(docs: DataFrame, folds: DataFrame, named: DataFrame) -> DataFrame:
    """fold and full set of each named fold, from the text of its first document."""
    wanted = folds.join(named, "fold", "left_semi").select("fold", "key")
    texts = packed(docs).select("key", "text").join(wanted, "key")
    return texts.dropDuplicates(["fold"]).select("fold", _set_bytes("text").alias("shingles"))


def _verified(docs: DataFrame, folds: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    return _verify(pairs, _sets(docs, folds, pairs.select(F.explode(F.array("a", "b")).alias("fold")).distinct()))


# ---- components -----------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """node and label (smallest node of its component) of every node in links (a, b).

    Alternating stars: every node sends its larger neighbours to the smallest node around it
    (large star), then its smaller ones (small star), until nothing changes.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, both).where("w > m").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large, large).select(F.explode(F.array(F.struct(F.col("w").alias("u"), F.col("m").alias("v")),
                                                            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = stage(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        # Stars are final once a round changes no edge.
        state, before = _state(new), state
        if state == before:
            return new.select(F.col("u").alias("node"), F.col("v").alias("label"))
        edges = new


def _state(edges: DataFrame) -> tuple:
    """Number of edges and sum of their hashes: two sets of edges that agree in both are taken as equal."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _merge(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after further written links (a, b): only the components that they join are searched again."""
    if not links.take(1):
        return label
    named = lambda k: label.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}"))
    both = links.join(named("a"), "a", "left").join(named("b"), "b", "left")
    above = components(both.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")))
    over = above.select(F.col("node").alias("label"), F.col("label").alias("over"))
    # A smallest node is no row of ``label``, so the rows of ``above`` are new ones.
    return stage(label.join(over, "label", "left").select("node", F.coalesce("over", "label").alias("label")).unionByName(above), "neardup-labels")


def _mixed(members: DataFrame, label: DataFrame) -> DataFrame:
    """The members, with their label, of buckets that hold several labels; written."""
    named = members.join(label.withColumnRenamed("node", "fold"), "fold", "left").withColumn("label", F.coalesce("label", "fold"))
    several = named.groupBy("band", "bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return stage(named.join(several.select("band", "bucket"), ["band", "bucket"], "left_semi"), "neardup-mixed")


def _star(edges: DataFrame, sides: DataFrame) -> DataFrame:
    """u, each neighbour w of u, and m, the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return sides.select("u", F.col("v").alias("w")).join(least, "u")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """key, n_shingles, component (smallest key reachable) and kept for every row of ``docs``."""
    rows = stage(describe(docs), "neardup-rows")
    folds = stage(rows.where("fold IS NOT NULL").groupBy("fold").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("signature").alias("signature")), "neardup-folds")
    exploded = folds.select("fold", F.posexplode("bands").alias("band", "bucket"))
    shared = exploded.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(exploded.join(shared, ["band", "bucket"]), "neardup-members")
    about = folds.join(members.select("fold").distinct(), "fold", "left_semi").select("fold", "n_shingles", "signature")
    about = stage(about, "neardup-about")

    # Every member of a band bucket with the smallest fold there: one candidate per member.
    centre = members.groupBy("band", "bucket").agg(F.min("fold").alias("a"))
    tested = stage(_alike(members.join(centre, ["band", "bucket"]).where("fold <> a").select("a", F.col("fold").alias("b")).distinct(), about), "neardup-pairs")
    label = stage(components(stage(_verified(docs, folds, tested), "neardup-links")), "neardup-labels")

    # Larger buckets that still hold several components: the most similar pairs first, then all that are left.
    mixed = _mixed(members.where("n > 2").drop("n"), label)
    if mixed.take(1):
        rest = stage(_candidates(mixed.join(about, "fold")).join(tested, ["a", "b"], "left_anti"), "neardup-pairs")
        label = _merge(label, stage(_verified(docs, folds, rest), "neardup-links"))
        mixed = _mixed(mixed.drop("label"), label)
    if mixed.take(1):
        about = about.join(folds.select("fold", "bands"), "fold")
        label = _merge(label, stage(_last_links(docs, folds, mixed.join(about, "fold")), "neardup-links"))

    firsts = folds.select("fold", F.col("key").alias("own")).join(label.withColumnRenamed("node", "fold"), "fold", "left")
    firsts = firsts.withColumn("label", F.coalesce("label", "fold"))
    least = firsts.groupBy("label").agg(F.min("own").alias("component"))
    named = stage(firsts.join(least, "label").select("fold", "component"), "neardup-components")
    out = rows.select("key", "n_shingles", "fold").join(named, "fold", "left").withColumn("component", F.coalesce("component", "key"))
    return out.select("key", "n_shingles", "component", (F.col("key") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the smallest id, once."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("key").distinct()
    return packed(docs).join(gone, "key", "left_anti").dropDuplicates(["key"]).select("row.*")
