"""Chunked byte-level BPE, alignment of two tokenizers, ranked search: all against brute force."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triagelake.llm import alignment, bpe, queries, ranking
from triagelake.llm.common import table

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, key string, row int, tk string, ids int, block int"
BIG = 9007199254740993  # no float holds it


def docs_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "k", 1, "x", 2, 3) for i, t in zip(ids or range(len(texts)), texts)], DOCS)


MILD = ["a", "word", "Unseenly", " ", " ", "'s", "1", "23", "!!", "ß", "ΑΣ", "<|endoftext|>", "漢字", "🙂", "\n", "_", "aaaa", "http://x.y"]


def odd_texts(n=40, seed=3, parts=None):
    rng = random.Random(seed)
    parts = parts or ["a", "word", "B", "é", " ", " ", "\n", "\t", "  ", "'s", "'ll", "'", "1", "23", "!!", "\x1c", "\xa0", "ß", "ΑΣ", "<|endoftext|>", "漢字", "\r\n",
             "🙂", "▁", "\x00", "…", "Ⅷ", "ﬁ"]
    return [None, "", " ", "\n", " \n ", "▁"] + ["".join(rng.choices(parts, k=rng.randint(1, 400))) for _ in range(n)]


# ---- byte-level BPE --------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (20, 20), (7, 3), (1 << 15, 512)])
def test_chunked_ids_equal_the_library(spark, library, chunk, overlap):
    texts = odd_texts() + ["x" * 500 + " tail  \n end", " " * 300 + "a", "\n " * 200 + "'s", "'" * 100 + "s" * 50 + "'ll" * 40, "ab" * 3 + " " * 40 + "漢" * 90]
    got = bpe.encode(docs_of(spark, texts), chunk=chunk, overlap=overlap).withColumn("raw", bpe.decode("ids")).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text), (chunk, text)
        assert bytes(r["raw"]) == text.encode()


def test_long_runs_need_joined_windows(spark, library):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc", k=2000)) + " mid " + "!" * 1500, " " * 3000, "w " * 1000 + "z" * 700 + " w" * 300]
    cut = bpe.pieces(bpe.packed(docs_of(spark, texts)).select("key.doc_id", "key.tk", "text"), chunk=100, overlap=10).collect()
    by = {}
    for r in sorted(cut, key=lambda r: (r["row"], r["at"])):
        by[r["doc_id"]] = by.get(r["doc_id"], "") + r["text"]
    assert by == dict(enumerate(texts))
    assert sum(r["doc_id"] == 2 for r in cut) > 10  # the parts with blanks are cut
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs_of(spark, texts), chunk=100, overlap=10).collect()}
    # The library's own splitter gives up on long blanks; one pre-token is one piece.
    assert got[1] == library._encode_single_piece(texts[1])
    assert got[0] == library.encode_ordinary(texts[0]) and got[2] == library.encode_ordinary(texts[2])


def test_bpe_ids_rows_and_empty_table(spark):
    docs = docs_of(spark, ["a b", "a b", "long " * 50, "long " * 50, None], [None, None, BIG, BIG, BIG + 1])
    got = bpe.encode(docs, chunk=20, overlap=10).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"])) for r in got) == [(0, 2), (0, 2), (BIG, 51), (BIG, 51), (BIG + 1, 0)]
    assert bpe.encode(docs.limit(0)).count() == 0
    assert spark.range(1).select(bpe.decode(F.lit(None).cast("array<int>")).alias("d")).first()["d"] is None


def test_bpe_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}
    got = queries.QUERIES["op12_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), digest)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ---- alignment -------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(60))
def test_irregular_groups_by_definition(seed):
    rng = random.Random(seed)
    total = rng.randint(1, 120)
    ends = [sorted({*rng.sample(range(1, total + 1), rng.randint(0, total)), total}) for _ in range(2)]
    if seed % 3 == 0:  # long one-to-one stretches with few breaks
        ends[1] = sorted({*ends[0]} ^ {*rng.sample(ends[0][:-1], min(2, len(ends[0]) - 1))})
    common = sorted(set(ends[0]) & set(ends[1]))
    expected = [[sum(low < e <= high for e in side) for low, high in zip([0, *common], common)] for side in ends]
    sizes = alignment.group_sizes(*map(np.array, ends))
    assert [x.tolist() for x in sizes] == expected


@pytest.mark.parametrize("most", [1, 3, 10, 10**6])
def test_links_by_definition(most):
    rng = np.random.default_rng(most)
    sizes = rng.integers(1, 6, (2, 50))
    ids = [rng.integers(0, 9, n.sum()) for n in sizes]
    expected, a, b = Counter(), 0, 0
    for n, m in sizes.T.tolist():
        expected.update((int(x), int(y)) for x in ids[0][a:a + n] for y in ids[1][b:b + m])
        a, b = a + n, b + m
    codes, times = alignment.links(*ids, *sizes, most=most)
    assert {(int(c) >> 32, int(c) & 0xFFFFFFFF): int(t) for c, t in zip(codes, times)} == expected


def brute_alignment(texts):
    """What the contract says, from the libraries alone, one tuple per text."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    char = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    rows, holds = [], Counter()
    for text in texts:
        a = [(k, bytes(char[c] for c in first.id_to_token(k))) for k in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = []
        for k in second.encode(text) if text else []:
            piece = second.id_to_piece(k)
            b.append((k, bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()))
        if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
            rows.append(([], Counter()))
            continue
        groups, at = [([], [])], [0, 0]
        while a or b:
            side = 0 if at[0] <= at[1] and a or not b else 1
            k, token = (a, b)[side].pop(0)
            groups[-1][side].append(k)
            at[side] += len(token)
            if at[0] == at[1]:
                groups.append(([], []))
        groups.pop()
        pairs = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holds.update(pairs.keys())
        rows.append((groups, pairs))
    best = {}
    for (x, _), n in holds.items():
        best[x] = max(best.get(x, 0), n)
    for groups, pairs in rows:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        yield (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(pairs.values()),
               sum(n for p, n in pairs.items() if holds[p] == best[p[0]]), sum(n * holds[p] for p, n in pairs.items()), text)


def rows_of(frame):
    return [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in frame.collect()]


@pytest.mark.parametrize("block_pairs", [1, 200, 10**6])
def test_alignment_equals_brute_force(spark, block_pairs):
    texts = odd_texts(20) + odd_texts(60, parts=MILD) + ["plain words and more words", "plain words and more words", "a" * 3000, "-" * 777, "漢字" * 50, "double  blanks", "tail "]
    got = alignment.link_counts(alignment.align(docs_of(spark, texts), block_pairs=block_pairs))
    expected = [(k, *x) for k, x in enumerate(brute_alignment([t or "" for t in texts]))]
    assert sorted(rows_of(got)) == sorted(expected)
    assert sum(x[1] > 0 for x in expected) > 20


def test_alignment_ids_rows_and_empty_table(spark):
    docs = docs_of(spark, ["one two", "one two", "one two", None], [None, BIG, BIG, BIG + 1])
    got = alignment.link_counts(alignment.align(docs)).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in got) == [(0, 2, 6), (BIG, 2, 6), (BIG, 2, 6), (BIG + 1, 0, 0)]
    assert alignment.link_counts(alignment.align(docs.limit(0))).count() == 0


def test_alignment_query_equals_brute_force(spark):
    docs = table(spark, FOLDER, "documents").collect()
    expected = brute_alignment([r["text"] or "" for r in docs])
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_tokenizer_alignment"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for r, x in zip(docs, expected):
        own = got[r["doc_id"]]
        assert tuple(own[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) == x[:6]
        assert own["groups_sha256"] == (hashlib.sha256(x[6].encode()).hexdigest() if x[6] else "")


# ---- ranked search ---------------------------------------------------------------

def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())


def brute_ranking(docs, items, top=50):
    """item: (doc_id, score) in order; ``docs`` and ``items`` are lists of (id, text)."""
    counted = [(k, Counter(w)) for k, w in ((k, words_of(t)) for k, t in docs) if w]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    for item, text in items:
        scores = []
        for doc_id, c in counted:
            m = 50 + 50 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words_of(text)) if c[t])
            if s:
                scores.append((-s, doc_id is not None, doc_id or 0))
        yield item, [(d if has else None, -s) for s, has, d in sorted(scores)[:top]]


def items_of(spark, items):
    return spark.createDataFrame([(k, t, 1, 2, "x") for k, t in items], "item_id long, text string, block int, score int, terms string")


@pytest.mark.parametrize("top, block_bytes, tile", [(3, 1 << 20, 64), (50, 200, 2), (2, 1, 1)])
def test_ranking_equals_brute_force(spark, monkeypatch, top, block_bytes, tile):
    monkeypatch.setattr(ranking, "TILE_ITEMS", tile)
    monkeypatch.setattr(ranking, "TILE_DOCS", 7)
    monkeypatch.setattr(ranking, "TILE_TERMS", 3)
    rng = random.Random(top)
    vocabulary = ["a", "B", "b", "é", "É", "x1", "漢", "the", "THE", "rare", "w" * 50]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "--", "\n", "\x00"]) for _ in range(n))
    docs = [(k, text(rng.randint(0, 60))) for k in range(150)] + [(BIG, "rare a"), (BIG, "rare a"), (None, "rare a"), (400, None), (401, ""), (402, "!?")]
    docs += [(500 + k, "the same words") for k in range(60)] + [(600, "the " * 30_000)]
    items = [(k, text(rng.randint(1, 12))) for k in range(9)] + [(20, None), (21, "unseen"), (22, "the same words"), (None, "rare")]
    got: dict = {}
    frame = ranking.search(docs_of(spark, [t for _, t in docs], [k for k, _ in docs]), items_of(spark, items), top, block_bytes)
    for r in frame.orderBy("item_id", "rank").collect():
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    expected = {k: [(n + 1, *x) for n, x in enumerate(found)] for k, found in brute_ranking(docs, items, top) if found}
    assert got == expected


def test_ranking_rows_of_items_and_empty_tables(spark):
    docs, items = docs_of(spark, ["a b", "b c"]), items_of(spark, [(1, "a"), (1, "a"), (1, "c")])
    got = ranking.search(docs, items).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"]) for r in got) == [(1, 1, 0), (1, 1, 1)]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs_of(spark, [None, "!"]), items)):
        assert ranking.search(d, i).collect() == []


def test_partial_sums_stay_exact():
    rng = np.random.default_rng(1)
    weights = np.full(400, 2**30)
    depth = ranking.depth_of(weights)
    assert depth < 400 and depth * int(weights.max()) * ranking.MOST_IMPACT < 2**53 <= (depth + 1) * int(weights.max()) * ranking.MOST_IMPACT
    impacts = rng.integers(ranking.MOST_IMPACT - 9, ranking.MOST_IMPACT, 400)
    tiles = ranking.Tiles([np.arange(400), np.arange(0, 400, 2)], weights)
    scores = next(tiles.scores(np.zeros(400, np.int64), np.arange(400), impacts, 1))
    assert scores.tolist() == [[sum(2**30 * int(x) for x in impacts), sum(2**30 * int(x) for x in impacts[::2])]]


def test_best_keeps_the_first_of_equals():
    for seed in range(50):
        rng = np.random.default_rng(seed)
        scores = rng.integers(0, 5, 40)
        expected = sorted(np.flatnonzero(scores > 0), key=lambda k: (-scores[k], k))[:7]
        assert sorted(ranking.best(scores, 7)) == sorted(expected)
