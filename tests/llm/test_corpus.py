"""Dedup, decontamination and quality operators on hand-made tables with the awkward cases."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from triagelake.llm import decontaminate, linededup, neardup, quality

DOCS = "doc_id long, text string, key string, row string, lang string, n_chars long"


def docs_of(spark, texts, ids=None):
    """A table with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "k", "r", None, None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def words(n, seed):
    return [f"w{x}" for x in random.Random(seed).sample(range(10**6), n)]


LONG = " ".join(words(60, 1))
OTHER = " ".join(words(55, 2))


@pytest.mark.parametrize("texts,gone", [
    ([LONG, "a b\n" + LONG + "\nc"], {1: [1]}),
    ([LONG + "\n\nshort line", "x\n" + LONG + "\n\nshort line\ny"], {1: [1, 2, 3]}),
    (["short\n" * 20, "short\n" * 20], {}),
    ([LONG + "\n" + LONG], {0: [1]}),
    ([LONG, LONG, None, ""], {1: [0]}),
    (["\n".join(words(30, 3)[k:k + 10][0] + " " + " ".join(words(30, 3)[k:k + 10]) for k in range(0, 30, 10)) + "\n" + OTHER, OTHER], {1: [0]}),
])
def test_line_dedup(spark, texts, gone):
    out = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(docs_of(spark, texts)).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        kept = [x for k, x in enumerate(lines) if k not in gone.get(i, [])]
        assert out[i]["text"] == "\n".join(kept) and out[i]["n_removed"] == len(gone.get(i, []))
    again = linededup.rewrite(docs_of(spark, texts))
    assert again.columns == docs_of(spark, texts).columns


def test_line_dedup_of_repeated_rows_and_empty_table(spark):
    rows = docs_of(spark, [LONG, LONG, LONG], [None, None, 5])
    out = linededup.dedup_lines(rows).select("row.doc_id", "n_removed").collect()
    assert sorted((str(r[0]), r[1]) for r in out) == [("5", 1), ("None", 0), ("None", 0)]
    assert linededup.dedup_lines(rows.limit(0)).count() == 0


def runs_that_came_before(texts, least):
    """Brute force: line numbers that lie in a run of ``least`` or more words found earlier, per text."""
    seen, gone = set(), []
    for text in texts:
        lines = [(k, x) for k, x in enumerate(text.split("\n")) if x.split()]
        out = set()
        for i in range(len(lines)):
            for e in range(i, len(lines)):
                run = tuple(x for _, x in lines[i:e + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        out |= set(range(lines[i][0], lines[e][0] + 1))
                    seen.add(run)
        gone.append(out)
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    # Few different lines: fingerprints are frequent, surroundings differ, runs overlap and repeat inside a text.
    pool = ["a", "b c", "d e f", "g", "", "h i"] if seed else ["a", "a", "b", ""]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(40)]
    texts += [texts[k] for k in (1, 2, 3)] + [texts[4] + "\nz\n" + texts[5]] * 3
    out = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(docs_of(spark, texts), min_words=7).collect()}
    for i, (text, gone) in enumerate(zip(texts, runs_that_came_before(texts, 7))):
        assert out[i]["text"] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), (i, gone)
        assert out[i]["n_removed"] == len(gone)


def test_fingerprints_are_few_and_cover_every_window(spark):
    texts = ["\n".join(" ".join(words(8, 1000 * d + k)) for k in range(200)) for d in range(5)]
    rows = linededup.packed(docs_of(spark, texts))
    found = linededup.fingerprints(rows).select("key.doc_id", "line").collect()
    assert len(found) < 0.35 * 1000
    for d in range(5):  # seven lines hold 56 words: each window has a selected line
        at = sorted(r["line"] for r in found if r["doc_id"] == d)
        assert at[0] < 7 and at[-1] >= 193 and all(y - x <= 7 for x, y in zip(at, at[1:]))


def jaccard_groups(texts):
    sets = []
    for t in texts:
        w = [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return [len(s) for s in sets], root


def test_near_duplicates_against_brute_force(spark):
    base, rng = words(120, 4), random.Random(5)
    texts = [" ".join(base), None, "", " \t", "one", "one", "a b c", "a b c", " ".join(words(40, 6))]
    for _ in range(40):  # variants around one original and around each other
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        texts.append(" ".join(w))
    sizes, root = jaccard_groups(texts)
    order = list(range(len(texts)))
    rng.shuffle(order)
    out = neardup.near_duplicates(docs_of(spark, [texts[i] for i in order], order)).select("key.doc_id", "n_shingles", "component.doc_id", "kept").collect()
    assert sorted(map(tuple, out)) == [(i, sizes[i], root[i], root[i] == i) for i in range(len(texts))]
    kept = neardup.keep_one(docs_of(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(len(texts)) if root[i] == i]
    assert kept.columns == docs_of(spark, texts).columns


def test_blocks_join_the_labels_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    texts = [" ".join(words(100, 7)[: 100 - 4 * k]) for k in range(20)] + [" ".join(words(60, 8) + words(50, k)) for k in range(20, 30)]
    docs = docs_of(spark, texts)
    folds = neardup.stage(neardup.describe(docs), "test-folds")
    members = folds.select(F.posexplode("bands").alias("band", "bucket"), "fold", "n_shingles", "signature", "bands", F.col("fold").alias("label"))
    found = neardup.stage(neardup._last_links(docs, folds, members), "test-links")
    label = neardup.components(found)
    of = {bytes(r["fold"]): r["key"]["doc_id"] for r in folds.collect()}
    groups: dict = {}
    for r in label.collect():
        groups.setdefault(bytes(r["label"]), {of[bytes(r["label"])]}).add(of[bytes(r["node"])])
    _, root = jaccard_groups(texts)
    assert {frozenset(g) for g in groups.values()} == {frozenset(i for i in range(30) if root[i] == r) for r in set(root) if root.count(r) > 1}
    sets = [set(neardup.shingles(t).tolist()) for t in texts]
    for r in found.collect():
        x, y = sets[of[bytes(r["a"])]], sets[of[bytes(r["b"])]]
        assert 100 * len(x & y) >= 75 * len(x | y)


def test_large_ids_beside_null_stay_exact(spark):
    big = 9007199254740993  # no float holds it
    rows = docs_of(spark, [LONG, LONG, "other words"], [None, big, big + 2])
    out = neardup.near_duplicates(rows).select("key.doc_id", "kept").collect()
    assert {tuple(r) for r in out} == {(None, True), (big, False), (big + 2, True)}
    assert {r["doc_id"] for r in neardup.keep_one(rows).collect()} == {None, big + 2}


def test_near_duplicates_of_repeated_rows_and_empty_table(spark):
    rows = docs_of(spark, [LONG, LONG, LONG], [3, 3, None])
    out = neardup.near_duplicates(rows).select("key.doc_id", "component.doc_id", "kept").collect()
    assert sorted(map(str, map(tuple, out))) == ["(3, None, False)", "(3, None, False)", "(None, None, True)"]
    assert neardup.near_duplicates(rows.limit(0)).count() == 0
    assert neardup.keep_one(docs_of(spark, ["a b", "a b"], [1, 1])).count() == 1


ITEMS = "item_id long, text string, key string"


def test_decontamination_exact_and_near(spark):
    item = words(14, 8)
    items = spark.createDataFrame([(2, " ".join(item), "k"), (10, "Tiny, item", "k"), (None, None, "k"), (10, " ", "k")], ITEMS)
    changed = item[:6] + ["other"] + item[7:]
    texts = ["x " + " ".join(item[2:12]).upper() + " y", "x " + " ".join(item[:9]), "a tiny-ITEM b tiny item", None, "", " ".join(changed)]
    out = decontaminate.contamination(docs_of(spark, texts), items).select("key.doc_id", "n_words", "n_hit", "items").collect()
    assert {r[0]: tuple(r[1:]) for r in out} == {0: (12, 10, ["2"]), 1: (10, 0, []), 2: (6, 4, ["10"]), 3: (0, 0, []), 4: (0, 0, []), 5: (14, 0, [])}
    near = decontaminate.matches(docs_of(spark, texts), items, least=9)["matches"].where("NOT exact")
    assert {r["key"]["doc_id"] for r in near.collect()} >= {5}
    shifted = " ".join(item[:5] + ["more"] + item[5:10])
    away = decontaminate.matches(docs_of(spark, [shifted]), items, slack=1)["matches"]
    assert away.where("NOT exact").count() > 0 and away.where("exact").count() == 0
    assert sorted(r[0] for r in decontaminate.remove_contaminated(docs_of(spark, texts), items).select("doc_id").collect()) == [1, 3, 4, 5]
    assert decontaminate.contamination(docs_of(spark, texts).limit(0), items).count() == 0
    assert decontaminate.contamination(docs_of(spark, texts), items.limit(0)).where("n_hit > 0").count() == 0


def test_lower_tail_is_the_binomial(spark):
    cases = [(n, k, p) for n in (1, 20, 500) for k in (0, 1, 3, 30) for p in (0.005, 0.2) if k <= n]
    rows = spark.createDataFrame(cases, "n long, k long, p double").select("n", "k", "p", quality.lower_tail(F.col("n"), F.col("k"), F.col("p")).alias("t"))
    for n, k, p, t in rows.collect():
        exact = 0.0 if k >= n * p else math.log(sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)))
        assert t == pytest.approx(exact, abs=1e-9)


def test_quality_counts_and_certified_cutoffs(spark):
    good, bad = " ".join(words(30, 9)), " ".join(w + "###" for w in words(30, 10))
    texts = [good] * 700 + [bad] * 100 + [None, "", "one two", "a b c d e " * 8]
    rows = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, 1 if i < 700 else 0) for i in range(800)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = {r["key"]["doc_id"]: r for r in quality.assess(rows, labels, risk=0.04).collect()}
    assert out[0]["kept"] and not out[750]["kept"] and not out[750]["base_failed"] and out[750]["n_symbols"] == 90
    assert [out[i]["base_failed"] for i in range(800, 804)] == [True] * 4 and out[803]["n_repeat_words"] == 40
    assert out[800]["n_words"] == 0 and len(out) == len(texts)
    none = quality.assess(rows, labels.limit(0)).where("kept").count()
    assert none == 800
    assert quality.keep_good(rows, labels, risk=0.04).count() == 700 and quality.keep_good(rows, labels).columns == rows.columns
    assert quality.assess(rows.limit(0), labels).count() == 0


def test_rules_spend_the_risk_together(spark):
    good, marked, shouted = " ".join(words(30, 9)), " ".join(w + "###" for w in words(30, 10)), " ".join(words(30, 11)).upper().replace("W", "LOUD")
    texts = [good] * 250 + [marked] * 20 + [shouted] * 15 + [good] * 40
    labels = spark.createDataFrame([(i, 1 if i < 250 else 0) for i in range(285)], "doc_id long, quality int")
    rows = docs_of(spark, texts)
    stats = quality.statistics(rows)
    assert [tuple(r)[0] for r in quality.cutoffs(stats, labels).select("n_rejected").collect()] == [0]
    kept = {r["key"]["doc_id"] for r in quality.assess(rows, labels).where("kept").collect()}
    assert kept == set(range(250)) | set(range(285, 325))
    # 216 good documents and four strata are one too few: (1 - 0.02) ** 216 > 0.05 / 4.
    few = labels.where("doc_id >= 54")
    assert quality.cutoffs(stats, few, delta=0.05 / 4).count() == 0
    assert quality.cutoffs(stats, labels.where("doc_id >= 33"), delta=0.05 / 4).count() == 1
    # Good documents that a loose step rejects end the sequence, whatever tighter steps would gain.
    wrong = labels.select("doc_id", F.when(F.col("doc_id").between(250, 269), 1).otherwise(F.col("quality")).alias("quality"))
    assert quality.cutoffs(stats, wrong).where("n_rejected > 0").count() == 0
