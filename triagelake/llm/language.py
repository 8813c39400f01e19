"""Language identification with string kernels on Nyström landmarks.

The kernel of two texts is the blended-spectrum presence kernel: for n = 1..4 the number of
character n-grams both contain, over the geometric mean of their own numbers, averaged over n.
Texts are lower-cased and read whole; n-grams are told apart by 64-bit hashes, so a text of
millions of characters keeps its n-grams apart as well. Some texts per language are landmarks:
only their n-grams have a column, the others of a text count in its norm. The sparse product of
the presence matrices of a batch and of the landmarks gives kernel rows. Their product with the
inverse square root of the landmarks' own kernel matrix gives Nyström vectors, which are scaled
to length one, so that the size of a text matters little. Kernel ridge regression, one language
versus the rest, is solved on those vectors; scoring is a product with its weights.

The classifier is fitted on a bounded sample, whatever the size of the table: of the learnable
documents of each language the ``SAMPLE`` with the smallest hashes (``MOST_SAMPLE`` over all
languages), of these ``LANDMARKS`` as landmarks (``MOST_LANDMARKS`` over all), first those of at
most ``LANDMARK_CHARS`` characters. A cut on the hash, from the approximate number of documents,
leaves about ``SPARE`` times as many to rank. Only the landmarks' texts and one kernel row per
document of the sample reach the driver.

Cases: a null text or one without a letter is ``und`` with score 0; without any learnable
document all are ``und``; rows that repeat a document get the same prediction and count once in
the sample, documents that share an id but not the text count separately; of more than
``MOST_LANGUAGES`` languages those with most documents are learnt, by name among equals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

NGRAMS = (1, 2, 3, 4)
LANDMARKS, MOST_LANDMARKS = 40, 1600
LANDMARK_CHARS = 5000
SAMPLE, MOST_SAMPLE = 400, 40_000
PLACES, SPARE = 1 << 62, 4
RIDGE = 1e-2
MOST_LANGUAGES = 200
_BATCH = 512


def _distinct(text: str) -> list[np.ndarray]:
    """The sorted hashes of the distinct n-grams of a text, for each n."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, mixed = [], np.zeros(len(code), np.uint64)
    for n in NGRAMS:
        # The hash of an n-gram is that of its first n - 1 characters mixed with the last.
        size = max(len(code) - n + 1, 0)
        mixed = (mixed[:size] ^ code[n - 1:]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        found.append(np.unique(mixed))
    return found


class Landmarks:
    """The presence matrix of the landmarks, by columns: for every n-gram the landmarks that hold it."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.columns = []
        for grams in zip(*map(_distinct, texts)):
            sizes = np.array([len(g) for g in grams])
            names, column = np.unique(np.concatenate(grams), return_inverse=True)
            rows = np.repeat(np.arange(self.n, dtype=np.int32), sizes)[np.argsort(column, kind="stable")]
            starts = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=len(names)))])
            self.columns.append((names, starts, rows, np.maximum(sizes, 1)))

    def kernel(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per landmark."""
        out = np.zeros((len(texts), self.n), np.float32)
        for row, text in zip(out, texts):
            for grams, (names, starts, rows, sizes) in zip(_distinct(text), self.columns):
                if len(grams) and len(names):
                    at = np.minimum(np.searchsorted(names, grams), len(names) - 1)
                    at = at[names[at] == grams]
                    count = starts[at + 1] - starts[at]
                    inside = np.arange(count.sum()) + np.repeat(starts[at] - np.cumsum(count) + count, count)
                    row += np.bincount(rows[inside], minlength=self.n) / np.sqrt(float(len(grams)) * sizes)
        return out / len(NGRAMS)


class Model:
    """Landmarks, their whitening, the ridge weights and the languages."""

    def __init__(self, landmarks: Landmarks, own: np.ndarray, kernel: np.ndarray, languages: list[str]):
        """``own``: kernel rows of the landmarks; ``kernel``: those of the sample, with their languages."""
        self.landmarks = landmarks
        self.names = sorted(set(languages))
        label = np.searchsorted(self.names, languages)
        values, vectors = np.linalg.eigh(own.astype(float))
        good = values > 1e-6 * values.max()
        self.whiten = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
        x = self._features(kernel)
        y = np.where(label[:, None] == np.arange(len(self.names)), 1.0, -1.0)
        weight = 1.0 / np.bincount(label, minlength=len(self.names))[label]  # languages count alike
        w = x * weight[:, None]
        gram = w.T @ x + RIDGE * np.eye(x.shape[1]) * weight.sum() / len(x)
        self.weights = np.linalg.solve(gram, w.T @ y).astype(np.float32)

    def _features(self, kernel: np.ndarray) -> np.ndarray:
        x = kernel @ self.whiten
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and the share of the best among all one-versus-rest outputs (softmax)."""
        raw = self._features(self.landmarks.kernel(texts)) @ self.weights
        soft = np.exp(3 * (raw - raw.max(axis=1, keepdims=True)))
        soft /= soft.sum(axis=1, keepdims=True)
        best = raw.argmax(axis=1)
        return [self.names[k] for k in best], soft[np.arange(len(raw)), best].astype(float)


def held_out(doc_id: Column) -> Column:
    """Documents never learnt from: crc32 of the id as text, modulo 4, is 2. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` documents of each language, None if there is nothing to learn from."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}"))).select(
        "lang", "text", F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(PLACES)).alias("place"))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).orderBy(
        F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return None
    sample, chosen = min(sample, MOST_SAMPLE // len(sizes)), min(LANDMARKS, MOST_LANDMARKS // len(sizes))
    # Below the cut lie about SPARE samples of each language, however large the table, so ranking them is a small job.
    near = F.lit(False)
    for lang, n in sizes:
        near = near | ((F.col("lang") == lang) & (F.col("place") <= min(PLACES, SPARE * sample * PLACES // max(1, n))))
    each = Window.partitionBy("lang")
    keys = usable.select("lang", "place", (F.length("text") > LANDMARK_CHARS).alias("long")).where(near).distinct()
    keys = keys.withColumn("r", F.row_number().over(each.orderBy("place"))).where(F.col("r") <= sample)
    keys = keys.withColumn("first", F.row_number().over(each.orderBy("long", "place")) <= chosen)
    rows = usable.join(F.broadcast(keys.select("lang", "place", "first")), ["lang", "place"]).dropDuplicates(["lang", "place"])
    rows = stage(rows, "language-sample")
    first = rows.where("first").orderBy("lang", "place").collect()
    if not first:
        return None
    landmarks = Landmarks([r["text"] for r in first])

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(landmarks.kernel(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["place"], pa.array(found, pa.list_(pa.float32()))],
                                             names=["lang", "place", "kernel"])

    known = rows.select("lang", "place", "text").mapInArrow(kernels, "lang string, place long, kernel array<float>")
    known = known.orderBy("lang", "place").collect()
    own = landmarks.kernel([r["text"] for r in first])
    return Model(landmarks, own, np.array([r["kernel"] for r in known], np.float32), [r["lang"] for r in known])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            known = [k for k, t in enumerate(texts) if model and any(map(str.isalpha, t))]
            for at in range(0, len(known), _BATCH):
                some = known[at:at + _BATCH]
                names[some], scores[some] = model.predict([texts[k] for k in some])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        predict, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
