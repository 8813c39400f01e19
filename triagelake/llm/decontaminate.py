"""Benchmark decontamination with a positional inverted index over the training documents.

The index holds one posting (term, document, position) for every place of a term that the
benchmark uses, stored by document shards, so it is built where the documents are read and no
term, however frequent, gathers in one task. Every run of ``words`` words of a benchmark text
(a shorter text as a whole) is a phrase. A phrase is looked up from its rarest terms: the
postings of the rarest give starts (position less offset), these are intersected with the
offset-adjusted postings of the second rarest, and the few that survive with all others.
With ``slack`` a term may stand up to so many places from its offset (proximity match), and
``least`` of the terms suffice beside the two rarest; ``slack=0`` and all terms are exact
phrases.

Cases: null and empty texts have no words and no hits; a benchmark text without words is no
item; a null item id is the item ''; items that repeat an id are one item; rows that repeat a
document share its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import keyed, letter_words, packed

WORDS = 10
SLOTS = 1 << 20


def phrases(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """Distinct phrases: terms (array) and the items (array of strings) they come from."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), letter_words(F.coalesce("text", F.lit(""))).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - words, F.lit(0)))
    runs = items.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("at"))
    return runs.groupBy(F.slice("w", F.col("at") + 1, words).alias("terms")).agg(F.collect_set("item").alias("items"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (key, position, term) of the given terms, written once.

    ``terms`` has the columns word and term (number). Each document also has one posting of
    term -1 behind its last word, whose position is its number of words.
    """
    ends = terms.sparkSession.createDataFrame([("", -1)], "word string, term bigint")
    words = keyed(docs).select("key", F.posexplode(F.array_append(letter_words(F.col("text")), F.lit(""))).alias("position", "word"))
    known = stage(terms.unionByName(ends), "index-terms")  # small files: Spark broadcasts them below its own size limit
    return stage(words.join(known, "word").select("key", "position", "term"), "index-postings")


def matches(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, slack: int = 0, least: int | None = None) -> dict[str, DataFrame]:
    """``index``, ``phrases`` (phrase, items, n) and ``matches`` (key, phrase, start, n, found, exact)."""
    found = stage(phrases(benchmark, words), "phrases")
    vocabulary = found.select(F.explode("terms").alias("word")).distinct()
    vocabulary = stage(vocabulary.select("word", F.xxhash64("word").bitwiseAND(F.lit((1 << 62) - 1)).alias("term")), "phrase-terms")
    found = found.withColumn("phrase", F.xxhash64("terms"))
    index = build_index(docs, vocabulary)
    counts = index.groupBy("term").agg(F.count("*").alias("postings"))
    rank = Window.partitionBy("phrase").orderBy("postings", "offset")
    slots = (found.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "word"))
             .join(vocabulary, "word").join(counts, "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
             .select("phrase", "n", "offset", "term", "postings", F.row_number().over(rank).alias("rank"),
                     F.min("postings").over(Window.partitionBy("phrase")).alias("rarest")))
    least_of = F.least(F.col("n"), F.lit(least)) if least else F.col("n")
    if not (slack or least):
        slots = slots.where("rarest > 0")
    else:
        slots = slots.where("postings > 0").withColumn("rank", F.row_number().over(rank))
    slots = stage(slots.select("phrase", "n", "offset", "term", "rank"), "phrase-slots")

    shift = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
    starts = (index.join(slots.where("rank = 1"), "term")
              .select("key", "phrase", "n", (F.col("position") - F.col("offset")).alias("start")).where("start >= 0" if not slack else "true").distinct())
    second = slots.where("rank = 2")
    # Phrases of one term are done; the others need the second rarest term in its place.
    pairs = (starts.join(second.select("phrase", "offset", "term"), "phrase")
             .select("key", "phrase", "n", "start", "term", (F.col("start") + F.col("offset")).alias("due"), shift.alias("shift"))
             .withColumn("position", F.col("due") + F.col("shift")))
    of_second = index.join(second.select("term").distinct(), "term", "left_semi")
    pairs = pairs.join(of_second, ["key", "position", "term"]).groupBy("key", "phrase", "n", "start").agg(F.min(F.abs("shift")).alias("away"))
    pairs = stage(pairs, "phrase-pairs")
    rest = (pairs.join(slots.where("rank > 2").select("phrase", "offset", "term"), "phrase")
            .select("key", "phrase", "start", "term", "offset", shift.alias("shift"))
            .withColumn("position", F.col("start") + F.col("offset") + F.col("shift")))
    # Only documents with a pair matter: their hashed slots, of which there are SLOTS at most, sift the postings.
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS))
    near = index.withColumn("slot", slot).join(F.broadcast(pairs.select(slot.alias("slot")).distinct()), "slot", "left_semi")
    others = (rest.join(near, ["key", "position", "term"]).groupBy("key", "phrase", "start", "offset").agg(F.min(F.abs("shift")).alias("away"))
              .groupBy("key", "phrase", "start").agg(F.count("*").alias("others"), F.max("away").alias("others_away")))
    single = starts.where("n = 1").select("key", "phrase", "n", "start", F.lit(1).cast("long").alias("found"), F.lit(0).alias("away"))
    several = pairs.join(others, ["key", "phrase", "start"], "left").select(
        "key", "phrase", "n", "start", (2 + F.coalesce("others", F.lit(0))).cast("long").alias("found"),
        F.greatest("away", F.coalesce("others_away", F.lit(0))).alias("away"))
    result = several.unionByName(single).where(F.col("found") >= least_of).select(
        "key", "phrase", "start", "n", "found", ((F.col("found") == F.col("n")) & (F.col("away") == 0)).alias("exact"))
    return {"index": index, "phrases": found.select("phrase", "items", F.size("terms").alias("n")), "matches": stage(result, "phrase-matches")}


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """key, n_words, n_hit (words inside exact phrases), items (sorted) for every row of ``docs``."""
    parts = matches(docs, benchmark, words)
    exact = parts["matches"].where("exact")
    hit = (exact.select("key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("position")).distinct()
           .groupBy("key").agg(F.count("*").alias("n_hit")))
    items = (exact.select("key", "phrase").distinct().join(parts["phrases"], "phrase")
             .select("key", F.explode("items").alias("item")).groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    found = stage(hit.join(items, "key"), "contaminated")
    rows = parts["index"].where("term = -1").select("key", F.col("position").cast("long").alias("n_words"))
    return rows.join(found, "key", "left").select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark phrase, with all their columns."""
    hit = matches(docs, benchmark, words)["matches"].where("exact").select("key").distinct()
    return packed(docs).join(hit, "key", "left_anti").select("row.*")
