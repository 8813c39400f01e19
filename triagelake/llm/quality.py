"""Quality rules whose cut-offs carry a proven bound on false rejections.

Every document gets text statistics. A rule rejects a document whose statistic reaches a
cut-off. The cut-offs of all rules tighten together in a sequence of steps that is fixed
beforehand; nothing is fitted on the labelled documents (the holdout). There each step is
tested, per stratum and from the loosest to tighter ones, against the hypothesis that all its
rules together reject more than ``risk`` of the good documents. The test is the exact lower
binomial tail; its level is ``delta`` divided by the number of strata (Bonferroni), and testing
stops at the first step that does not pass (fixed sequence, so steps cost no further
correction). With probability ``1 - delta`` at most ``risk`` of the good documents of every
stratum are thus falsely rejected. Among certified steps the one that rejects most bad less
good documents is used, the loosest of equals; none is used where none gains. With four strata
a step without a false rejection needs 217 labelled good documents.

Cases: null and empty texts have no words and fail the base rule; a null stratum value is a
stratum of its own; a document labelled both ways counts as bad, a null label is ignored;
without labels, or with too few for the level, only the base rule rejects. Rows that repeat a
document get the same verdict. Windows are compared by 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import blank_words, packed

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5  # the hashing in statistics() is written for five words
RISK, DELTA = 0.02, 0.05
#: Cut-offs of the rules, step by step from the loosest on.
STEPS = {
    "symbols": [0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02],
    "capitals": [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35],
    "dup_lines": [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35],
    "repeats": [0.2, 0.195, 0.19, 0.185, 0.18, 0.175, 0.17, 0.165, 0.16, 0.155, 0.15, 0.145, 0.14],
}
N_STEPS = len(STEPS["symbols"])
#: Rule name -> statistic in 0..1 that grows with the fault.
RULES = {
    "symbols": lambda: _share("n_symbols", "word_chars"),
    "capitals": lambda: _share("n_capitals", "word_chars"),
    "dup_lines": lambda: _share("n_dup_lines", "n_lines"),
    "repeats": lambda: _share("n_repeat_words", "n_words"),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def _repeat_words(grams: Column) -> Column:
    """Words inside windows that occur twice or more: equal neighbours after sorting by hash."""
    pairs = F.col("sorted_grams")
    n = F.size(pairs)
    twice = F.zip_with(F.slice(pairs, 1, n - 1), F.slice(pairs, 2, n - 1), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    starts = F.sort_array(F.array_distinct(F.flatten(twice)))
    none = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(starts, none, lambda a, x: F.struct(
        x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total")))["total"]


def _beside(left: str, right: str, by: int) -> Column:
    """Hash of each element of ``left`` with the one ``by`` places further on in ``right``; none beyond its end."""
    n = F.greatest(F.size(right) - by, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, by + 1, n), lambda a, b: F.xxhash64(a, b))


def statistics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """key, stratum and the counts of each row; row-local, nothing is shuffled."""
    rows = packed(docs).select(
        "key", F.col(f"row.{stratum}").cast("string").alias("stratum"), "text", blank_words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("pairs", _beside("hashes", "hashes", 1))
    rows = rows.withColumn("fours", _beside("pairs", "pairs", 2))
    grams = _beside("fours", "hashes", 4)
    rows = rows.select(
        "key", "stratum", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), grams.alias("grams"))
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    rows = rows.withColumn("sorted_grams", F.when(repeated, F.sort_array(F.transform(
        "grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    return rows.select(
        "key", "stratum", "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines",
        F.coalesce(F.when(F.col("sorted_grams").isNotNull(), _repeat_words(F.col("sorted_grams"))), F.lit(0))
        .cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def lower_tail(n: Column, k: Column, risk: Column) -> Column:
    """ln P(Binomial(n, risk) <= k) for k below the mean, summed in logarithms; 0 from the mean on."""
    odds = F.log(risk) - F.log(1 - risk)
    first = n * F.log(1 - risk)
    total = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(first.alias("term"), first.alias("total")),
        lambda a, j: _next_term(a, j, n, odds))["total"]
    return F.when(k >= n * risk, F.lit(0.0)).when(k == 0, first).otherwise(total)


def _next_term(acc: Column, j: Column, n: Column, odds: Column) -> Column:
    term = acc["term"] + F.log((n - j + 1) / j) + odds
    return F.struct(term.alias("term"), (term + F.log1p(F.exp(acc["total"] - term))).alias("total"))


def first_step() -> Column:
    """The first step, from 0, at which a rule rejects a document; ``N_STEPS`` if none does."""
    return F.least(*[
        F.size(F.filter(F.array(*[F.lit(x) for x in STEPS[r]]), lambda c: c > value())) for r, value in RULES.items()])


def cutoffs(stats: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, step, n_good and n_rejected of the certified step in use, for strata that have one."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    held = (stats.where(~base_failed()).withColumn("doc_id", F.col("key.doc_id")).join(marks, "doc_id")
            .select(F.coalesce("stratum", F.lit("")).alias("s"), F.col("stratum").isNull().alias("none"), "quality", first_step().alias("step"))
            .groupBy("s", "none", "step")
            .agg(F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("quality") > 0, 0).otherwise(1)).alias("bad")))
    held = stage(held, "quality-holdout")  # at most one row per stratum and step
    strata = max(1, held.select("s", "none").distinct().count())
    each = Window.partitionBy("s", "none")
    steps = held.groupBy("s", "none").agg(
        F.sum("good").alias("n"), F.collect_list(F.struct("step", "good", "bad")).alias("seen")).select(
        "s", "none", "n", "seen", F.explode(F.sequence(F.lit(0), F.lit(N_STEPS - 1))).alias("t"))
    upto = lambda what: F.aggregate(F.filter("seen", lambda x: x["step"] <= F.col("t")), F.lit(0).cast("long"), lambda a, x: a + x[what])
    tested = steps.select("s", "none", "t", "n", upto("good").alias("k"), upto("bad").alias("bad"))
    passes = lower_tail(F.col("n"), F.col("k"), F.lit(risk)) <= F.log(F.lit(delta / strata))
    return (tested.withColumn("passes", F.min(passes.cast("int")).over(each.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))
            .where((F.col("passes") == 1) & (F.col("bad") > F.col("k")))
            .groupBy("s", "none").agg(F.max(F.struct(
                (F.col("bad") - F.col("k")).alias("gain"), (-F.col("t")).alias("t"), "n", "k")).alias("best"))
            .select(F.when(~F.col("none"), F.col("s")).alias("stratum"), (-F.col("best.t")).alias("step"),
                    F.col("best.n").alias("n_good"), F.col("best.k").alias("n_rejected")))


def assess(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """key, counts, ``base_failed`` and ``kept`` for each row of ``docs``.

    Statistics are written once, without texts; the steps in use (one row per stratum) join
    them on the stratum.
    """
    stats = stage(statistics(docs, stratum), "quality-statistics")
    chosen = stage(cutoffs(stats, labels, risk, delta).select(F.col("stratum").alias("of"), F.col("step").alias("used")), "quality-cutoffs")
    rejects = F.coalesce(first_step() <= F.col("used"), F.lit(False))
    return (stats.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left")
            .select("key", "stratum", *BASE, "n_capitals", "n_lines", base_failed().alias("base_failed"),
                    (~base_failed() & ~rejects).alias("kept")))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    rejected = assess(docs, labels, stratum, risk, delta).where(~F.col("kept")).select("key").distinct()
    return packed(docs).join(rejected, "key", "left_anti").select("row.*")
