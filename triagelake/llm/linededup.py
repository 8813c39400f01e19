"""Line deduplication by winnowing over line hashes.

Every line with a word is hashed. A window is a shortest run of such lines that holds
``min_words`` words, taken forward from each line and backward from each line; it has at most
``min_words`` lines. The smallest line hash of each window (rightmost of equals) selects that
line as a fingerprint; neighbouring windows mostly select the same line, so far fewer positions
are kept than lines. Any run of ``min_words`` or more words that occurs twice contains the same
windows in both places and so selects the same fingerprints: none can be missed, whatever
surrounds the run.

Fingerprint positions are joined on their hash; a line that is a fingerprint in one place only
is finished there. The others are extended both ways by comparing the hashes of the lines
beside them, first out to the borders of all windows that selected the position (its
surroundings): a place with the surroundings of an earlier one is repeated whole. So a thousand
copies fold into one before anything else is compared. The first places of different
surroundings are then extended as far as one of their windows agrees with an earlier place.
Each place is thus compared with the first one that agrees on both sides, never with all.
Since forward and backward windows together cover every line of a run, the union of what
agrees is the maximal repeated run.

Result: a line is deleted exactly if it lies in a run of lines with ``min_words`` or more words
that occurred before, earlier in the same document or in a document before it; documents are
ordered by id (null first), then text hash. Blank lines do not count when runs are compared and
go with a deleted run that surrounds them.

Cases: null text becomes empty text without lines deleted; rows that repeat a document share
one result, copies of its text under other ids lose their repeated runs; documents are never
dropped, a text may become empty. Lines are compared by 64-bit hash and window hash together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import BLANK, packed

MIN_WORDS = 50


def _lines(rows: DataFrame) -> DataFrame:
    """key, line number, hash and words of each line with a word."""
    lines = rows.select("key", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    words = F.size(F.array_remove(F.split("content", BLANK), ""))
    return lines.select("key", "line", F.xxhash64("content").alias("hash"), words.cast("long").alias("words")).where("words > 0")


def fingerprints(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per selected line: key, line, hash, its surroundings and the windows that selected it.

    ``left`` holds the lines before it, nearest first, ``right`` those after it; a window is the
    number of lines that it takes from each.
    """
    in_order = Window.partitionBy("key").orderBy("line")
    ahead = F.collect_list(F.struct("line", "hash", "words")).over(in_order.rowsBetween(0, min_words - 1))
    behind = F.collect_list(F.struct("line", "hash", "words")).over(in_order.rowsBetween(1 - min_words, 0))
    lines = _lines(rows).dropDuplicates(["key", "line"]).select("key", "line", ahead.alias("ahead"), F.reverse(behind).alias("behind"))
    both = lines.select("key", F.explode(F.array(
        F.struct(_shortest("ahead", min_words).alias("run")), F.struct(F.reverse(_shortest("behind", min_words)).alias("run")))).alias("w"))
    run = F.transform("w.run", lambda x: F.struct(x["line"], x["hash"]))
    both = both.where(F.size("w.run") > 0).select("key", run.alias("run"), F.col("w.run.hash").alias("hashes"))
    n = F.size("run")
    at = n - F.array_position(F.reverse("hashes"), F.array_min("hashes")).cast("int")  # from 0, rightmost minimum
    both = both.withColumn("at", at).select(
        "key", F.get("run", F.col("at")).alias("print"), F.reverse(F.slice("run", 1, F.col("at"))).alias("left"),
        F.slice("run", F.col("at") + 2, F.greatest(n - F.col("at") - 1, F.lit(0))).alias("right"))
    return both.groupBy("key", F.col("print.line").alias("line"), F.col("print.hash").alias("fingerprint")).agg(
        F.max_by("left", F.size("left")).alias("left"), F.max_by("right", F.size("right")).alias("right"),
        F.collect_set(F.struct(F.size("left").alias("left"), F.size("right").alias("right"))).alias("windows"))


def _hash(lines: Column) -> Column:
    return F.xxhash64(F.transform(lines, lambda x: x["hash"]))


def _reach(lines: str, n: Column) -> Column:
    """Number of the line ``n`` places away from the fingerprint, on one side."""
    return F.when(n > 0, F.get(F.col(lines), n - 1)["line"]).otherwise(F.col("line"))


def _shortest(lines: str, min_words: int) -> Column:
    """Leading lines up to the one that completes ``min_words``; empty if they hold fewer."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("n"))
    seen = F.aggregate(lines, start, lambda a, x: F.when(a["words"] >= min_words, a).otherwise(
        F.struct((a["words"] + x["words"]).alias("words"), (a["n"] + 1).alias("n"))))
    return F.when(seen["words"] >= min_words, F.slice(lines, 1, seen["n"])).otherwise(F.slice(lines, 1, 0))


def repeated_runs(found: DataFrame) -> DataFrame:
    """key, first and last line of what occurred before, from the written result of ``fingerprints``."""
    around = ["fingerprint", "before", "after"]
    found = found.withColumns({"before": _hash(F.col("left")), "after": _hash(F.col("right"))})
    firsts = stage(found.groupBy(*around).agg(F.count("*").alias("n"), F.min(F.struct("key", "line")).alias("origin")), "line-firsts")
    # Fingerprints found in more than one place, and in how many different surroundings.
    shared = firsts.groupBy("fingerprint").agg(F.sum("n").alias("places"), F.count("*").alias("kinds")).where("places > 1")
    joined = found.join(firsts.join(shared, "fingerprint").select(*around, "origin", "kinds"), around)
    repeated = F.struct("key", "line") != F.col("origin")
    joined = stage(joined.where(repeated | (F.col("kinds") > 1)).select(
        "key", "line", "fingerprint", repeated.alias("repeated"), "left", "right", "windows"), "line-places")
    whole = joined.where("repeated").select(
        "key", _reach("left", F.size("left")).alias("first"), _reach("right", F.size("right")).alias("last"))
    # First places of their surroundings: which of their windows an earlier one of these agrees with.
    windows = joined.where("NOT repeated").select("key", "line", "fingerprint", "left", "right", F.explode("windows").alias("w"))
    windows = stage(windows.select(
        "key", "line", "fingerprint", _reach("left", F.col("w.left")).alias("first"), _reach("right", F.col("w.right")).alias("last"),
        _hash(F.slice("left", 1, F.col("w.left"))).alias("before"), _hash(F.slice("right", 1, F.col("w.right"))).alias("after")), "line-windows")
    origins = windows.groupBy(*around).agg(F.count("*").alias("n"), F.min(F.struct("key", "line")).alias("origin")).where("n > 1")
    later = windows.join(origins.select(*around, "origin"), around).where(F.struct("key", "line") != F.col("origin"))
    return whole.unionByName(later.select("key", "first", "last"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (as it came), ``text`` after deletion, n_lines and n_removed of each row of ``docs``."""
    rows = packed(docs)
    found = stage(fingerprints(rows, min_words), "line-fingerprints")
    gone = (repeated_runs(found).select("key", F.explode(F.sequence("first", "last")).alias("line")).distinct()
            .groupBy("key").agg(F.collect_list("line").alias("gone")))
    joined = rows.join(gone.hint("shuffle_hash"), "key", "left").select(
        "row", "gone", F.split("text", "\n").alias("lines"), "text")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get(F.col("lines"), i))
    return joined.select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def rewrite(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the shortened texts in place of the old ones and, where it has one, a new ``n_chars``."""
    done = dedup_lines(docs, min_words)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
