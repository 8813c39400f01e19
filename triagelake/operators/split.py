"""Seeded stratified splits with exact counts and without moving rows.

Rows of a class are ordered by the MD5 of seed and key. Only the hashes at the two
cut positions are looked up (by counting hash prefixes, then sorting one prefix);
assigning the split is then a comparison per row, without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import locate_ranks

VALIDATION_SIZE = 0.15
TEST_SIZE = 0.15
SEED = 42
# Hash prefixes serve as bins; the hash is uniform, so they are balanced.
PREFIX_DIGITS = 3
ROWS_PER_PREFIX = 4_000_000  # longer prefixes beyond it, so no bin to be sorted grows with the table


def check_sizes(validation: float, test: float) -> None:
    if validation <= 0 or test <= 0 or validation + test >= 1:
        raise ValueError("validation and test shares must be positive and leave training rows")


def seeded_hash(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def proportional(sizes: dict[int, int], total: int) -> dict[int, int]:
    """Largest-remainder allocation of ``total`` rows; equal remainders go to the larger label."""
    whole = sum(sizes.values())
    exact = {c: n * total / whole for c, n in sizes.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    turn = sorted(sizes, key=lambda c: (round(exact[c] - given[c], 9), c), reverse=True)
    for c in turn[: total - sum(given.values())]:
        given[c] += 1
    return given


def class_cuts(sizes: dict[int, int], held_out: float, second: float | None) -> dict[int, list[int]]:
    """Ranks per class at which training rows and validation rows end."""
    whole = sum(sizes.values())
    train = proportional(sizes, whole - math.ceil(held_out * whole))
    if second is None:
        return {c: [n] for c, n in train.items()}
    rest = {c: n - train[c] for c, n in sizes.items()}
    left = sum(rest.values())
    validation = proportional(rest, left - math.ceil(second * left))
    return {c: [n, n + validation[c]] for c, n in train.items()}


def _assign(df: DataFrame, label: str, key: str, seed: int, held_out: float, second: float | None,
            names: tuple[str, ...], column: str) -> DataFrame:
    sizes = {r["label"]: r["n"] for r in df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    if not sizes:
        return df.withColumn(column, F.lit(names[-1]))
    cuts = class_cuts(sizes, held_out, second)
    digits = max(PREFIX_DIGITS, math.ceil(math.log(max(sizes.values()) / ROWS_PER_PREFIX, 16)))
    per_class = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    ranks = F.element_at(F.create_map(*[x for c, r in cuts.items() for x in (
        F.lit(c), F.array(*[F.lit(n).cast("long") for n in r]))]), F.col("label"))
    hashed = df.select(F.col(label).alias("label"), seeded_hash(seed, key).alias("h")).withColumns({
        "bin": F.conv(F.substring("h", 1, digits), 16, 10).cast("int"), "tie_bin": F.lit(0)})
    found = locate_ranks(hashed, lambda t: t.withColumn("wanted", F.array_distinct(ranks)), ["h"], ["label"]).collect()
    border = {(r["label"], r["rank"]): r["h"] for r in found}  # two rows per class
    part, h = F.lit(names[-1]), seeded_hash(seed, key)
    for i in reversed(range(len(names) - 1)):
        # A class without rows in a part has the empty border, below every hash.
        ends = {c: border.get((c, r[i]), "") for c, r in cuts.items()}
        part = F.when(h <= F.element_at(per_class(ends), F.col(label)), names[i]).otherwise(part)
    return df.withColumn(column, part)


def stratified_split(df: DataFrame, label: str, key: str, validation: float = VALIDATION_SIZE,
                     test: float = TEST_SIZE, seed: int = SEED, column: str = "split") -> DataFrame:
    """Add ``split`` = train, validation or test; ``key`` must identify a row."""
    check_sizes(validation, test)
    held_out = validation + test
    return _assign(df, label, key, seed, held_out, test / held_out, ("train", "validation", "test"), column)


def two_way_split(df: DataFrame, label: str, key: str, test: float = 0.20, seed: int = SEED,
                  column: str = "split") -> DataFrame:
    """The older stratified train/test split."""
    if not 0 < test < 1:
        raise ValueError("the test share must lie between 0 and 1")
    return _assign(df, label, key, seed, test, None, ("train", "test"), column)


def hashed_split(df: DataFrame, key: str, validation: float = VALIDATION_SIZE, test: float = TEST_SIZE,
                 seed: int = SEED, column: str = "split") -> DataFrame:
    """Approximate variant for streams: the hash alone decides, shares hold on average."""
    check_sizes(validation, test)
    place = F.conv(F.substring(seeded_hash(seed, key), 1, 13), 16, 10).cast("double") / F.lit(math.pow(16, 13))
    train = 1 - validation - test
    return df.withColumn(column, F.when(place < train, "train").when(place < train + validation, "validation")
                         .otherwise("test"))


def split_counts(df: DataFrame, label: str, column: str = "split") -> DataFrame:
    """Rows per split: all, positive and negative."""
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("long").alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"))
