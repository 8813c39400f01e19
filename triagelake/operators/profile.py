"""Data profiling: counts, rates, correlations, histograms and summaries."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.cleaning import numeric_age
from ..functions.vocabulary import ORDINAL_CODES, ordinal_code
from .ordering import ROWS_PER_BIN, quantiles


def table_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives and positive rate in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives"),
        (F.avg(label) * 100).alias("positive_rate"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with its number of nulls; a single pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "nulls")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per class, with the whole-number ratio of class 0 to class 1."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    everything = W.partitionBy(F.lit(0))  # one row per class
    of = lambda k: F.sum(F.when(F.col("label") == k, F.col("n"))).over(everything)
    return counts.select(
        "label", "n", (F.col("n") / F.sum("n").over(everything) * 100).alias("percent"),
        F.floor(F.try_divide(of(0), of(1))).cast("long").alias("ratio"))


def class_subset(df: DataFrame, label: str, value: int) -> DataFrame:
    return df.filter(F.col(label) == value)


def sample_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order (a head has no meaning without one)."""
    return df.orderBy(*order).limit(n)


def long_values(df: DataFrame, columns: list[str], keep: list[str], kind: str) -> DataFrame:
    """(keep…, feature, value) rows; aggregations over it combine before the shuffle."""
    typed = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot(keep, columns, "feature", "value")


def rate_by_value(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Positive rate for each value of each categorical column, one aggregation for all columns."""
    values = long_values(df, columns, [label], "string").filter(F.col("value").isNotNull())
    return values.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("long").alias("positives"), F.avg(label).alias("rate"))


def ranked_rates(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Rates sorted per column from highest to lowest."""
    return rate_by_value(df, columns, label).orderBy("feature", F.desc("rate"), "value")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lower triangle of the Pearson matrix, all pairs in one aggregation."""
    pairs = [(a, b) for b, a in itertools.combinations(columns, 2)]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    entry = lambda i, a, b: F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                     F.col(f"p{i}").alias("correlation"))
    return row.select(F.explode(F.array(*[entry(i, a, b) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def histogram_by_class(df: DataFrame, columns: list[str], label: str, bins: int = 20) -> DataFrame:
    """Counts per (feature, class, bin); each class has its own range and the last bin is closed."""
    values = long_values(df, columns, [label], "double").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))
    key = ["feature", label]
    span = values.groupBy(*key).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(*key, F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    # One row per column and class.
    placed = values.join(span, key)
    width = F.col("hi") - F.col("lo")
    edge = lambda i: F.when(i == bins, F.col("hi")).otherwise(i * (width / bins) + F.col("lo"))
    raw = F.least(F.floor((F.col("value") - F.col("lo")) * (F.lit(float(bins)) / width)), F.lit(bins - 1)).cast("int")
    placed = placed.withColumn("bin", raw)
    i = F.col("bin")
    # Division may land next to an edge; the edges themselves decide.
    placed = placed.withColumn("bin", F.when(F.col("value") < edge(i), i - 1)
                               .when((F.col("value") >= edge(i + 1)) & (i < bins - 1), i + 1).otherwise(i))
    counts = placed.groupBy(*key, "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*key, "bin"], "left").select(
        *key, "bin", edge(i).alias("left_edge"), edge(i + 1).alias("right_edge"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def describe_numeric(df: DataFrame, columns: list[str], digits: int = 2,
                     rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column."""
    values = long_values(df, columns, [], "double").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = values.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quarters = quantiles(values, ["feature"], "value", [0.25, 0.5, 0.75], rows_per_bin).select(
        "feature", *[F.element_at("q", F.lit(p)).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    # One row per column on both sides.
    return moments.join(F.broadcast(quarters), "feature").select(
        "feature", "count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def distinct_values(df: DataFrame, columns: list[str], first: int = 8) -> DataFrame:
    """Distinct count and the first values in sort order per categorical column.

    Only ``first`` values per column and task survive the partial window limit, so a
    column with many values does not gather in one task.
    """
    values = long_values(df, columns, [], "string").filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.lit(1).alias("one"))
    counts = values.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values"))
    position = F.row_number().over(W.partitionBy("feature").orderBy("value"))
    heads = values.withColumn("i", position).filter(F.col("i") <= first).groupBy("feature").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "value"))), lambda s: s["value"]), "|")
        .alias("first_values"))
    return counts.join(F.broadcast(heads), "feature")


def anomaly_counts(df: DataFrame, age: str = "Age", weekday: str = "DayOfWeekClaimed",
                   banded: list[str] | None = None) -> DataFrame:
    """Age 0, claim weekday ``0``, answers without an ordinal code and nulls such a coding introduces."""
    banded = list(ORDINAL_CODES) if banded is None else banded
    number = F.coalesce(numeric_age(age) == 0, F.lit(False))
    unmapped: Column = F.lit(0)
    introduced: Column = F.lit(0)
    for c in banded:
        missing = ordinal_code(c).isNull()
        unmapped = unmapped + (missing & F.col(c).isNotNull()).cast("int")
        introduced = introduced + missing.cast("int")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return df.agg(
        F.count_if(number).alias("age_zero"), F.count_if(F.col(weekday) == "0").alias("weekday_zero"),
        total(unmapped).alias("unmapped_answers"), total(introduced).alias("nulls_after_coding"))
