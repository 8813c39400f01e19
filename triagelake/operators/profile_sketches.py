"""Profiles as mergeable sketches: one pass per input part, kept as rows and merged later.

``sketch_parts`` reads its input once and gives one row per part and feature. The rows can be
written and appended to as parts arrive; ``merge_sketches`` joins any of them, also merged ones,
without reading the data again, and ``read_sketches`` turns them into a profile. Counts, minimum
and maximum are exact. Distinct counts have a standard error of 1.04 / sqrt(2 ** ``DISTINCT_BITS``),
ranks of quantiles one of about 2.3 / ``QUANTILE_SIZE``; counts of frequent values are exact up
to 0.75 * ``TRACKED`` different values and lower bounds beyond. The exact operators are in
``profile``.

Cases: nulls (and NaN in numeric features) are counted as missing and enter no sketch; a
feature without values has no quantiles and 0 distinct values; a null part is a part; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DISTINCT_BITS = 13
QUANTILE_SIZE = 400
TRACKED = 4096


def sketch_parts(df: DataFrame, part: Column, numeric: list[str], categorical: list[str]) -> DataFrame:
    """part, feature, rows, numeric, present, low, high and the binary columns of distinct, quantile and frequent-value sketches."""
    twice = {c for c in [*numeric, *categorical] if [*numeric, *categorical].count(c) > 1}
    if twice:
        raise ValueError(f"features named twice: {sorted(twice)}")
    rows = [F.count(F.lit(1)).alias("rows")]
    names = [*numeric, *categorical]
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(numeric)]
    values += [F.col(c).cast("string").alias(f"v{len(numeric) + i}") for i, c in enumerate(categorical)]
    # Every feature carries every sketch, empty where it does not apply, so that all rows merge alike.
    for i, name in enumerate(names):
        number, v = i < len(numeric), F.col(f"v{i}")
        amount = v if number else F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(name).alias("feature"), F.lit(number).alias("numeric"), F.count(v).alias("present"),
            F.min(amount).alias("low"), F.max(amount).alias("high"),
            F.hll_sketch_agg(v.cast("string"), F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
            F.kll_sketch_agg_double(amount, F.lit(QUANTILE_SIZE)).alias("quantile_sketch"),
            F.expr(f"approx_top_k_accumulate({'CAST(NULL AS STRING)' if number else f'v{i}'}, {TRACKED})").alias("frequent_sketch"),
        ).alias(f"f{i}"))
    wide = df.select(part.alias("part"), *values).groupBy("part").agg(*rows)
    each = F.explode(F.array(*[F.col(f"f{i}") for i in range(len(names))]))
    return wide.select("part", "rows", each.alias("f")).select("part", "f.feature", "rows", *[f"f.{c}" for c in (
        "numeric", "present", "low", "high", "distinct_sketch", "quantile_sketch", "frequent_sketch")])


def merge_sketches(sketches: DataFrame, part: Column | None = None) -> DataFrame:
    """The rows of ``sketch_parts`` merged per feature, or per ``part`` (any expression on them) and feature."""
    coarse = sketches.withColumn("part", F.lit(None).cast("string") if part is None else part)
    return coarse.groupBy("part", "feature", "numeric").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(frequent_sketch, {TRACKED})").alias("frequent_sketch"))


def read_sketches(sketches: DataFrame, probabilities: list[float], first: int = 8) -> DataFrame:
    """part, feature, rows, missing, low, high, distinct_values, an array of quantiles and the most frequent values with counts."""
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    wanted = F.array(*[F.lit(p) for p in probabilities])
    # All tracked values are asked for, so that equal counts go by value; nulls are tracked as a value of their own.
    frequent = F.filter(F.expr(f"approx_top_k_estimate(frequent_sketch, {TRACKED})"), lambda x: x["item"].isNotNull())
    ordered = F.slice(F.array_sort(F.transform(frequent, lambda x: F.struct(
        (-x["count"]).alias("minus"), x["item"].alias("value"), x["count"].alias("n")))), 1, first)
    return sketches.select(
        "part", "feature", "rows", (F.col("rows") - F.col("present")).alias("missing"), "low", "high",
        F.when(F.col("present") > 0, F.hll_sketch_estimate("distinct_sketch")).otherwise(F.lit(0).cast("long")).alias("distinct_values"),
        F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", wanted)).alias("quantiles"),
        F.when(~F.col("numeric"), F.transform(ordered, lambda x: F.struct(x["value"], x["n"]))).alias("frequent"))
