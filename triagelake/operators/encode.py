"""Train-fitted category codes and scaling.

Fitting reads the training rows only and yields a small parameter object; applying
it is a projection. Columns with many distinct values keep their codes in a staged
table and are joined instead of inlined.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleaning import clean_claims, numeric_age
from ..functions.vocabulary import FORM_ORDER, HIDDEN_ANSWERS
from ..schema import CATEGORICAL_FEATURES, FEATURES, require_exact_order
from ..session import stage
from .ordering import global_rank, quantiles
from .profile import long_values

INLINE_VALUES = 512
UNSEEN = -1


@dataclass(frozen=True)
class Preprocessor:
    """Fitted parameters: fill value, category lists, mean and deviation per feature."""

    features: list[str]
    categorical: list[str]
    categories: dict[str, list[str]]
    mean: dict[str, float] = field(default_factory=dict)
    deviation: dict[str, float] = field(default_factory=dict)
    age_fill: float | None = None
    large: DataFrame | None = None

    @property
    def numeric(self) -> list[str]:
        return [c for c in self.features if c not in self.categorical]

    def clean(self, df: DataFrame) -> DataFrame:
        return df if self.age_fill is None else clean_claims(df, self.age_fill)

    def encode(self, df: DataFrame) -> DataFrame:
        """Category codes and numbers as doubles; other columns stay in front."""
        others = [c for c in df.columns if c not in self.features]
        out = self.clean(df)
        for name in self.categorical:
            if name not in self.categories:
                out = _join_codes(out, self.large, name)
        columns = []
        for name in self.features:
            if name not in self.categorical:
                columns.append(F.col(name).try_cast("double").alias(name))
            elif name in self.categories:
                columns.append(inline_code(F.col(name), self.categories[name]).cast("double").alias(name))
            else:
                columns.append(F.col(name).cast("double").alias(name))
        return out.select(*others, *columns)

    def scale(self, encoded: DataFrame) -> DataFrame:
        others = [c for c in encoded.columns if c not in self.features]
        return encoded.select(*others, *[
            ((F.col(c) - F.lit(self.mean[c])) / F.lit(self.deviation[c])).alias(c) for c in self.features])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scale(self.encode(df))

    def metadata(self) -> dict:
        return {
            "feature_order": list(self.features), "categorical_columns": list(self.categorical),
            "numeric_columns": self.numeric,
            "encoder_categories": {c: list(self.categories[c]) for c in self.categorical if c in self.categories},
            # Lists too long to gather are rows of the table saved with the preprocessor.
            "encoder_category_table": {c: "codes" for c in self.categorical if c not in self.categories},
            "age_fill_value": self.age_fill,
        }


def inline_code(value: Column, categories: list[str]) -> Column:
    """Position in the sorted list; unseen values and null give -1."""
    if not categories:
        return F.lit(UNSEEN)
    listed = F.array(*[F.lit(v) for v in categories])
    return (F.coalesce(F.array_position(listed, value), F.lit(0)) + F.lit(UNSEEN)).cast("int")


def _join_codes(df: DataFrame, codes: DataFrame, name: str) -> DataFrame:
    """Code lookup by join; adaptive execution broadcasts it or splits hot keys by measured size."""
    table = codes.filter(F.col("feature") == name).select(
        F.col("value").alias(name), F.col("code").alias("__code"))
    return df.join(table, name, "left").withColumn(name, F.coalesce("__code", F.lit(UNSEEN))).drop("__code")


def _distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return long_values(df, columns, [], "string").filter(F.col("value").isNotNull()).groupBy(
        "feature", "value").agg(F.lit(1).alias("one")).drop("one")


def value_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, code) with codes from 0 along the sorted distinct values, for any number of values."""
    ranked = global_rank(_distinct_values(df, columns), [F.col("feature"), F.col("value")], "r")
    starts = ranked.groupBy("feature").agg(F.min("r").alias("first"))
    return ranked.join(F.broadcast(starts), "feature").select(
        "feature", "value", (F.col("r") - F.col("first")).cast("int").alias("code"))


def category_lists(df: DataFrame, columns: list[str],
                   inline_values: int = INLINE_VALUES) -> tuple[dict[str, list[str]], list[str]]:
    """Sorted category lists of columns with few values, and the names of all others.

    The sizes are counted before anything is gathered.
    """
    if not columns:
        return {}, []
    # Written once: the data is scanned a single time for sizes and lists.
    values = stage(_distinct_values(df, columns), "values")
    sizes = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = [c for c in columns if sizes.get(c, 0) <= inline_values]
    lists = {c: [] for c in small}
    gathered = values.filter(F.col("feature").isin(small)).groupBy("feature").agg(
        F.sort_array(F.collect_list("value")).alias("values"))
    lists.update({r["feature"]: list(r["values"]) for r in gathered.collect()})
    return lists, [c for c in columns if c not in small]


def age_fill_value(train: DataFrame, column: str = "Age") -> DataFrame:
    """Median age of the training rows without zeros and non-numbers."""
    age = F.nullif(numeric_age(column), F.lit(0.0))
    rows = train.select(F.lit("age").alias("feature"), age.alias("value"))
    return quantiles(rows, ["feature"], "value", [0.5]).select(F.element_at("q", F.lit(0.5)).alias("age_fill"))


def scaler_parameters(encoded: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean, deviation, n): population deviation, all features in one pass.

    Features are stacked and grouped rather than aggregated side by side: three
    aggregates compile to tight code, three per feature do not.
    """
    return long_values(encoded, features, [], "double").groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"), F.count("value").alias("n"))


def _usable_deviation(mean: float | None, deviation: float | None, n: int) -> float:
    """A constant feature (up to rounding noise of its sum) is divided by 1."""
    if deviation is None:  # no value at all in the training rows
        return 1.0
    eps = 2.0 ** -52
    noise = n * eps * deviation ** 2 + (n * mean * eps) ** 2
    return 1.0 if deviation ** 2 <= noise else deviation


def fit_preprocessor(train: DataFrame, features: list[str] | None = None, categorical: list[str] | None = None,
                     repair: bool = True, inline_values: int = INLINE_VALUES) -> Preprocessor:
    """Fit fill value, category codes and scaling on the training rows.

    ``repair`` applies the claim cleaning rules; switch it off for tables of other
    columns or for the older whole-table coding.
    """
    features = list(features or FEATURES)
    categorical = list(categorical if categorical is not None else
                       [c for c in features if c in CATEGORICAL_FEATURES])
    rows = train.select(*features)
    fill = None
    if repair and "Age" in features:
        got = age_fill_value(rows).first()
        if got is None or got["age_fill"] is None or not math.isfinite(got["age_fill"]):
            raise ValueError("the training rows hold no usable age")
        fill = float(got["age_fill"])
    base = Preprocessor(features, categorical, {}, age_fill=fill)
    cleaned = base.clean(rows)
    lists, big = category_lists(cleaned, categorical, inline_values)
    table = value_codes(cleaned, big) if big else None
    base = Preprocessor(features, categorical, lists, age_fill=fill, large=table)
    stats = scaler_parameters(base.encode(rows), features).collect()  # one row per feature
    return Preprocessor(
        features, categorical, lists, {r["feature"]: r["mean"] or 0.0 for r in stats},
        {r["feature"]: _usable_deviation(r["mean"], r["deviation"], r["n"]) for r in stats}, fill, table)


def fit_claims(train: DataFrame) -> Preprocessor:
    """Contract preprocessing; the feature frame must be in contract order."""
    require_exact_order(train)
    return fit_preprocessor(train, FEATURES, CATEGORICAL_FEATURES)


def label_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by its dense code over all rows of this frame."""
    lists, big = category_lists(df, columns)
    table = value_codes(df, big) if big else None
    coder = Preprocessor(columns, columns, lists, large=table)
    encoded = coder.encode(df)
    return encoded.select(*[F.col(c).cast("int").alias(c) if c in columns else F.col(c) for c in df.columns])


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, position, answer) for entry forms, without hidden answers.

    Columns with a natural order use it; the others list the values of the data in
    sort order. ``df`` decides only for the latter.
    """
    fixed = [c for c in columns if c in FORM_ORDER]
    free = [c for c in columns if c not in FORM_ORDER]
    parts = []
    if free:
        codes = value_codes(df, free).filter(~F.col("value").isin(HIDDEN_ANSWERS))
        spelled = F.when((F.col("feature") == "Make") & (F.col("value") == "Porche"), "Porsche").otherwise(F.col("value"))
        # The gap a hidden answer leaves is closed by counting hidden answers before it.
        hidden = value_codes_hidden(df, free)
        parts.append(codes.join(F.broadcast(hidden), "feature", "left").select(
            "feature", (F.col("code") - F.size(F.filter(
                F.coalesce("hidden", F.array().cast("array<string>")), lambda v: v < F.col("value")))).alias("position"),
            spelled.alias("answer")))
    if fixed:
        lists = F.create_map(*[x for c in fixed for x in (
            F.lit(c), F.array(*[F.lit(v) for v in FORM_ORDER[c] if v not in HIDDEN_ANSWERS]))])
        present = df.select(fixed).agg(*[F.count(c).alias(c) for c in fixed]).unpivot([], fixed, "feature", "n")
        parts.append(present.select("feature", F.posexplode(F.element_at(lists, F.col("feature"))).alias(
            "position", "answer")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def value_codes_hidden(df: DataFrame, columns: list[str]) -> DataFrame:
    """Hidden answers that occur per column (at most two each)."""
    return long_values(df, columns, [], "string").filter(F.col("value").isin(HIDDEN_ANSWERS)).groupBy(
        "feature").agg(F.sort_array(F.collect_set("value")).alias("hidden"))
