"""Minority oversampling by interpolation between neighbours, and training-set preparation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import CATEGORICAL_FEATURES, FEATURES, TARGET, require_training_columns
from ..session import stage
from .encode import Preprocessor, fit_preprocessor
from .neighbour_index import approximate_neighbours
from .neighbours import POINTS_PER_CELL, nearest_neighbours
from .ordering import add_bins, find_cuts, locate_ranks
from .split import SEED, stratified_split

RATIO = 0.5
NEIGHBOURS = 5


def synthetic_total(majority: int, minority: int, ratio: float) -> int:
    """How many rows bring the minority to ``ratio`` times the majority."""
    wanted = int(ratio * majority - minority)
    if wanted < 0:
        raise ValueError("the minority already exceeds the wanted ratio")
    return wanted


def blend_weight(seed: int, row_id: Column, copy: Column) -> Column:
    """Number in [0, 1) from a hash of seed, base row and copy: the same on every run and retry."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string"), F.lit(":"), copy.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _nth_id(ids: DataFrame, n: int):
    """The n-th smallest id, found by counting; None for n = 0."""
    if n == 0:
        return None
    keyed = ids.withColumn("key", F.col("id").cast("double"))
    binned = add_bins(keyed, find_cuts(keyed, "key"), "key")
    return locate_ranks(binned, lambda t: t.withColumn("wanted", F.array(F.lit(n).cast("long"))), ["id"]).first()["id"]


@dataclass(frozen=True)
class Oversampler:
    """The minority's neighbours, searched once and written, from which any ratio is made."""

    rows: DataFrame
    features: list[str]
    label: str
    row_id: str
    near: DataFrame
    minority: int
    majority: int
    k: int = NEIGHBOURS
    seed: int = SEED

    def synthetic(self, ratio: float) -> DataFrame:
        """New minority rows: base + u·(neighbour − base).

        Every minority row is used equally often; the first ones in id order once more until
        the total is reached. Copy ``m`` of a row uses its neighbour ``m mod k``, so the rows of
        a smaller ratio are among those of a larger one. Columns: base id, neighbour id, copy,
        label, features.
        """
        total = synthetic_total(self.majority, self.minority, ratio)
        extra = _nth_id(self.near.select("id"), total % self.minority)
        copies = F.lit(total // self.minority)
        if extra is not None:
            copies = copies + (F.col("id") <= F.lit(extra)).cast("int")
        made = self.near.withColumn("copies", copies).filter(F.col("copies") > 0).withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        u = blend_weight(self.seed, F.col("id"), F.col("copy"))
        made = made.withColumn("n", F.element_at("neighbours", F.col("copy") % self.k + 1)).withColumn("u", u)
        value = lambda i: F.element_at("vec", i) + F.col("u") * (F.element_at("n.vec", i) - F.element_at("vec", i))
        return made.select(
            F.col("id").alias("base_id"), F.col("n.id").alias("neighbour_id"), "copy", F.lit(1).alias(self.label),
            *[value(i + 1).alias(c) for i, c in enumerate(self.features)])

    def oversampled(self, ratio: float) -> DataFrame:
        """All original rows followed by the synthetic minority rows (column ``synthetic`` tells which)."""
        original = self.rows.select(F.col(self.row_id).alias(self.row_id), F.col(self.label).cast("int").alias(self.label),
                                    *self.features, F.lit(0).alias("synthetic"))
        made = self.synthetic(ratio).select(F.col("base_id").alias(self.row_id), self.label, *self.features, F.lit(1).alias("synthetic"))
        return original.unionByName(made)


def oversampler(df: DataFrame, features: list[str], label: str, row_id: str, k: int = NEIGHBOURS, seed: int = SEED,
                points_per_cell: int = POINTS_PER_CELL, exact_rows: int | None = None) -> Oversampler:
    """Searches the neighbours of all minority rows, whose ids must be whole numbers.

    The search is exact for any number of rows. Only a caller that names ``exact_rows`` asks for the
    projection index, whose neighbours are approximate, beyond that many minority rows; no query does.
    """
    counts = df.agg(F.count_if(F.col(label) == 1).alias("minority"), F.count_if(F.col(label) == 0).alias("majority")).first()
    if counts["minority"] < k + 1:
        raise ValueError(f"oversampling needs at least {k + 1} minority rows, got {counts['minority']}")
    points = df.filter(F.col(label) == 1).select(
        F.col(row_id).alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    if exact_rows is not None and counts["minority"] > exact_rows:
        near = approximate_neighbours(points, "id", "vec", k)
    else:
        near = nearest_neighbours(points, "id", "vec", k, points_per_cell)
    return Oversampler(df, list(features), label, row_id, stage(near, "neighbours"), counts["minority"], counts["majority"], k, seed)


def synthetic_rows(df: DataFrame, features: list[str], label: str, row_id: str, ratio: float = RATIO,
                   k: int = NEIGHBOURS, seed: int = SEED, points_per_cell: int = POINTS_PER_CELL) -> DataFrame:
    return oversampler(df, features, label, row_id, k, seed, points_per_cell).synthetic(ratio)


def oversample(df: DataFrame, features: list[str], label: str, row_id: str, ratio: float = RATIO,
               k: int = NEIGHBOURS, seed: int = SEED, points_per_cell: int = POINTS_PER_CELL) -> DataFrame:
    return oversampler(df, features, label, row_id, k, seed, points_per_cell).oversampled(ratio)


@dataclass(frozen=True)
class Prepared:
    """Scaled frames per split; ``train`` is oversampled, ``train_original`` is not."""

    train: DataFrame
    train_original: DataFrame
    validation: DataFrame
    test: DataFrame
    preprocessor: Preprocessor
    features: list[str]
    raw: DataFrame


def prepare(df: DataFrame, label: str, row_id: str, features: list[str], categorical: list[str],
            ratio: float | None = RATIO, seed: int = SEED, repair: bool = True) -> Prepared:
    """Split, fit on training rows, transform all rows, oversample training rows only.

    Without a ratio nothing is oversampled and ``train`` holds the original rows.
    """
    split = stratified_split(df.select(row_id, label, *features), label, row_id, seed=seed)
    # Fitting, resampling and model training read these rows many times over.
    split = stage(split, "split", ["split"])
    fitted = fit_preprocessor(split.filter(F.col("split") == "train"), features, categorical, repair)
    scaled = fitted.transform(split)
    part = lambda name: scaled.filter(F.col("split") == name).drop("split")
    train = part("train")
    more = train if ratio is None else oversample(train, features, label, row_id, ratio, seed=seed)
    return Prepared(more, train,
                    part("validation"), part("test"), fitted, features, split)


def prepare_claims(df: DataFrame, ratio: float | None = RATIO, seed: int = SEED, row_id: str = "PolicyNumber") -> Prepared:
    """Contract claims from raw rows to training frames."""
    require_training_columns(df)
    return prepare(df, TARGET, row_id, FEATURES, CATEGORICAL_FEATURES, ratio, seed)
