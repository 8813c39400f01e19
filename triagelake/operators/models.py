"""Spark ML classifiers with the benchmark's settings, scoring and the benchmark job."""

from __future__ import annotations

import math
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import SparkContext, cloudpickle
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..session import spread, stage
from .metrics import evaluate, ranking_metrics
from .resample import Prepared
from .selection import RESULT_COLUMNS
from .split import SEED
from .thresholds import best_threshold

SCORE = "score"
# Spark's tree depth ends here; deeper trees are cut off.
DEEPEST = 30

# Settings of the benchmark models.
LOGISTIC = {"maxIter": 1000}
TREE = {"maxDepth": 8, "minInstancesPerNode": 5}
FOREST = {"numTrees": 200, "minInstancesPerNode": 2, "maxDepth": DEEPEST, "featureSubsetStrategy": "sqrt"}
# Deep trees: remember each row's node instead of walking all trees from the root per level. The counts that
# each task holds for the nodes it splits take maxMemoryInMB, once more while they are merged.
DEEP = {"cacheNodeIds": True, "maxMemoryInMB": 256}
#: Nodes of trees that score rows in one pass; each task holds a copy of them.
PASS_NODES = 250_000
BOOSTED = {"maxIter": 150, "stepSize": 0.05, "maxDepth": 3}
MODEL_NAMES = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVM"]


# Task-side helpers travel with the job instead of being imported on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fourier_features(df: DataFrame, inputs: int, count: int, gamma: float, seed: int = SEED) -> DataFrame:
    """Replace ``features`` by random Fourier features, whose dot products approach the RBF kernel."""
    draw = np.random.default_rng(seed)
    weights = draw.normal(scale=math.sqrt(2 * gamma), size=(inputs, count))
    shift = draw.uniform(0, 2 * math.pi, size=count)

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        waves = np.cos(np.stack(vectors.to_numpy()) @ weights + shift) * math.sqrt(2 / count)
        return pd.Series(list(waves))

    return df.withColumn("features", array_to_vector(project(vector_to_array("features"))))


class CalibratedSVC:
    """RBF support vectors: Fourier features, a linear machine and a logistic curve over its margin.

    The curve is fitted on margins of rows that the machine behind them has not seen: one
    machine per fold, fitted on all other folds. The machine that scores is fitted on all rows.
    On standardised features the kernel width 1 / inputs equals the usual 'scale' rule.
    ``count`` = 0 leaves the plain linear machine; ``folds`` = 0 fits the curve on training margins.
    """

    def __init__(self, label: str, weight: str | None = None, count: int = 256, seed: int = SEED, folds: int = 5):
        self.label, self.weight, self.count, self.seed, self.folds = label, weight, count, seed, folds
        extra = {"weightCol": weight} if weight else {}
        self.machine = LinearSVC(featuresCol="features", labelCol=label, rawPredictionCol="margins",
                                 predictionCol="side", maxIter=50, regParam=1e-4, **extra)

    def raised(self, df: DataFrame) -> Callable[[DataFrame], DataFrame]:
        inputs = len(df.select("features").first()[0])
        return lambda rows: fourier_features(rows, inputs, self.count, 1.0 / inputs, self.seed) if self.count else rows

    def folded(self, raised: DataFrame) -> DataFrame:
        """Raised rows with their fold; copies of a row share one."""
        return raised.withColumn("fold", F.pmod(F.xxhash64(vector_to_array("features"), F.lit(self.seed)), F.lit(self.folds)))

    def margins(self, rows: DataFrame, lift: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """label, fold and out-of-fold margin of each row.

        ``rows`` are raised already, or have a fold and are raised by ``lift`` where they are read.
        """
        rows, lift = (rows, lift) if lift else (self.folded(rows), lambda some: some)
        found = None
        for fold in range(self.folds):
            machine = self.machine.fit(lift(rows.where(F.col("fold") != fold)))
            held = _with_margin(machine.transform(lift(rows.where(F.col("fold") == fold)))).select(self.label, "fold", "margin")
            found = held if found is None else found.unionByName(held)
        return found

    def fit(self, df: DataFrame) -> _Calibrated:
        """Raised rows are many times as wide as their features: every pass makes them anew, and only
        features and folds are written. The machine keeps the one copy it is fitted on."""
        lift = self.raised(df)
        curve = LogisticRegression(featuresCol="margin", labelCol=self.label)
        rows = df
        if self.folds:
            wide = self.folded(lift(df.withColumn("narrow", F.col("features"))))
            rows = stage(wide.withColumn("features", F.col("narrow")).drop("narrow"), "svm-rows")
        fitted = self.machine.fit(lift(rows))
        held = self.margins(rows, lift) if self.folds else _with_margin(fitted.transform(lift(rows))).select(self.label, "margin")
        return _Calibrated(lift, fitted, curve.fit(stage(held, "svm-margins")))


def _with_margin(df: DataFrame) -> DataFrame:
    return df.withColumn("margin", array_to_vector(F.slice(vector_to_array("margins"), 2, 1)))


@dataclass
class _Calibrated:
    lift: Callable[[DataFrame], DataFrame]
    machine: Transformer
    curve: Transformer

    def transform(self, df: DataFrame) -> DataFrame:
        return self.curve.transform(_with_margin(self.machine.transform(self.lift(df))))


def registry(label: str, rows: float | None = None, seed: int = SEED,
             weight: str | None = None) -> dict[str, Callable[[], Estimator]]:
    """Factories of fresh estimators in benchmark order.

    ``rows`` is the training size: the logistic penalty 1/C with C = 1 acts on the
    summed loss, which is 1/rows on Spark's mean loss. Trees split numbers at no more than
    Spark's default of 32 candidate values (``maxBins``).
    """
    common = {"featuresCol": "features", "labelCol": label}
    if weight:
        common["weightCol"] = weight
    penalty = 1.0 / rows if rows else 0.0
    return {
        "Logistic Regression": lambda: LogisticRegression(regParam=penalty, standardization=False, **LOGISTIC, **common),
        "Decision Tree": lambda: DecisionTreeClassifier(seed=seed, **TREE, **common),
        "Random Forest": lambda: RandomForestClassifier(seed=seed, **FOREST, **DEEP, **common),
        "Gradient Boosting": lambda: GBTClassifier(seed=seed, **BOOSTED, **common),
        "SVM": lambda: CalibratedSVC(label, weight, seed=seed),
    }


def weighted_registry(label: str, weight: str, seed: int = SEED, rows: float | None = None) -> dict[str, Callable[[], Estimator]]:
    """Variants that weight positives instead of oversampling (see ``with_class_weight``).

    ``rows`` is the summed weight, which turns a unit penalty into Spark's averaged one.
    """
    common = {"featuresCol": "features", "labelCol": label, "weightCol": weight}
    penalty = 1.0 / rows if rows else 0.0
    # Settings of the class-weighted models.
    return {
        "Logistic Regression": lambda: LogisticRegression(regParam=penalty, standardization=False, **LOGISTIC, **common),
        "Decision Tree": lambda: DecisionTreeClassifier(maxDepth=8, seed=seed, **common),
        "Random Forest": lambda: RandomForestClassifier(numTrees=200, maxDepth=10, seed=seed, **DEEP, **common),
        "Gradient Boosting": lambda: GBTClassifier(
            maxIter=200, maxDepth=4, stepSize=0.05, seed=seed, featuresCol="features", labelCol=label),
    }


def with_class_weight(df: DataFrame, label: str, positive: float = 5.0, column: str = "weight") -> DataFrame:
    return df.withColumn(column, F.when(F.col(label) == 1, F.lit(float(positive))).otherwise(F.lit(1.0)))


def network(label: str, inputs: int, hidden: tuple[int, ...] = (64,), iterations: int = 100,
            seed: int = SEED) -> MultilayerPerceptronClassifier:
    """Sigmoid network; Spark ML offers no dropout, batch normalisation or class weight."""
    return MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=label, layers=[inputs, *hidden, 2], maxIter=iterations, seed=seed)


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    """Replace feature columns by one vector column."""
    others = [c for c in df.columns if c not in features]
    return df.select(*others, array_to_vector(F.array(*[F.col(c).cast("double") for c in features])).alias("features"))


def scored(model: Transformer, df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep…, score): probability of the positive class."""
    if isinstance(model, RandomForestClassificationModel) and len(parts := forest_parts(model)) > 1:
        return _forest_scored(parts, df, keep)
    out = model.transform(df)
    if "probability" not in out.columns:
        raise TypeError(f"{type(model).__name__} provides no probability")
    return out.select(*keep, vector_to_array("probability")[1].alias(SCORE))


def forest_parts(model: RandomForestClassificationModel, most: int | None = None) -> list[RandomForestClassificationModel]:
    """Forests of successive trees with at most ``most`` nodes together, or one larger tree."""
    java, trees = model._java_obj, list(model._java_obj.trees())
    groups, held = [], 0
    for tree in trees:
        nodes = tree.numNodes()
        if not groups or held + nodes > (most or PASS_NODES):
            groups.append([])
            held = 0
        groups[-1].append(tree)
        held += nodes
    if len(groups) < 2:
        return [model]
    gateway, parts = SparkContext._gateway, []
    kind = gateway.jvm.org.apache.spark.ml.classification
    for group in groups:
        some = gateway.new_array(kind.DecisionTreeClassificationModel, len(group))
        for i, tree in enumerate(group):
            some[i] = tree
        parts.append(RandomForestClassificationModel(kind.RandomForestClassificationModel(
            java.uid(), some, java.numFeatures(), java.numClasses())).setFeaturesCol(model.getFeaturesCol()))
    return parts


def _forest_scored(parts: list[RandomForestClassificationModel], df: DataFrame, keep: list[str]) -> DataFrame:
    """The score of a large forest, whose votes are summed over passes, so that no task holds all trees."""
    features = parts[0].getFeaturesCol()
    rows = df.select(*[F.col(c).alias(f"__keep_{c}") for c in keep], features, F.array(F.lit(0.0), F.lit(0.0)).alias("__votes"))
    for part in parts:
        votes = F.zip_with("__votes", vector_to_array("rawPrediction"), lambda a, b: a + b)
        rows = stage(part.transform(rows).withColumn("__votes", votes).select(rows.columns), "votes")
    return rows.select(*[F.col(f"__keep_{c}").alias(c) for c in keep],
                       (F.col("__votes")[1] / (F.col("__votes")[0] + F.col("__votes")[1])).alias(SCORE))


def require_rows(**frames: DataFrame) -> None:
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"partitions without rows: {empty}")


def run_benchmark(prepared: Prepared, label: str, row_id: str, names: list[str] | None = None,
                  optimize_for: str = "f1", seed: int = SEED, weight: str | None = None,
                  factories: Callable[[float], dict[str, Callable[[], Estimator]]] | None = None) -> DataFrame:
    """Fit each model, choose its threshold on validation rows, evaluate test rows once.

    The loop runs over models; every step inside is a distributed job. ``factories`` takes the
    summed weight of the training rows (their number without weights), on which penalties depend.
    Returns the 13 result columns plus ``validation_pr_auc``; ``fit_seconds`` is the fit alone.
    """
    require_rows(train=prepared.train, validation=prepared.validation, test=prepared.test)
    train = assembled(prepared.train, prepared.features)
    if weight:
        train = with_class_weight(train, label, column=weight)
    train = stage(train, "train")
    size = float(train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0])
    train = spread(train).persist()
    try:
        made = factories(size) if factories else registry(label, size, seed, weight)
        held = stage(assembled(prepared.validation, prepared.features).withColumn("part", F.lit("validation")).unionByName(
            assembled(prepared.test, prepared.features).withColumn("part", F.lit("test"))), "held")
        rows = None
        for name in names or list(made):
            started = time.perf_counter()
            model = made[name]().fit(train)
            seconds = time.perf_counter() - started
            both = stage(scored(model, held, [row_id, label, "part"]), "scores")
            validation, test = (both.filter(F.col("part") == p) for p in ("validation", "test"))
            threshold = best_threshold(validation, SCORE, label, optimize_for).first()["threshold"]
            metrics = evaluate(test, SCORE, label, threshold).first()
            record = metrics.asDict() | {
                "model": name, "fit_seconds": round(seconds, 3),
                "validation_pr_auc": ranking_metrics(validation, SCORE, label).first()["pr_auc"]}
            row = train.sparkSession.createDataFrame(
                [tuple(record[c] for c in [*RESULT_COLUMNS, "validation_pr_auc"])], RESULT_SCHEMA)
            rows = row if rows is None else rows.unionByName(row)
        return rows
    finally:
        train.unpersist()


RESULT_SCHEMA = ("model string, accuracy double, precision double, recall double, f1 double, roc_auc double, "
                 "pr_auc double, threshold double, tn long, fp long, fn long, tp long, fit_seconds double, "
                 "validation_pr_auc double")


@dataclass(frozen=True)
class Candidate:
    """One configuration of the staged search."""

    candidate_id: str
    hidden_layers: tuple[int, ...] = (64, 32)
    smote_ratio: float = 0.15
    fraud_class_weight: float = 5.0
    iterations: int = 100
    step_size: float = 0.03


CANDIDATE_SCHEMA = ("candidate_id string, hidden_layers array<int>, smote_ratio double, fraud_class_weight double, "
                    "iterations int, step_size double, order_in_search int, validation_pr_auc double, "
                    "validation_roc_auc double, validation_precision double, validation_recall double, "
                    "validation_f1 double, validation_threshold double")
