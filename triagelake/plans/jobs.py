"""End-to-end jobs: bundle build, batch scoring, capacity report and staged search."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from functools import partial

from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cleaning import finite_number, scoring_problems, split_rejects, strict_numeric
from ..functions.policy import OPERATING_THRESHOLD
from ..operators import models
from ..operators.encode import Preprocessor, fit_preprocessor
from ..operators.metrics import evaluate
from ..operators.portfolio import ROUNDING_RULE, capacity_summary, cumulative_gains, lift_by_decile
from ..operators.queue import investigation_queue
from ..operators.resample import RATIO, oversample, oversampler, prepare_claims
from ..operators.selection import require_winner
from ..operators.split import SEED, stratified_split
from ..operators.thresholds import validation_records
from ..schema import CATEGORICAL_FEATURES, FEATURES, IDENTIFIERS, TARGET, require_columns, require_training_columns
from ..session import stage
from ..sources.tables import load_preprocessor, save_preprocessor, write_metadata, write_report


def probabilities(df: DataFrame, fitted: Preprocessor, model: Transformer, keep: list[str], on_bad: str = "raise") -> DataFrame:
    """Stored parameters and model applied to raw claims; works on streaming frames too.

    ``on_bad`` says what a missing or malformed number does: ``raise`` stops the job and names
    the column, ``null`` gives the row no score, ``fill`` puts the training mean in its place.
    Unknown and missing categories are coded as unseen in all modes.
    """
    if on_bad not in ("raise", "null", "fill"):
        raise ValueError("on_bad is raise, null or fill")
    require_columns(df, fitted.features, "required claim fields")
    rows = df.select(*[F.col(c).alias(f"__keep_{c}") for c in keep], *fitted.features)
    numbers = {c: strict_numeric(c) if on_bad == "raise" else finite_number(c) for c in fitted.numeric}
    bad = F.lit(False)
    for c in fitted.numeric:
        bad = bad | finite_number(c).isNull()
    encoded = fitted.transform(rows.withColumn("__bad", bad).withColumns(numbers))
    # After scaling the training mean is 0.
    filled = encoded.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in fitted.numeric})
    out = model.transform(models.assembled(filled, fitted.features))
    score = vector_to_array("probability")[1]
    return out.select(*[F.col(f"__keep_{c}").alias(c) for c in keep],
                      (F.when(~F.col("__bad"), score) if on_bad == "null" else score).alias(models.SCORE))


def score_claims(df: DataFrame, fitted: Preprocessor, model: Transformer, source_row: str,
                 reference: str | None = "PolicyNumber", on_bad: str = "raise") -> DataFrame:
    """Claims to ranked queue. A label column is allowed and never read. ``on_bad`` is ``raise`` or ``fill``."""
    reference = reference if reference in df.columns else None
    keep = list(dict.fromkeys([source_row] + ([reference] if reference else [])))
    scores = stage(probabilities(df, fitted, model, keep, on_bad), "scores")  # ranking samples its input first
    return investigation_queue(scores, models.SCORE, source_row, reference)


def checked_upload(df: DataFrame, features: list[str] = FEATURES, categorical: list[str] = CATEGORICAL_FEATURES,
                   bad_record: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(claims that can be scored, rejected claims with their ``problems``), from one written table."""
    require_columns(df, features, "required claim fields")
    problems = scoring_problems(features, categorical, bad_record if bad_record in df.columns else None)
    good, bad = split_rejects(stage(df.withColumn("problems", problems), "checked"))
    return (good.drop(bad_record) if bad_record else good), bad


@dataclass(frozen=True)
class ScoredUpload:
    """Ranked queue of the claims that could be scored, and the others with reasons."""

    queue: DataFrame
    rejects: DataFrame


def score_upload(df: DataFrame, fitted: Preprocessor, model: Transformer, source_row: str,
                 reference: str | None = "PolicyNumber", bad_record: str | None = "bad_record") -> ScoredUpload:
    """Score whatever can be scored; every row of ``df`` is in exactly one of the two outputs."""
    good, bad = checked_upload(df, fitted.features, fitted.categorical, bad_record)
    kept = [c for c in dict.fromkeys([source_row, reference, bad_record]) if c in bad.columns]
    return ScoredUpload(score_claims(good, fitted, model, source_row, reference), bad.select(*kept, "problems"))


@dataclass(frozen=True)
class Bundle:
    fitted: Preprocessor
    model: Transformer


def build_bundle(raw: DataFrame, path: str, ratio: float = RATIO, seed: int = SEED, row_id: str = "PolicyNumber",
                 estimator: Callable[[], Estimator] | None = None) -> Bundle:
    """Fit preprocessing and the boosted model on training rows only and write both with metadata."""
    require_training_columns(raw)
    spark = raw.sparkSession
    split = stratified_split(raw.select(row_id, TARGET, *FEATURES), TARGET, row_id, seed=seed)
    train = stage(split.filter(F.col("split") == "train").drop("split"), "train")
    fitted = fit_preprocessor(train, FEATURES, CATEGORICAL_FEATURES)
    rows = oversample(fitted.transform(train), FEATURES, TARGET, row_id, ratio, seed=seed)
    vectors = stage(models.assembled(rows, FEATURES), "vectors")
    factory = estimator or models.registry(TARGET, seed=seed)["Gradient Boosting"]
    model = factory().fit(vectors)
    save_preprocessor(spark, fitted, f"{path}/preprocessor")
    model.write().overwrite().save(f"{path}/model")
    write_metadata(spark, fitted.metadata() | {
        "model_name": "Gradient Boosting", "selected_threshold": OPERATING_THRESHOLD, "target_column": TARGET,
        "feature_count": len(FEATURES), "dropped_identifier_columns": IDENTIFIERS, "smote_strategy": ratio,
        "inference_requires_raw_dataset": False}, f"{path}/metadata")
    return Bundle(fitted, model)


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    return Bundle(load_preprocessor(spark, f"{path}/preprocessor"), GBTClassificationModel.load(f"{path}/model"))


def capacity_report(scored: DataFrame, score: str, label: str, row_id: str,
                    path: str | None = None) -> dict[str, DataFrame]:
    """Capacity, gains and decile tables from one staged score table, optionally written as files."""
    rows = stage(scored.select(row_id, F.col(label).cast("int").alias(label), score), "scored")
    tables = {
        "top_k_metrics": capacity_summary(rows, score, label, row_id),
        "fraud_capture_curve": cumulative_gains(rows, score, label, row_id),
        "lift_by_decile": lift_by_decile(rows, score, label, row_id),
        "generation_metadata": rows.agg(
            F.count(F.lit(1)).alias("test_claims"), F.sum(label).cast("long").alias("test_fraud_cases"),
            F.lit(OPERATING_THRESHOLD).alias("threshold"), F.lit(ROUNDING_RULE).alias("rounding")),
    }
    if path is not None:
        for name, table in tables.items():
            write_report(table, f"{path}/{name}", "json" if name == "generation_metadata" else "csv")
        write_report(tables["top_k_metrics"], f"{path}/portfolio_metrics", "json")
    return tables


def first_stage() -> list[models.Candidate]:
    # Ratios and weights of the first search stage.
    return [
        models.Candidate("s1_ratio010_weight4", smote_ratio=0.10, fraud_class_weight=4.0),
        models.Candidate("s1_ratio015_weight5", smote_ratio=0.15, fraud_class_weight=5.0),
        models.Candidate("s1_ratio020_weight5", smote_ratio=0.20, fraud_class_weight=5.0),
        models.Candidate("s1_ratio025_weight6", smote_ratio=0.25, fraud_class_weight=6.0),
    ]


def second_stage(best: models.Candidate) -> list[models.Candidate]:
    # Layer sizes of the second search stage.
    layers = {"s2_96x48": (96, 48), "s2_128x64": (128, 64), "s2_128x64x32": (128, 64, 32)}
    return [replace(best, candidate_id=name, hidden_layers=sizes) for name, sizes in layers.items()]


def third_stage(best: models.Candidate) -> list[models.Candidate]:
    """Training length takes the place of the learning rates, which the solver chooses itself."""
    return [replace(best, candidate_id=f"s3_iterations{n}", iterations=n) for n in (50, 150, 200)]


def repeated_positives(df: DataFrame, label: str, weight: float) -> DataFrame:
    """Whole-number class weight for estimators without a weight column: positives appear ``weight`` times."""
    copies = F.when(F.col(label) == 1, F.lit(max(1, round(weight)))).otherwise(F.lit(1))
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")


@dataclass
class Search:
    """Search results so far; test rows never enter."""

    results: DataFrame
    configurations: dict[str, models.Candidate]
    fitted: dict[str, Transformer]

    def best(self, ids: list[str] | None = None) -> models.Candidate:
        rows = self.results if ids is None else self.results.filter(F.col("candidate_id").isin(ids))
        return self.configurations[require_winner(rows, "order_in_search").first()["candidate_id"]]


def side_by_side(spark: SparkSession, work: list[Callable[[], object]], pool: str) -> list:
    """Results of driver-side functions that run Spark jobs at the same time, each in a scheduler pool of its own.

    With the fair scheduler the pools share the cluster; otherwise jobs fill what earlier ones leave idle.
    """
    def run(k: int) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{k}")
        return work[k]()

    with ThreadPoolExecutor(max(1, len(work))) as threads:
        return list(threads.map(run, range(len(work))))


def staged_search(train: DataFrame, validation: DataFrame, features: list[str], label: str, row_id: str,
                  stages: list | None = None, around_stage_winner: bool = False, seed: int = SEED) -> Search:
    """Three rounds of candidates, each built around the best configuration so far.

    ``train`` holds scaled rows without oversampling; neighbours are searched once for all
    ratios, and each ratio's rows are written once. The candidates of a round are fitted side
    by side, and one pass over their scores gives the records of all. ``around_stage_winner``
    builds the next round around the winner of the last round instead of the overall winner.
    """
    models.require_rows(train=train, validation=validation)
    spark = train.sparkSession
    stages = stages or [lambda _: first_stage(), second_stage, third_stage]
    held = stage(models.assembled(validation, features), "held")
    made = oversampler(stage(train, "search-train"), features, label, row_id, seed=seed)
    by_ratio: dict[float, DataFrame] = {}
    search, best, order = Search(None, {}, {}), None, 0
    for number, make in enumerate(stages):
        candidates = make(best)
        for ratio in dict.fromkeys(c.smote_ratio for c in candidates):
            if ratio not in by_ratio:
                by_ratio[ratio] = stage(models.assembled(made.oversampled(ratio), features).select(label, "features"), "train")

        def fit(candidate: models.Candidate) -> Transformer:
            rows = repeated_positives(by_ratio[candidate.smote_ratio], label, candidate.fraud_class_weight)
            return models.network(label, len(features), candidate.hidden_layers, candidate.iterations, seed).fit(rows)

        fitted = side_by_side(spark, [partial(fit, c) for c in candidates], f"search-{number}")
        scored, rows = None, []
        for candidate, model in zip(candidates, fitted):
            part = models.scored(model, held, [row_id, label]).withColumn("candidate_id", F.lit(candidate.candidate_id))
            scored = part if scored is None else scored.unionByName(part)
            search.configurations[candidate.candidate_id] = candidate
            search.fitted[candidate.candidate_id] = model
        # One row per candidate.
        records = {r["candidate_id"]: r.asDict() for r in validation_records(
            stage(scored, "scores"), models.SCORE, label, ["candidate_id"]).collect()}
        for candidate in candidates:
            values = {**asdict(candidate), **records[candidate.candidate_id], "order_in_search": order}
            rows.append(tuple(values[c.split()[0]] for c in models.CANDIDATE_SCHEMA.split(", ")))
            order += 1
        table = spark.createDataFrame(rows, models.CANDIDATE_SCHEMA)
        search.results = table if search.results is None else search.results.unionByName(table)
        best = search.best([c.candidate_id for c in candidates] if around_stage_winner else None)
    return search


def evaluate_winner_once(search: Search, test: DataFrame, features: list[str], label: str, row_id: str) -> DataFrame:
    """The only step that reads test rows: the overall winner at its validation threshold."""
    best = search.best().candidate_id
    threshold = search.results.filter(F.col("candidate_id") == best).first()["validation_threshold"]
    scored = models.scored(search.fitted[best], models.assembled(test, features), [row_id, label])
    return evaluate(scored, models.SCORE, label, threshold).withColumn("candidate_id", F.lit(best))


def benchmark_claims(raw: DataFrame, names: list[str] | None = None, ratio: float = RATIO) -> DataFrame:
    """Classical benchmark on contract claims."""
    return models.run_benchmark(prepare_claims(raw, ratio), TARGET, "PolicyNumber", names)
