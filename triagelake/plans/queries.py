"""Runnable queries over the test tables, one or more per operator.

Each function takes (spark, folder) and returns a DataFrame over whole tables.
Floating results are rounded so that another engine can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import cleaning, policy
from ..functions.vocabulary import ORDINAL_CODES, ordinal_code
from ..operators import (
    comoments, encode, metrics, models, policy_table, portfolio, profile, profile_sketches, queue, resample, selection, split, stages, thresholds)
from ..operators.neighbour_index import approximate_neighbours
from ..operators.neighbours import nearest_neighbours
from ..schema import CATEGORICAL_FEATURES, FEATURES, IDENTIFIERS, TARGET
from ..session import stage, staging_folder
from ..sources import colocated, tables, testtables as tt
from ..streaming import monitor, scoring
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMERIC = ["age", "o_totalprice", "c_acctbal"]
CATEGORIES = ["claim_weekday", "c_mktsegment", "n_name", "o_orderpriority"]
MODEL_FEATURES = NUMERIC + CATEGORIES


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 9, **special: int) -> DataFrame:
    """Round every double column."""
    return df.select(*[
        F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def scratch(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


# ---- sources and sinks ----------------------------------------------------------

@query
def claims_scan(spark, folder):
    return tt.contract_claims(spark, folder).select(*FEATURES, *IDENTIFIERS, TARGET)


@query
def claims_overview(spark, folder):
    return rounded(tables.claims_overview(tt.contract_claims(spark, folder)))


@query
def csv_roundtrip(spark, folder):
    path = scratch(spark, "claims-csv")
    tables.write_report(tt.contract_claims(spark, folder).select(*FEATURES, *IDENTIFIERS, TARGET), path)
    claims = tables.read_claims(spark, path)
    return claims.select(*FEATURES, *IDENTIFIERS, TARGET).withColumn("Age", F.col("Age").cast("int"))


@query
def upload_scan(spark, folder):
    path = scratch(spark, "upload-csv")
    tables.write_report(tt.contract_claims(spark, folder).select(*FEATURES, "PolicyNumber"), path)
    return tables.read_upload(spark, path).select("PolicyNumber", "Month", "Days_Policy_Accident", "Deductible")


@query
def report_roundtrip(spark, folder):
    path = scratch(spark, "report")
    report = rounded(portfolio.lift_by_decile(tt.core_claims(spark, folder), "score", "label", "claim_id"))
    tables.write_report(report, path)
    return tables.read_report(spark, path, report.schema)


@query
def split_roundtrip(spark, folder):
    path = scratch(spark, "splits")
    claims = tt.core_claims(spark, folder).select("claim_id", "label", "age")
    tables.write_splits(split.stratified_split(claims, "label", "claim_id"), path)
    schema = "claim_id long, label int, age int, split string"
    return tables.read_splits(spark, path, schema).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("claim_id").alias("id_sum"), F.sum("age").cast("long").alias("age_sum"))


@query
def stored_params(spark, folder):
    path = scratch(spark, "params")
    _, fitted = _fitted(spark, folder)
    tables.save_preprocessor(spark, fitted, path)
    again = tables.load_preprocessor(spark, path)
    return rounded(tables.parameter_table(spark, again).select(
        "kind", "feature", "position", "text", F.col("number").cast("double").alias("number")), 4)


# ---- projections and cleaning ------------------------------------------------------

@query
def sample_rows(spark, folder):
    return profile.sample_rows(tt.core_claims(spark, folder).select("claim_id", "label", "age"), ["claim_id"], 10)


@query
def class_subset(spark, folder):
    return profile.class_subset(tt.core_claims(spark, folder), "label", 1).select("claim_id", "age", "claim_weekday")


def _requests(spark, folder):
    k = F.col("PolicyNumber")
    age = F.when(k % 101 == 0, "unknown").when(k % 103 == 0, " ").when(k % 107 == 0, "99").otherwise(
        F.col("Age").cast("string"))
    return tt.contract_claims(spark, folder).withColumns({
        "Age": age, "Make": cleaning.display_make(), "Sex": F.when(k % 109 != 0, F.col("Sex"))})


@query
def request_frame(spark, folder):
    requests = _requests(spark, folder).drop("AgeOfPolicyHolder", TARGET, "score", "RepNumber", "Year")
    out = cleaning.request_frame(requests)
    return out.select("PolicyNumber", "Make", "Age", "AgeOfPolicyHolder", F.array_join("problems", "; ").alias("problems"))


@query
def positional_requests(spark, folder):
    claims = _requests(spark, folder)
    values = lambda names: F.array(*[F.col(c).cast("string") for c in names])
    k = F.col("PolicyNumber")
    requests = claims.select("PolicyNumber", F.when(k % 3 == 0, values(FEATURES)).when(
        k % 3 == 1, values(cleaning.FORM_FEATURES)).otherwise(values(FEATURES[:5])).alias("values"))
    out = cleaning.positional_request_frame(requests, "values")
    return out.select("PolicyNumber", "Make", "BasePolicy", "AgeOfPolicyHolder",
                      F.array_join("problems", "; ").alias("problems"))


@query
def clean_claims(spark, folder):
    out = cleaning.clean_claims(tt.contract_claims(spark, folder), 40.0)
    return out.select("PolicyNumber", "DayOfWeekClaimed", "MonthClaimed", "Age")


@query
def age_fill(spark, folder):
    claims = split.stratified_split(tt.contract_claims(spark, folder), TARGET, "PolicyNumber")
    return encode.age_fill_value(claims.filter(F.col("split") == "train"))


@query
def age_band(spark, folder):
    claims = tt.core_claims(spark, folder)
    return claims.select("claim_id", "age", cleaning.age_band("age").alias("band"))


@query
def alias_repair(spark, folder):
    claims = tt.contract_claims(spark, folder).withColumn("form_make", cleaning.display_make())
    return claims.select("PolicyNumber", "form_make", cleaning.repair_make("form_make").alias("data_make"))


@query
def rejects(spark, folder):
    requests = _requests(spark, folder)
    _, bad = cleaning.split_rejects(cleaning.request_frame(requests))
    return bad.select("PolicyNumber", F.array_join("problems", "; ").alias("problems"))


def _bad_upload(spark, folder):
    """Claims as an uploaded file with malformed, missing and unusable fields."""
    k = F.col("PolicyNumber")
    spoiled = tt.contract_claims(spark, folder).select(*FEATURES, "PolicyNumber").withColumns({
        "Deductible": F.when(k % 113 == 0, "4oo").otherwise(F.col("Deductible").cast("string")),
        "DriverRating": F.when(k % 109 != 0, F.col("DriverRating")), "Sex": F.when(k % 107 != 0, F.col("Sex")),
        "Age": F.when(k % 103 == 0, "NaN").when(k % 101 == 0, "forty").otherwise(F.col("Age").cast("string"))})
    path = scratch(spark, "bad-upload")
    tables.write_report(spoiled, path)
    return tables.read_upload(spark, path, bad_record="bad_record")


@query
def scoring_rejects(spark, folder):
    """Claims of an upload that cannot be scored, with reasons."""
    _, bad = jobs.checked_upload(_bad_upload(spark, folder), bad_record="bad_record")
    return bad.select("PolicyNumber", F.col("bad_record").isNotNull().alias("malformed"), F.concat_ws("; ", "problems").alias("problems"))


# ---- profiling ---------------------------------------------------------------------

@query
def class_balance(spark, folder):
    return rounded(profile.class_distribution(tt.core_claims(spark, folder), "label"))


@query
def null_counts(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "source")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return profile.null_counts(documents.join(labels, "doc_id", "left"), ["lang", "source", "quality", "toxic"])


@query
def distinct_values(spark, folder):
    return profile.distinct_values(tt.contract_claims(spark, folder), CATEGORICAL_FEATURES)


@query
def anomaly_counts(spark, folder):
    claims = tt.contract_claims(spark, folder).withColumn("VehiclePrice", F.when(
        F.col("PolicyNumber") % 89 == 0, "unlisted").otherwise(F.col("VehiclePrice")))
    return profile.anomaly_counts(claims)


@query
def fraud_rate_by_segment(spark, folder):
    return rounded(profile.ranked_rates(tt.wide_claims(spark, folder), CATEGORIES, "label"))


@query
def document_rates(spark, folder):
    return rounded(profile.rate_by_value(tt.labelled_documents(spark, folder), ["lang", "source"], "toxic"))


@query
def numeric_describe(spark, folder):
    return profile.describe_numeric(tt.wide_claims(spark, folder), NUMERIC)


@query
def merged_profile(spark, folder):
    """Sketches per claim weekday, written, merged and held against exact counts; shares within two percent are close."""
    claims = tt.wide_claims(spark, folder)
    parts = stage(profile_sketches.sketch_parts(claims, F.col("claim_weekday"), NUMERIC, CATEGORIES), "profile-parts")
    merged = stage(profile_sketches.read_sketches(profile_sketches.merge_sketches(parts), [0.25, 0.5, 0.75]), "profile-merged")
    values = profile.long_values(claims, NUMERIC, [], "double").where("value IS NOT NULL").groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))
    # One row per feature: each quartile's share of values below it and up to it.
    q = F.broadcast(merged.select("feature", "quantiles"))
    shares = values.join(q, "feature").select("feature", "value", "n", F.posexplode("quantiles").alias("i", "quartile")).groupBy("feature", "i").agg(
        (F.sum(F.when(F.col("value") < F.col("quartile"), F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(F.col("value") <= F.col("quartile"), F.col("n")).otherwise(0)) / F.sum("n")).alias("upto"))
    wanted = (F.col("i") + 1) / 4
    close = shares.groupBy("feature").agg(F.every((F.col("below") <= wanted + 0.02) & (F.col("upto") >= wanted - 0.02)).alias("quartiles_close"))
    exact = profile.long_values(claims, NUMERIC + CATEGORIES, [], "string").groupBy("feature").agg(
        F.count_distinct("value").alias("distinct_exact"))
    return merged.join(exact, "feature").join(close, "feature", "left").select(
        "feature", "rows", "missing", F.round("low", 2).alias("low"), F.round("high", 2).alias("high"), "distinct_exact",
        (F.abs(F.col("distinct_values") / F.col("distinct_exact") - 1) <= 0.05).alias("distinct_close"), "quartiles_close",
        F.array_join(F.transform("frequent", lambda x: F.concat_ws(":", x["value"], x["n"].cast("string"))), "|").alias("frequent"))


@query
def correlation_matrix(spark, folder):
    return rounded(profile.correlation_matrix(tt.wide_claims(spark, folder), [*NUMERIC, "label"]))


@query
def vector_correlations(spark, folder):
    """Every pair of places of the vectors as two columns of a wide table."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("embedding")
    places = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"place_{i}" for i in range(places)]
    wide = vectors.select(*[F.get("embedding", F.lit(i)).alias(c) for i, c in enumerate(names)])
    return rounded(comoments.correlations(comoments.comoments(wide, names, comoments.shifts(wide, names)), names), 7)


@query
def histogram_by_class(spark, folder):
    return rounded(profile.histogram_by_class(tt.wide_claims(spark, folder), NUMERIC, "label"), 4)


# ---- splitting and encoding ----------------------------------------------------------

@query
def stratified_split(spark, folder):
    return split.stratified_split(tt.core_claims(spark, folder).select("claim_id", "label"), "label", "claim_id")


@query
def split_counts(spark, folder):
    return split.split_counts(split.stratified_split(tt.core_claims(spark, folder), "label", "claim_id"), "label")


@query
def split_80_20(spark, folder):
    return split.split_counts(split.two_way_split(tt.core_claims(spark, folder), "label", "claim_id"), "label")


@query
def split_hashed(spark, folder):
    return split.hashed_split(tt.core_claims(spark, folder).select("claim_id"), "claim_id")


def _split_claims(spark, folder):
    claims = tt.wide_claims(spark, folder).select("claim_id", "label", *MODEL_FEATURES)
    repaired = claims.withColumn("claim_weekday", cleaning.repair_sentinel("claim_weekday"))
    # Three fits and the transform read it; write the join once.
    return stage(split.stratified_split(repaired, "label", "claim_id"), "split", ["split"])


def _fitted(spark, folder):
    claims = _split_claims(spark, folder)
    train = claims.filter(F.col("split") == "train")
    return claims, encode.fit_preprocessor(train, MODEL_FEATURES, CATEGORIES, repair=False)


@query
def category_codes(spark, folder):
    """Codes of the order day: fitted on training rows, joined to held-out rows, unseen days give -1."""
    claims = tt.orders(spark, folder).selectExpr("o_orderkey AS claim_id", f"{tt.LABEL} AS label",
                                                 "date_format(o_orderdate, 'yyyy-MM-dd') AS day")
    claims = split.stratified_split(claims, "label", "claim_id")
    codes = encode.value_codes(claims.filter(F.col("split") == "train"), ["day"])
    coder = encode.Preprocessor(["day"], ["day"], {}, large=codes)
    return coder.encode(claims.filter(F.col("split") != "train").select("claim_id", "day")).select(
        "claim_id", F.col("day").cast("int").alias("code"))


@query
def category_lists(spark, folder):
    return encode.value_codes(tt.contract_claims(spark, folder), CATEGORICAL_FEATURES)


@query
def ordinal_codes(spark, folder):
    claims = tt.contract_claims(spark, folder)
    return claims.select("PolicyNumber", *[ordinal_code(c).alias(c) for c in ORDINAL_CODES])


@query
def label_codes(spark, folder):
    return encode.label_codes(tt.wide_claims(spark, folder).select("claim_id", *CATEGORIES), CATEGORIES)


@query
def category_dictionary(spark, folder):
    claims = cleaning.clean_claims(tt.contract_claims(spark, folder), 40.0)
    return encode.category_dictionary(claims, CATEGORICAL_FEATURES)


@query
def scaler_params(spark, folder):
    _, fitted = _fitted(spark, folder)
    out = tables.parameter_table(spark, fitted).filter(F.col("kind").isin("mean", "deviation"))
    return rounded(out.groupBy("feature").pivot("kind", ["mean", "deviation"]).agg(F.first("number")), 4)


@query
def scaled_features(spark, folder):
    claims, fitted = _fitted(spark, folder)
    return rounded(fitted.transform(claims).select("claim_id", "split", *MODEL_FEATURES), 6)


@query
def legacy_prepared(spark, folder):
    claims = tt.wide_claims(spark, folder).select("claim_id", *MODEL_FEATURES)
    fitted = encode.fit_preprocessor(claims, MODEL_FEATURES, CATEGORIES, repair=False)
    return rounded(fitted.transform(claims), 6)


# ---- resampling ----------------------------------------------------------------------

@query
def neighbours(spark, folder):
    points = profile.class_subset(tt.wide_claims(spark, folder), "label", 1).select("claim_id", F.array(
        F.col("age") / 20, F.col("o_totalprice") / 100000, F.col("c_acctbal") / 3000).alias("vec"))
    return nearest_neighbours(points, "claim_id", "vec", 5).select(
        F.col("id").alias("claim_id"), F.posexplode("neighbours").alias("place", "n")).select(
        "claim_id", (F.col("place") + 1).alias("place"), F.col("n.id").alias("neighbour_id"),
        F.round("n.distance", 6).alias("distance"))


@query
def neighbour_index(spark, folder):
    """The same lists through the projection index; on these points with recall 1."""
    points = profile.class_subset(tt.wide_claims(spark, folder), "label", 1).select("claim_id", F.array(
        F.col("age") / 20, F.col("o_totalprice") / 100000, F.col("c_acctbal") / 3000).alias("vec"))
    return approximate_neighbours(points, "claim_id", "vec", 5, bucket_rows=200).select(
        F.col("id").alias("claim_id"), F.posexplode("neighbours").alias("place", "n")).select(
        "claim_id", (F.col("place") + 1).alias("place"), F.col("n.id").alias("neighbour_id"),
        F.round("n.distance", 6).alias("distance"))


@query
def smote_rows(spark, folder):
    claims, fitted = _fitted(spark, folder)
    train = fitted.transform(claims.filter(F.col("split") == "train"))
    made = resample.synthetic_rows(train, MODEL_FEATURES, "label", "claim_id")
    return rounded(made, 6)


@query
def smote_counts(spark, folder):
    claims, fitted = _fitted(spark, folder)
    train = fitted.transform(claims.filter(F.col("split") == "train"))
    made = resample.oversampler(train, MODEL_FEATURES, "label", "claim_id")  # neighbours are searched once
    out = None
    for ratio in (0.10, 0.15, 0.20, 0.25, 0.50):
        rows = made.oversampled(ratio).groupBy("label").agg(
            F.lit(ratio).alias("ratio"), F.count(F.lit(1)).alias("n"), F.sum("synthetic").cast("long").alias("synthetic"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def prepared_training(spark, folder):
    claims = tt.wide_claims(spark, folder).withColumn("claim_weekday", cleaning.repair_sentinel("claim_weekday"))
    prepared = resample.prepare(claims, "label", "claim_id", MODEL_FEATURES, CATEGORIES, repair=False)
    parts = {"train": prepared.train, "train_original": prepared.train_original,
             "validation": prepared.validation, "test": prepared.test}
    out = None
    for name, rows in parts.items():
        row = rows.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
                       F.sum("label").cast("long").alias("positives"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- metrics and thresholds ------------------------------------------------------------

@query
def confusion(spark, folder):
    return metrics.confusion_counts(tt.core_claims(spark, folder), "score", "label", policy.OPERATING_THRESHOLD)


@query
def metrics_at_threshold(spark, folder):
    return rounded(metrics.evaluate(tt.core_claims(spark, folder), "score", "label", 0.5))


@query
def class_report(spark, folder):
    return rounded(metrics.class_report(tt.core_claims(spark, folder), "score", "label", 0.40))


@query
def roc_auc(spark, folder):
    return rounded(metrics.ranking_metrics(tt.core_claims(spark, folder), "score", "label").select("roc_auc"))


@query
def average_precision(spark, folder):
    return rounded(metrics.ranking_metrics(tt.core_claims(spark, folder), "score", "label").select("pr_auc"))


@query
def roc_points(spark, folder):
    return rounded(metrics.roc_points(tt.core_claims(spark, folder), "score", "label"))


@query
def pr_points(spark, folder):
    return rounded(metrics.pr_points(tt.core_claims(spark, folder), "score", "label"))


@query
def threshold_sweep(spark, folder):
    return rounded(thresholds.sweep(tt.core_claims(spark, folder), "score", "label"))


@query
def best_threshold(spark, folder):
    claims = tt.core_claims(spark, folder)
    out = None
    for goal in ("f1", "recall"):
        row = thresholds.best_threshold(claims, "score", "label", goal).withColumn("goal", F.lit(goal))
        out = row if out is None else out.unionByName(row)
    return rounded(out)


@query
def threshold_sensitivity(spark, folder):
    return rounded(thresholds.sweep(tt.core_claims(spark, folder), "score", "label", thresholds.PLOT_GRID).select(
        "grid_index", "threshold", "precision", "recall", "f1"))


@query
def threshold_table(spark, folder):
    return rounded(thresholds.threshold_table(tt.core_claims(spark, folder), "score", "label"))


@query
def frozen_threshold(spark, folder):
    """Threshold from validation rows, metrics on test rows."""
    claims = split.stratified_split(tt.core_claims(spark, folder), "label", "claim_id")
    part = lambda name: claims.filter(F.col("split") == name)
    return rounded(thresholds.evaluate_at_validation_threshold(part("validation"), part("test"), "score", "label"))


# ---- portfolio --------------------------------------------------------------------------

@query
def top_k(spark, folder):
    return rounded(portfolio.top_k_metrics(tt.core_claims(spark, folder), "score", "label", "claim_id", 2.5))


@query
def capacity_summary(spark, folder):
    return rounded(portfolio.capacity_summary(tt.core_claims(spark, folder), "score", "label", "claim_id"))


@query
def cumulative_gains(spark, folder):
    return rounded(portfolio.cumulative_gains(tt.core_claims(spark, folder), "score", "label", "claim_id"))


@query
def lift_by_decile(spark, folder):
    return rounded(portfolio.lift_by_decile(tt.core_claims(spark, folder), "score", "label", "claim_id"))


@query
def document_lift(spark, folder):
    """Deciles of a real label under a heavily tied score (document length in hundreds)."""
    documents = tt.labelled_documents(spark, folder).withColumn("s", F.floor(F.col("n_chars") / 100).cast("double"))
    return rounded(portfolio.lift_by_decile(documents, "s", "toxic", "doc_id"))


@query
def top_k_rows(spark, folder):
    return rounded(queue.top_share_rows(tt.core_claims(spark, folder).select("claim_id", "score"), "score", "claim_id", 10))


@query
def row_position(spark, folder):
    claims = tt.core_claims(spark, folder).select("claim_id", "o_totalprice")
    return queue.with_row_position(claims, ["o_totalprice", "claim_id"]).select("claim_id", "position")


@query
def scored_label_join(spark, folder):
    claims = tt.core_claims(spark, folder)
    return rounded(portfolio.paired_scores(claims.select("claim_id", "label"), claims.select("claim_id", "score"), "claim_id"))


@query
def colocated_label_join(spark, folder):
    """Labels and scores paired from tables bucketed alike."""
    claims = tt.core_claims(spark, folder)
    buckets = colocated.bucket_count(claims.count(), spark.sparkContext.defaultParallelism)
    kept = colocated.write_colocated(
        {"labels": claims.select("claim_id", "label"), "scores": claims.select("claim_id", "score")}, "claim_id", buckets)
    return rounded(portfolio.paired_scores(kept["labels"], kept["scores"], "claim_id"))


# ---- policy and queue --------------------------------------------------------------------

@query
def risk_decisions(spark, folder):
    claims = tt.core_claims(spark, folder).select("claim_id", "score")
    return rounded(policy.with_decision(claims, "score").drop("score"))


@query
def invalid_scores(spark, folder):
    shifted = tt.core_claims(spark, folder).select("claim_id", (F.col("score") * 1.4 - 0.2).alias("score"))
    bad = F.when(F.col("claim_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("score"))
    return queue.invalid_scores(shifted.withColumn("score", bad), "score").select("claim_id")


@query
def context_cues(spark, folder):
    return tt.contract_claims(spark, folder).select(
        "PolicyNumber", F.array_join(policy.context_cues(), "|").alias("cues"))


@query
def three_tier(spark, folder):
    out = policy.with_three_tiers(tt.contract_claims(spark, folder), "score")
    return out.select("PolicyNumber", "score_percent", "tier", "tier_action", F.array_join("factors", "|").alias("factors"))


@query
def four_tier(spark, folder):
    out = policy.with_four_tiers(tt.core_claims(spark, folder), "score")
    return out.select("claim_id", "probability", "decision", "risk_tier")


def _queue(spark, folder):
    claims = tt.core_claims(spark, folder).withColumn("reference", F.when(
        F.col("claim_id") % 13 == 0, F.lit(" ")).otherwise(F.col("claim_id").cast("string")))
    return queue.investigation_queue(claims, "score", "claim_id", "reference")


@query
def investigation_queue(spark, folder):
    return rounded(_queue(spark, folder).select(
        "investigation_rank", "claim_id", "source_row", "reference_id", "fraud_probability",
        "above_operating_threshold", "risk_band"))


@query
def queue_view(spark, folder):
    return rounded(policy.queue_view(_queue(spark, folder)))


@query
def batch_summary(spark, folder):
    return queue.batch_summary(queue.decided_claims(tt.core_claims(spark, folder), "score", "claim_id", "claim_id"))


@query
def prediction_check(spark, folder):
    out = policy.with_prediction_check(tt.core_claims(spark, folder), "score", "label")
    return out.select("claim_id", "decision", "actual", "correct")


@query
def streamed_decisions(spark, folder):
    """Decisions by a stream over the order files, read back from the sink."""
    source = scratch(spark, "stream-in")
    orders = tt.orders(spark, folder)
    orders.write.parquet(source)
    stream = scoring.claim_stream(spark, source, orders.schema).selectExpr(
        "o_orderkey AS claim_id", f"{tt.SCORE} AS score")
    out = scratch(spark, "stream-out")
    running = scoring.write_decisions(
        scoring.stream_decisions(stream, "score", "claim_id", "claim_id"), out, scratch(spark, "stream-state"))
    running.awaitTermination()
    return rounded(spark.read.parquet(out).select(F.col("source_row").alias("claim_id"), "fraud_probability", "risk_band"))


@query
def policy_bands(spark, folder):
    """The decisions through a policy table with two versions; every seventh claim falls under the second."""
    second = standard = policy_table.standard_policy(spark)
    second = second.withColumns({"version": F.lit(2), "low": F.col("low") / 2, "high": F.col("high") / 2})
    scores = tt.core_claims(spark, folder).select("claim_id", "score", F.lit("standard").alias("model"), F.when(
        F.col("claim_id") % 7 == 0, 2).otherwise(1).alias("version"))
    return rounded(policy_table.with_policy(scores, standard.unionByName(second), "score"))


@query
def streamed_sweep(spark, folder):
    """Threshold counts kept by a stream in which every fifth claim arrives twice."""
    source, out = scratch(spark, "watch-in"), scratch(spark, "watch-out")
    claims = tt.core_claims(spark, folder).select(
        "claim_id", "label", "score", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("claim_id") % 3600).alias("at"))
    claims.unionByName(claims.where("claim_id % 5 = 0")).repartition(4).write.parquet(source)
    stream = scoring.claim_stream(spark, source, claims.schema, files_per_batch=2)
    monitor.watch_thresholds(monitor.first_reports(stream, "claim_id", "at", "2 hours"), "score", "label", out,
                             scratch(spark, "watch-state")).awaitTermination()
    return rounded(monitor.threshold_state(spark, out))


@query
def encoder_stage(spark, folder):
    """The scaled features through a saved and loaded pipeline with the encoder as its stage."""
    claims = split.stratified_split(tt.wide_claims(spark, folder).withColumn(
        "claim_weekday", cleaning.repair_sentinel("claim_weekday")).select("claim_id", "label", *MODEL_FEATURES), "label", "claim_id")
    claims = stage(claims, "split")
    encoder = stages.ClaimEncoder(features=MODEL_FEATURES, categorical=CATEGORIES, repair=False)
    path = scratch(spark, "encoder")
    Pipeline(stages=[encoder]).fit(claims.filter(F.col("split") == "train")).write().save(path)
    return rounded(PipelineModel.load(path).transform(claims).select("claim_id", "split", *MODEL_FEATURES), 6)


# ---- selection among candidate scores -------------------------------------------------------

def _candidates(spark, folder):
    """Four scoring rules for the same claims, two per search stage."""
    claims = tt.core_claims(spark, folder)
    rule = lambda i, stage_name, name, score: F.struct(
        F.lit(i).alias("order_in_search"), F.lit(stage_name).alias("stage"), F.lit(name).alias("candidate_id"),
        score.alias("s"))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 0.3).when(F.col("o_orderpriority") == "2-HIGH", 0.1).otherwise(0.0)
    rules = F.array(
        rule(0, "s1", "plain", F.col("score")), rule(1, "s1", "price", F.col("o_totalprice") / 500000),
        rule(2, "s2", "age", F.col("age") / 100.0), rule(3, "s2", "urgent", F.col("score") * 0.7 + urgent))
    return claims.select("claim_id", "label", F.explode(rules).alias("r")).select("claim_id", "label", "r.*")


KEYS = ["order_in_search", "stage", "candidate_id"]


def _records(spark, folder):
    return thresholds.validation_records(_candidates(spark, folder), "s", "label", KEYS)


def _results(spark, folder):
    counts = metrics.confusion_counts(_candidates(spark, folder), "s", "label", 0.5, KEYS)
    ranking = metrics.ranking_metrics(_candidates(spark, folder), "s", "label", KEYS)
    return counts.join(ranking, KEYS).select(
        F.col("candidate_id").alias("model"), *[c.alias(n) for n, c in metrics.ratios_from_counts().items()],
        "roc_auc", "pr_auc", F.lit(0.5).alias("threshold"), "tn", "fp", "fn", "tp", F.lit(0.0).alias("fit_seconds"),
        "stage")


@query
def validation_records(spark, folder):
    return rounded(_records(spark, folder))


@query
def model_winner(spark, folder):
    return rounded(selection.winner(_records(spark, folder), "order_in_search"))


@query
def staged_winner(spark, folder):
    records = _records(spark, folder)
    per_stage = selection.winner(records, "order_in_search", ["stage"]).withColumn("scope", F.col("stage"))
    return rounded(selection.pooled(
        per_stage, selection.winner(records, "order_in_search").withColumn("scope", F.lit("all"))).select(
        "scope", "candidate_id", "validation_pr_auc", "validation_f1"))


@query
def winner_configuration(spark, folder):
    """The winner joined back to the score range its rule produced."""
    configurations = _candidates(spark, folder).groupBy("candidate_id").agg(
        F.min("s").alias("low"), F.max("s").alias("high"), F.count(F.lit(1)).alias("rows"))
    best = selection.winner(_records(spark, folder), "order_in_search")
    return rounded(selection.winner_configuration(best, configurations))


@query
def results_projection(spark, folder):
    return rounded(selection.results_projection(_results(spark, folder)))


@query
def comparison_append(spark, folder):
    results = _results(spark, folder)
    earlier = selection.results_projection(results.filter(F.col("stage") == "s1"))
    late = results.filter(F.col("model") == "urgent").select("model", "accuracy", "tp", "stage")
    return rounded(selection.append_result(earlier, late))


@query
def best_markers(spark, folder):
    marked = selection.best_markers(_results(spark, folder), ["roc_auc", "recall", "f1"])
    return rounded(marked.select("model", "best_roc_auc", "best_recall", "best_f1", "caught_share", "missed_share"))


@query
def model_comparison(spark, folder):
    return rounded(selection.model_comparison(_results(spark, folder), ["accuracy", "recall", "roc_auc", "f1"]))


# ---- models (no SQL counterpart) ---------------------------------------------------------------

def _benchmark(name: str) -> Query:
    def run(spark, folder):
        return jobs.benchmark_claims(tt.contract_claims(spark, folder), [name])

    return run


for _name in models.MODEL_NAMES:
    QUERIES["benchmark_" + _name.lower().replace(" ", "_")] = _benchmark(_name)


@query
def weighted_benchmark(spark, folder):
    """All models with class weights instead of oversampling."""
    prepared = resample.prepare_claims(tt.contract_claims(spark, folder), ratio=None)
    return models.run_benchmark(prepared, TARGET, "PolicyNumber", weight="weight",
                                factories=lambda total: models.weighted_registry(TARGET, "weight", rows=total))


@query
def network_candidate(spark, folder):
    """One-hidden-layer network on the shared protocol."""
    prepared = resample.prepare_claims(tt.contract_claims(spark, folder))
    return models.run_benchmark(prepared, TARGET, "PolicyNumber", factories=lambda _: {
        "Network": lambda: models.network(TARGET, len(FEATURES))})


@query
def network_search(spark, folder):
    """The default search of three stages; test rows are read once at the end."""
    prepared = resample.prepare_claims(tt.contract_claims(spark, folder), ratio=None)
    search = jobs.staged_search(prepared.train, prepared.validation, FEATURES, TARGET, "PolicyNumber")
    return jobs.evaluate_winner_once(search, prepared.test, FEATURES, TARGET, "PolicyNumber")


def _bundle(spark, folder):
    """A bundle of the folder's claims, built, written and loaded from its files."""
    path = scratch(spark, "bundle")
    jobs.build_bundle(tt.contract_claims(spark, folder), path)
    return jobs.load_bundle(spark, path)


@query
def batch_scoring(spark, folder):
    """Bundle built on training rows, stored, reloaded and applied to all claims as a ranked queue."""
    bundle = _bundle(spark, folder)
    return jobs.score_claims(tt.contract_claims(spark, folder).drop(TARGET), bundle.fitted, bundle.model, "PolicyNumber")


@query
def capacity_report(spark, folder):
    """Scores of a stored bundle on test rows, reported as gains and read back from the files."""
    bundle = _bundle(spark, folder)
    test = split.stratified_split(tt.contract_claims(spark, folder), TARGET, "PolicyNumber").filter(F.col("split") == "test")
    scored = jobs.probabilities(test, bundle.fitted, bundle.model, ["PolicyNumber", TARGET])
    out = scratch(spark, "capacity")
    made = jobs.capacity_report(scored, models.SCORE, TARGET, "PolicyNumber", out)
    return tables.read_report(spark, f"{out}/fraud_capture_curve", made["fraud_capture_curve"].schema)


@query
def bundle_build(spark, folder):
    """Parameter table of a stored and reloaded bundle."""
    return tables.parameter_table(spark, _bundle(spark, folder).fitted)
