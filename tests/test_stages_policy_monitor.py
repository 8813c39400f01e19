"""Encoder stage, policy table and the threshold counts of a stream."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from triagelake.functions import policy
from triagelake.operators import policy_table, stages, thresholds
from triagelake.schema import TARGET
from triagelake.sources import testtables as tt
from triagelake.streaming import monitor, scoring

SMALL = "/root/testdata/sf0.001"


def test_pipeline_with_encoder_saves_loads_and_streams(spark, tmp_path):
    claims = tt.contract_claims(spark, SMALL).drop("score").withColumn("Age", F.col("Age").cast("string"))
    pipeline = Pipeline(stages=[stages.ClaimEncoder(inlineValues=4), LogisticRegression(labelCol=TARGET, maxIter=2)])
    pipeline.write().save(str(tmp_path / "unfitted"))
    assert Pipeline.load(str(tmp_path / "unfitted")).getStages()[0].getOrDefault("inlineValues") == 4
    model = pipeline.fit(claims)
    model.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    assert again.stages[0].uid == model.stages[0].uid and again.stages[0].fitted.large is not None
    rows = lambda df: {r["PolicyNumber"]: r["probability"] for r in df.select("PolicyNumber", "probability").collect()}
    expected = rows(model.transform(claims))
    assert rows(again.transform(claims)) == expected and len(expected) == claims.count()
    claims.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = again.transform(scoring.claim_stream(spark, str(tmp_path / "in"), claims.schema)).select("PolicyNumber", "probability")
    scoring.write_decisions(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == expected
    # A number that is missing takes the training mean.
    bad = claims.limit(3).withColumn("Deductible", F.lit(None).cast("int"))
    assert bad.count() == again.transform(bad).where("probability IS NOT NULL").count()


def bands(spark, rows):
    return spark.createDataFrame(rows, "model string, version int, low double, high double, band string")


def test_policy_table_against_a_loop(spark):
    rng = random.Random(2)
    rows = []
    for model in ("a", "b"):
        for version in (1, 2):
            cuts = sorted({0.0, *(rng.randint(1, 999) / 1000 for _ in range(40 * version))})
            rows += [(model, version, low, high, f"{model}{version}-{k}") for k, (low, high) in enumerate(zip(cuts, [*cuts[1:], None]))]
    scores = [(k, rng.choice("ab"), rng.randint(1, 2), rng.choice([rng.random(), rng.randint(0, 1000) / 1000])) for k in range(2000)]
    scores += [(2000, "a", 1, None), (2001, "a", 1, float("nan")), (2002, "a", 1, 1.5), (2003, "c", 1, 0.5), (2004, "a", 9, 0.5), (2005, "a", 1, 1.0), (2006, None, 1, 0.1)]
    df = spark.createDataFrame(scores, "id long, model string, version int, score double")
    found = policy_table.with_policy(df, bands(spark, rows), "score")
    assert found.columns == ["id", "model", "version", "score", "band"]
    got = {r["id"]: r["band"] for r in found.collect()}
    for k, model, version, s in scores:
        hit = [b for m, v, low, high, b in rows if (m, v) == (model, version) and s is not None and 0 <= s <= 1 and low <= s and (high is None or s < high)]
        assert got[k] == (hit[0] if hit else None), (k, s)
    assert len(got) == len(scores) and policy_table.check_policies(bands(spark, rows)).count() == 0
    assert policy_table.with_policy(df, bands(spark, []), "score").where("band IS NULL").count() == len(scores)


def test_policy_join_is_no_nested_loop(spark):
    scores = tt.core_claims(spark, SMALL).withColumns({"model": F.lit("standard"), "version": F.lit(1)})
    got = policy_table.with_policy(scores, policy_table.standard_policy(spark), "score")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    fixed = {r["claim_id"]: r["risk_band"] for r in policy.with_decision(scores, "score").collect()}
    assert {r["claim_id"]: r["risk_band"] for r in got.collect()} == fixed


def test_policy_problems_are_named(spark):
    rows = [("a", 1, 0.0, 0.5, "x"), ("a", 1, 0.4, None, "y"), ("b", 1, 0.1, 0.5, "x"), ("b", 1, 0.6, 1.0, "y"), ("c", 1, 0.0, 0.0, "z"), ("d", 1, 0.0, None, "x")]
    found = {(r["model"], r["low"]): r["problem"] for r in policy_table.check_policies(bands(spark, rows)).collect()}
    assert found == {("a", 0.4): "overlap", ("b", 0.1): "no band from 0", ("b", 0.6): "gap", ("c", 0.0): "empty band"}


def test_streamed_counts_survive_a_restart(spark, tmp_path):
    rng = random.Random(3)
    claims = [(k, rng.randint(0, 1), rng.choice([None, rng.random()]), 1_700_000_000 + k) for k in range(400)]
    schema = "claim_id long, label int, score double, seconds long"
    df = spark.createDataFrame(claims, schema).withColumn("at", F.timestamp_seconds("seconds")).drop("seconds")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def arrive(rows):
        rows.coalesce(1).write.mode("append").parquet(source)

    def watch():
        stream = scoring.claim_stream(spark, source, df.schema, files_per_batch=1)
        monitor.watch_thresholds(monitor.first_reports(stream, "claim_id", "at", "1 hour"), "score", "label", out, state).awaitTermination()

    arrive(df.where("claim_id < 150"))
    arrive(df.where("claim_id BETWEEN 100 AND 250"))
    watch()
    half = thresholds.sweep(df.where("claim_id <= 250"), "score", "label")
    rows = lambda f: sorted(map(tuple, f.select("grid_index", "tn", "fp", "fn", "tp", "f1").collect()))
    assert rows(monitor.threshold_state(spark, out)) == rows(half)
    arrive(df.where("claim_id >= 200"))  # some of them known from before the restart
    watch()
    assert rows(monitor.threshold_state(spark, out)) == rows(thresholds.sweep(df, "score", "label"))
    # A batch that runs again replaces its own counts.
    last = sorted((tmp_path / "out").glob("batch=*"), key=lambda p: int(p.name.split("=")[1]))[-1]
    again = spark.read.parquet(str(last)).collect()
    spark.createDataFrame(again, monitor.SLOTS).coalesce(1).write.mode("overwrite").parquet(str(last))
    assert rows(monitor.threshold_state(spark, out)) == rows(thresholds.sweep(df, "score", "label"))


@pytest.mark.parametrize("by", [None, ["claim_weekday"]])
def test_slots_add_up(spark, by):
    claims = tt.core_claims(spark, SMALL)
    grid = thresholds.SEARCH_GRID
    parts = [thresholds.slot_counts(claims.where(F.col("claim_id") % 3 == k), "score", "label", grid, by) for k in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*(by or []), "slot").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    rows = lambda f: sorted(map(str, f.collect()))
    assert rows(thresholds.counts_from_slots(whole, grid, by)) == rows(thresholds.grid_counts(claims, "score", "label", grid, by))
