"""Uploads with bad rows: two outputs, lenient scoring, streams."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from triagelake.functions import cleaning
from triagelake.plans import jobs
from triagelake.schema import CATEGORICAL_FEATURES, FEATURES, TARGET
from triagelake.sources import tables, testtables as tt
from triagelake.streaming import scoring

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bundle(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bundle"))
    jobs.build_bundle(tt.contract_claims(spark, SMALL), path, estimator=lambda: LogisticRegression(
        featuresCol="features", labelCol=TARGET, maxIter=3))
    fitted = jobs.load_preprocessor(spark, f"{path}/preprocessor")
    from pyspark.ml.classification import LogisticRegressionModel
    return jobs.Bundle(fitted, LogisticRegressionModel.load(f"{path}/model"))


def spoiled(spark):
    """Every tenth claim lacks a number, every tenth has a word for one, every tenth an unknown category."""
    k = F.col("PolicyNumber") % 10
    return tt.contract_claims(spark, SMALL).drop(TARGET).withColumns({
        "Deductible": F.when(k == 1, None).otherwise(F.col("Deductible")),
        "Age": F.when(k == 2, "old").otherwise(F.col("Age").cast("string")),
        "Make": F.when(k == 3, "Trabant").otherwise(F.col("Make"))})


def test_every_row_is_scored_or_rejected(spark, bundle):
    claims = spoiled(spark)
    out = jobs.score_upload(claims, bundle.fitted, bundle.model, "PolicyNumber")
    queue, rejects = out.queue.collect(), {r["PolicyNumber"]: r["problems"] for r in out.rejects.collect()}
    everything = {r[0] for r in claims.select("PolicyNumber").collect()}
    assert {r["source_row"] for r in queue} | set(rejects) == everything and len(queue) + len(rejects) == len(everything)
    assert {k % 10 for k in rejects} == {1, 2}
    assert {p for k, found in rejects.items() for p in found if k % 10 == 1} == {"Deductible is required"}
    assert {p for k, found in rejects.items() for p in found if k % 10 == 2} == {"Age must be numeric"}
    assert sorted(r["investigation_rank"] for r in queue) == list(range(1, len(queue) + 1))


def test_modes_of_bad_numbers(spark, bundle):
    claims = spoiled(spark)
    with pytest.raises(Exception, match="must be numeric"):
        jobs.probabilities(claims, bundle.fitted, bundle.model, ["PolicyNumber"]).collect()
    null = {r[0]: r[1] for r in jobs.probabilities(claims, bundle.fitted, bundle.model, ["PolicyNumber"], "null").collect()}
    assert {k % 10 for k, s in null.items() if s is None} == {1, 2}
    fill = {r[0]: r[1] for r in jobs.probabilities(claims, bundle.fitted, bundle.model, ["PolicyNumber"], "fill").collect()}
    assert all(0 <= s <= 1 for s in fill.values()) and all(fill[k] == s for k, s in null.items() if s is not None)
    mean = claims.withColumn("Deductible", F.coalesce(F.col("Deductible").cast("double"), F.lit(bundle.fitted.mean["Deductible"])))
    mean = mean.withColumn("Age", F.coalesce(F.col("Age").try_cast("double"), F.lit(bundle.fitted.mean["Age"])))
    expected = {r[0]: r[1] for r in jobs.probabilities(mean, bundle.fitted, bundle.model, ["PolicyNumber"]).collect()}
    assert fill == pytest.approx(expected)
    with pytest.raises(ValueError, match="on_bad"):
        jobs.probabilities(claims, bundle.fitted, bundle.model, ["PolicyNumber"], "skip")


def test_stream_survives_bad_numbers(spark, bundle, tmp_path):
    claims = spoiled(spark)
    claims.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = scoring.claim_stream(spark, str(tmp_path / "in"), claims.schema, files_per_batch=1)
    scored = scoring.stream_probabilities(stream, bundle.fitted, bundle.model, ["PolicyNumber"])
    decided = scoring.stream_decisions(scored, "score", "PolicyNumber", "PolicyNumber")
    scoring.write_decisions(decided, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == claims.count()
    assert {int(r["claim_id"]) % 10 for r in rows if r["fraud_probability"] is None} == {1, 2}


def test_malformed_lines_keep_their_text(spark, tmp_path):
    header = [*FEATURES, "PolicyNumber"]
    good = {c: "x" for c in header} | {c: "1" for c in FEATURES if c not in CATEGORICAL_FEATURES} | {"PolicyNumber": "7"}
    lines = [good, good | {"PolicyNumber": "8", "Deductible": "4oo"}, good | {"PolicyNumber": "9", "Age": "inf"}]
    text = "\n".join([",".join(header), *(",".join(x[c] for c in header) for x in lines), "x,x"]) + "\n"
    (tmp_path / "upload.csv").write_text(text)
    df = tables.read_upload(spark, str(tmp_path / "upload.csv"), bad_record="bad_record")
    kept, bad = jobs.checked_upload(df, bad_record="bad_record")
    assert [r["PolicyNumber"] for r in kept.collect()] == [7] and "bad_record" not in kept.columns
    found = {r["PolicyNumber"]: (r["bad_record"], r["problems"]) for r in bad.collect()}
    assert found[9] == (None, ["Age must be numeric"])
    assert all(found[k][1] == ["malformed record"] for k in (8, None)) and found[None][0] == "x,x" and "4oo" in found[8][0]
    assert "bad_record" not in tables.read_upload(spark, str(tmp_path / "upload.csv")).columns


def test_problems_of_hand_made_rows(spark):
    rows = spark.createDataFrame([("a", "1"), (" ", "1"), ("a", None), ("a", "-Infinity"), (None, "x"), ("a", "1e3")], "kind string, n string")
    got = [r[0] for r in rows.select(cleaning.scoring_problems(["kind", "n"], ["kind"])).collect()]
    assert got == [[], ["kind is required"], ["n is required"], ["n must be numeric"], ["kind is required", "n must be numeric"], []]
