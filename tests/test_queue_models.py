import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from triagelake.operators import models, queue
from triagelake.operators.resample import Prepared
from triagelake.plans import jobs
from triagelake.schema import TARGET
from triagelake.sources import testtables as tt
from triagelake.streaming import scoring

SMALL = "/root/testdata/sf0.001"


def test_queue_order_by_sorting(spark):
    draw = np.random.default_rng(8)
    scores = draw.integers(0, 12, 300) / 11
    names = [str(n) if n % 7 else " " for n in draw.integers(1, 90, 300)]  # repeats and blanks; text order, not number order
    df = spark.createDataFrame([(names[i], i, float(scores[i])) for i in range(300)], "ref string, row long, s double")
    rows = queue.investigation_queue(df, "s", "row", "ref").orderBy("investigation_rank").collect()
    claim = lambda i: names[i] if names[i].strip() else f"CLM-{i + 1:05d}"
    expected = sorted(range(300), key=lambda i: (-scores[i], claim(i), i))
    assert [r["source_row"] for r in rows] == expected and [r["claim_id"] for r in rows] == [claim(i) for i in expected]
    assert [r["investigation_rank"] for r in rows] == list(range(1, 301))


def test_equal_ids_fall_back_to_source_row(spark):
    df = spark.createDataFrame([("x", r, .5) for r in (3, 1, 2)], "ref string, row long, s double")
    rows = queue.investigation_queue(df, "s", "row", "ref").orderBy("investigation_rank").collect()
    assert [r["source_row"] for r in rows] == [1, 2, 3]


def test_empty_batch(spark):
    df = spark.createDataFrame([], "ref string, row long, s double")
    assert queue.investigation_queue(df, "s", "row", "ref").count() == 0
    assert queue.batch_summary(queue.decided_claims(df, "s", "row", "ref")).first()["scored"] == 0


def arrays(spark, seed=0):
    """Two overlapping clouds; every fifth of the rows is held for each of validation and test."""
    draw = np.random.default_rng(seed)
    y = (draw.random(200) < 0.25).astype(int)
    x = draw.normal(size=(200, 5)) + y[:, None] * draw.uniform(0.5, 1.5, 5)
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(200)],
                               "id long, y int, " + ", ".join(f"{n} double" for n in names))
    part = lambda *rest: df.filter((F.col("id") % 5).isin(*rest))
    return Prepared(part(0, 1, 2), part(0, 1, 2), part(3), part(4), None, names, df)


def test_benchmark_returns_all_metrics(spark):
    prepared = arrays(spark)
    factories = models.registry("y", 120.0)
    assert list(factories) == models.MODEL_NAMES
    small = {"Logistic Regression": factories["Logistic Regression"], "Decision Tree": factories["Decision Tree"],
             "SVM": lambda: models.CalibratedSVC("y", count=16, folds=2),
             "Gradient Boosting": lambda: GBTClassifier(featuresCol="features", labelCol="y", maxIter=5, maxDepth=2)}
    rows = models.run_benchmark(prepared, "y", "id", factories=lambda _: small).collect()
    assert [r["model"] for r in rows] == list(small)
    for r in rows:
        assert 0.10 <= r["threshold"] <= 0.90 and r["tn"] + r["fp"] + r["fn"] + r["tp"] == 40
        assert r["roc_auc"] > 0.5 and all(0 <= r[m] <= 1 for m in ("accuracy", "precision", "recall", "f1", "pr_auc"))


def test_empty_partition_is_an_error(spark):
    p = arrays(spark)
    empty = Prepared(p.train, p.train_original, p.validation.limit(0), p.test, None, p.features, p.raw)
    with pytest.raises(ValueError, match="validation"):
        models.run_benchmark(empty, "y", "id")


def test_model_without_probability(spark):
    class Plain:
        def transform(self, df):
            return df

    with pytest.raises(TypeError, match="Plain"):
        models.scored(Plain(), spark.range(1), ["id"])


def test_search_never_reads_test_rows(spark):
    p = arrays(spark)
    first = lambda _: [models.Candidate("a", (4,), 0.3, 2.0, 5), models.Candidate("b", (4,), 0.4, 1.0, 5)]
    second = lambda best: [models.Candidate("c", (6, 4), best.smote_ratio, best.fraud_class_weight, 5)]
    search = jobs.staged_search(p.train, p.validation, p.features, "y", "id", [first, second])
    assert [r["candidate_id"] for r in search.results.orderBy("order_in_search").collect()] == ["a", "b", "c"]
    final = jobs.evaluate_winner_once(search, p.test, p.features, "y", "id").first()
    assert final["candidate_id"] == search.best().candidate_id and final["tn"] + final["fp"] + final["fn"] + final["tp"] == 40
    assert len(jobs.first_stage()) == 4 and len(jobs.second_stage(jobs.first_stage()[0])) == 3


def test_bundle_scoring_and_stream(spark, tmp_path):
    claims = tt.contract_claims(spark, SMALL)
    small = lambda: GBTClassifier(featuresCol="features", labelCol=TARGET, maxIter=3, maxDepth=2)
    jobs.build_bundle(claims, str(tmp_path / "bundle"), estimator=small)
    bundle = jobs.load_bundle(spark, str(tmp_path / "bundle"))
    ranked = jobs.score_claims(claims.drop(TARGET), bundle.fitted, bundle.model, "PolicyNumber").collect()
    assert sorted(r["investigation_rank"] for r in ranked) == list(range(1, claims.count() + 1))
    with pytest.raises(ValueError, match="Sex"):
        jobs.score_claims(claims.drop("Sex"), bundle.fitted, bundle.model, "PolicyNumber")
    bad = claims.withColumn("Age", F.lit("about forty"))
    with pytest.raises(Exception, match="Age must be numeric"):
        jobs.probabilities(bad, bundle.fitted, bundle.model, ["PolicyNumber"]).collect()

    source = str(tmp_path / "in")
    claims.repartition(3).write.parquet(source)
    stream = scoring.claim_stream(spark, source, claims.schema, files_per_batch=1)
    scored = scoring.stream_probabilities(stream, bundle.fitted, bundle.model, ["PolicyNumber"])
    decided = scoring.stream_decisions(scored, "score", "PolicyNumber", "PolicyNumber")
    scoring.write_decisions(decided, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    streamed = {r["claim_id"]: r["fraud_probability"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == {r["claim_id"]: r["fraud_probability"] for r in ranked}
    scoring.queue_per_batch(scored, "PolicyNumber", "PolicyNumber", str(tmp_path / "q"), str(tmp_path / "qs")).awaitTermination()
    batches = spark.read.parquet(str(tmp_path / "q"))
    assert batches.count() == claims.count() and batches.select("batch").distinct().count() == 3


def test_repeated_positives(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "id int, y int")
    assert jobs.repeated_positives(df, "y", 5.0).groupBy("y").count().orderBy("y").collect()[1]["count"] == 5


def test_weighted_models_prefer_positives(spark):
    p = arrays(spark)
    train = models.assembled(models.with_class_weight(p.train, "y"), p.features)
    plain = LogisticRegression(featuresCol="features", labelCol="y").fit(train)
    weighted = models.weighted_registry("y", "weight")["Logistic Regression"]().fit(train)
    mean = lambda m: models.scored(m, train, ["id"]).agg(F.avg("score")).first()[0]
    assert mean(weighted) > mean(plain)


def test_weighted_benchmark_penalises_the_summed_weight(spark, monkeypatch):
    from triagelake.plans import queries

    seen = []
    registry = models.weighted_registry
    made = lambda *a, **k: seen.append(k["rows"]) or {"Logistic Regression": registry(*a, **k)["Logistic Regression"]}
    monkeypatch.setattr(models, "weighted_registry", made)
    row = queries.QUERIES["weighted_benchmark"](spark, SMALL).first()
    train = queries.resample.prepare_claims(tt.contract_claims(spark, SMALL), ratio=None).train
    total = models.with_class_weight(train, TARGET).agg(F.sum("weight")).first()[0]
    assert seen == [total] and row["model"] == "Logistic Regression" and row["fit_seconds"] > 0
    assert registry("y", "w", rows=total)["Logistic Regression"]().getRegParam() == 1 / total > 0


def margins_of(spark, rows=600, seed=3):
    draw = np.random.default_rng(seed)
    y = (draw.random(rows) < 0.3).astype(int)
    x = draw.normal(size=(rows, 12)) + 0.5 * y[:, None] * (np.arange(12) < 3)
    names = [f"v{i}" for i in range(12)]
    df = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(rows)], "id long, y int, " + ", ".join(f"{n} double" for n in names))
    return models.assembled(df.coalesce(1), names)


def test_calibration_margins_are_out_of_fold(spark):
    df = margins_of(spark, 200)
    machine = models.CalibratedSVC("y", count=8, folds=3)
    lifted = machine.raised(df)(df).persist()
    seen = []

    class Watched:
        def fit(self, rows):
            seen.append({tuple(r[0].toArray()) for r in rows.select("features").collect()})
            return inner.fit(rows)

    inner, machine.machine = machine.machine, Watched()
    found = machine.margins(lifted)
    assert found.count() == 200 and len(seen) == 3
    folds = lifted.withColumn("fold", F.pmod(F.xxhash64(models.vector_to_array("features"), F.lit(machine.seed)), F.lit(3)))
    for fold in range(3):
        own = {tuple(r[0].toArray()) for r in folds.where(F.col("fold") == fold).select("features").collect()}
        assert own and not own & seen[fold]


def test_cross_fitted_curve_is_no_worse_on_new_rows(spark):
    """With many features for few rows, margins of training rows are too good and make the curve too steep."""
    train, fresh = margins_of(spark, 120, 4), margins_of(spark, 1000, 5)
    loss = {}
    for folds in (0, 3):
        model = models.CalibratedSVC("y", count=64, folds=folds).fit(train)
        p = F.col("score")
        loss[folds] = models.scored(model, fresh, ["y"]).agg(F.avg((p - F.col("y")) ** 2)).first()[0]
    assert loss[3] <= loss[0] + 1e-3, loss


def test_raised_rows_are_not_kept(spark, monkeypatch):
    """Beside the copy that a machine keeps of its rows, raised rows are neither cached nor written."""
    staged, write = [], models.stage
    monkeypatch.setattr(models, "stage", lambda df, name: staged.append(df.columns) or write(df, name))
    df = spark.createDataFrame([(float(i % 5), float(i % 7), int(i % 5 > 2)) for i in range(100)], "a double, b double, y int")
    machine, kept = models.CalibratedSVC("y", count=8, folds=2), []

    class Watched:
        def fit(self, rows):
            kept.append(rows.storageLevel.useMemory or rows.storageLevel.useDisk)
            assert len(rows.select("features").first()[0]) == 8
            return inner.fit(rows)

    inner, machine.machine = machine.machine.setMaxIter(3), Watched()
    model = machine.fit(models.assembled(df, ["a", "b"]))
    assert kept == [False] * 3
    assert [sorted(c) for c in staged] == [["features", "fold", "y"], ["fold", "margin", "y"]]
    assert models.scored(model, models.assembled(df, ["a", "b"]), ["y"]).count() == 100


def test_a_large_forest_scores_in_passes(spark, monkeypatch):
    """No pass holds more nodes than allowed; scores and repeated or null row ids are as in one pass."""
    df = margins_of(spark, 400, 7)
    model = models.RandomForestClassifier(labelCol="y", numTrees=7, maxDepth=6, seed=1).fit(df)
    rows = df.withColumn("id", F.when(F.col("id") % 5 > 0, F.col("id") % 20)).unionByName(df)
    once = [tuple(r) for r in models.scored(model, rows, ["id", "y"]).collect()]
    nodes = [t.numNodes for t in model.trees]
    monkeypatch.setattr(models, "PASS_NODES", max(nodes) + min(nodes))
    sizes = [[t.numNodes for t in part.trees] for part in models.forest_parts(model)]
    assert sum(sizes, []) == nodes and len(sizes) > 2 and all(sum(s) <= models.PASS_NODES for s in sizes)
    passes = [tuple(r) for r in models.scored(model, rows, ["id", "y"]).collect()]
    plain = lambda found: sorted((-1 if a is None else a, b, round(c, 12)) for a, b, c in found)
    assert len(once) == 800 and plain(passes) == plain(once)


def test_splitting_nodes_takes_little_of_a_task():
    """With 1024 MB per task, two tasks filled a heap of 1800 MB on deep trees."""
    for made in (models.registry("y"), models.weighted_registry("y", "w")):
        assert made["Random Forest"]().getMaxMemoryInMB() <= 256
