import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators import encode, neighbours, resample, split
from triagelake.schema import (
    CATEGORICAL_FEATURES, FEATURES, TARGET, feature_kinds, require_exact_order, require_training_columns)
from triagelake.sources import tables, testtables as tt

SMALL = "/root/testdata/sf0.001"


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, int(i % 20 == 19)) for i in range(200)], "id long, y int")
    out = split.stratified_split(df, "y", "id")
    counts = {r["split"]: (r["n"], r["positives"]) for r in split.split_counts(out, "y").collect()}
    assert {k: v[0] for k, v in counts.items()} == {"train": 140, "validation": 30, "test": 30}
    assert all(abs(p / n - 0.05) <= 0.02 for n, p in counts.values())
    parts = {n: out.filter(F.col("split") == n) for n in counts}
    assert parts["train"].join(parts["test"], "id", "left_semi").count() == 0
    assert parts["validation"].join(parts["test"], "id", "left_semi").count() == 0
    again = split.stratified_split(df.repartition(7), "y", "id")
    assert again.exceptAll(out).count() == 0


def test_published_split_counts():
    cuts = split.class_cuts({0: 14497, 1: 923}, 0.15 + 0.15, 0.15 / 0.30)
    assert cuts[1] == [646, 646 + 139] and cuts[0][0] == 10148
    assert cuts[0][1] - cuts[0][0] + 139 == 2313


@pytest.mark.parametrize("v,t", [(0, .1), (.1, 0), (.5, .5), (-.1, .2)])
def test_bad_split_shares(spark, v, t):
    with pytest.raises(ValueError):
        split.stratified_split(spark.range(3).withColumn("y", F.lit(0)), "y", "id", v, t)


def test_tiny_class_survives(spark):
    df = spark.createDataFrame([(i, int(i == 0)) for i in range(10)], "id long, y int")
    assert split.stratified_split(df, "y", "id").groupBy("split").count().count() == 3


def test_unseen_and_null_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), ("Z",), (None,)], "c string")
    lists, big = encode.category_lists(train, ["c"])
    assert lists == {"c": ["Z", "a", "b"]} and not big
    test = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    assert [r[0] for r in test.select(encode.inline_code(F.col("c"), lists["c"])).collect()] == [1, -1, -1]
    assert test.select(encode.inline_code(F.col("c"), [])).distinct().collect() == [(-1,)]


def test_null_categories_and_columns_without_values(spark):
    rows = [(i, "ab"[i % 2] if i % 3 else None, None) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, c string, x double")
    for most in (10, 1):
        fitted = encode.fit_preprocessor(df, ["c", "x"], ["c"], repair=False, inline_values=most)
        codes = {r["id"]: r["c"] for r in fitted.encode(df).collect()}
        assert all(codes[i] == (-1 if c is None else "ab".index(c)) for i, c, _ in rows)
        assert fitted.deviation["x"] == 1.0 and fitted.mean["x"] == 0.0
        listed = fitted.metadata()
        assert "c" in listed["encoder_categories"] or listed["encoder_category_table"] == {"c": "codes"}


def test_joined_codes_equal_inline_codes(spark):
    df = tt.wide_claims(spark, SMALL).select("claim_id", "n_name", "o_orderpriority", "age")
    features, cats = ["n_name", "o_orderpriority", "age"], ["n_name", "o_orderpriority"]
    inline = encode.fit_preprocessor(df, features, cats, repair=False)
    joined = encode.fit_preprocessor(df, features, cats, repair=False, inline_values=10)
    assert "n_name" not in joined.categories and joined.large is not None
    fresh = df.withColumn("n_name", F.when(F.col("claim_id") % 7 == 0, "NOWHERE").otherwise(F.col("n_name")))
    a = inline.encode(fresh).orderBy("claim_id").select("claim_id", *features).collect()
    b = joined.encode(fresh).orderBy("claim_id").select("claim_id", *features).collect()
    assert a == b and min(r["n_name"] for r in a) == -1


def test_constant_feature_is_not_scaled(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0)], "a double, b double")
    fitted = encode.fit_preprocessor(df, ["a", "b"], [], repair=False)
    rows = fitted.transform(df).orderBy("b").collect()
    assert fitted.deviation["a"] == 1.0 and abs(rows[0]["a"]) < 1e-12
    assert rows[0]["b"] == pytest.approx(-1.0690449676)  # population deviation


def test_fit_reads_training_rows_only(spark, tmp_path):
    claims = tt.contract_claims(spark, SMALL)
    out = split.stratified_split(claims, TARGET, "PolicyNumber")
    train = out.filter(F.col("split") == "train")
    fitted = encode.fit_claims(train.select(*FEATURES))
    ages = [r[0] for r in train.select("Age").collect() if r[0] != 0]
    assert fitted.age_fill == float(np.median(ages))
    edge = claims.limit(1).withColumns({"Make": F.lit("Unheard"), "DayOfWeekClaimed": F.lit("0"), "MonthClaimed": F.lit("0"),
                                        "Age": F.lit(0), "AgeOfPolicyHolder": F.lit("18 to 20")})
    row = fitted.transform(edge.select(*FEATURES)).first()
    assert len(row) == 29 and all(np.isfinite(v) for v in row)
    assert fitted.encode(edge.select(*FEATURES)).first()["Make"] == -1
    tables.save_preprocessor(spark, fitted, str(tmp_path / "p"))
    again = tables.load_preprocessor(spark, str(tmp_path / "p"))
    assert again.metadata() == fitted.metadata() and again.mean == fitted.mean
    assert again.transform(edge.select(*FEATURES)).first() == row
    assert fitted.numeric == ["WeekOfMonth", "WeekOfMonthClaimed", "Age", "Deductible", "DriverRating"]


def test_no_usable_age(spark):
    df = tt.contract_claims(spark, SMALL).select(*FEATURES).withColumn("Age", F.lit(0))
    with pytest.raises(ValueError, match="age"):
        encode.fit_claims(df)


def test_contract_checks(spark):
    claims = tt.contract_claims(spark, SMALL)
    require_training_columns(claims)
    with pytest.raises(ValueError, match=r"\['Age', 'Sex'\]"):
        require_training_columns(claims.drop("Sex", "Age"))
    require_exact_order(claims.select(*FEATURES))
    with pytest.raises(ValueError):
        require_exact_order(claims.select(*reversed(FEATURES)))
    cats, nums = feature_kinds(claims.select(*FEATURES, TARGET))
    assert cats == CATEGORICAL_FEATURES and "Age" in nums and TARGET not in nums


def brute_neighbours(ids, points, k):
    gaps = np.zeros((len(ids), len(ids)))
    for d in range(points.shape[1]):
        gaps += (points[:, d, None] - points[None, :, d]) ** 2
    gaps = np.round(gaps, neighbours.DIGITS)
    return {int(ids[a]): [int(ids[b]) for b in np.lexsort((ids, gaps[a])) if b != a][:k] for a in range(len(ids))}


@pytest.mark.parametrize("per_cell,block", [(20_000, 20_000), (40, 15), (90, 1_000)])
def test_neighbours_match_brute_force(spark, per_cell, block):
    draw = np.random.default_rng(5)
    points = np.concatenate([np.tile([1.0, 2.0, 3.0], (200, 1)),  # a third are copies of one point
                             draw.integers(0, 4, (200, 3)).astype(float), draw.normal(size=(200, 3))])
    ids = draw.permutation(5000)[:600]
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points)], "id long, vec array<double>")
    found = neighbours.nearest_neighbours(df, "id", "vec", 5, per_cell, block).collect()
    assert {r["id"]: [n["id"] for n in r["neighbours"]] for r in found} == brute_neighbours(ids, points, 5)


def test_oversampling(spark):
    draw = np.random.default_rng(6)
    rows = [(i, int(i % 10 == 0), *map(float, draw.normal(size=2))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    out = resample.oversample(df, ["a", "b"], "y", "id", 0.5)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 180, 1: 90}
    assert out.filter("synthetic = 0").select("id", "y", "a", "b").exceptAll(df).count() == 0
    box = {c: (min(r[i] for r in rows if r[1]), max(r[i] for r in rows if r[1])) for c, i in (("a", 2), ("b", 3))}
    for r in out.filter("synthetic = 1").collect():
        assert all(box[c][0] <= r[c] <= box[c][1] for c in box)
    with pytest.raises(ValueError, match="at least 6"):
        resample.synthetic_rows(df.filter("y = 0 or id < 50"), ["a", "b"], "y", "id")
    with pytest.raises(ValueError, match="ratio"):
        resample.synthetic_rows(df, ["a", "b"], "y", "id", 0.01)
    assert resample.synthetic_total(10148, 646, 0.5) == 4428


def test_only_training_rows_are_resampled(spark):
    prepared = resample.prepare_claims(tt.contract_claims(spark, SMALL))
    n = tt.contract_claims(spark, SMALL).count()
    assert prepared.validation.count() + prepared.test.count() + prepared.train_original.count() == n
    positives = prepared.train.agg(F.sum(TARGET), F.count(F.lit(1))).first()
    negatives = positives[1] - positives[0]
    assert positives[0] == int(0.5 * negatives)
    assert "synthetic" not in prepared.validation.columns


def test_claims_are_generated_in_methods_that_java_compiles(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    try:
        spark.conf.set(limit, "65535")
        rows = tt.contract_claims(spark, SMALL)
        assert int(spark.conf.get(limit)) <= 8000
        pieces = rows.toPandas()
        spark.conf.set(limit, "65535")
        assert rows.select("*").toPandas().equals(pieces)
        spark.conf.set(limit, "4000")
        tt.contract_claims(spark, SMALL)
        assert spark.conf.get(limit) == "4000"
    finally:
        spark.conf.unset(limit)
