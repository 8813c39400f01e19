import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.functions import cleaning, policy
from triagelake.schema import FEATURES
from triagelake.sources import tables


def test_band_limits(spark):
    """Each limit and its neighbours among doubles, and a grid between them."""
    limits = [band[0] for band in policy.BANDS[:-1]]
    scores = sorted({*np.linspace(0, 1, 53), *limits, *np.nextafter(limits, 0), *np.nextafter(limits, 1)})
    df = spark.createDataFrame([(float(s),) for s in scores], "s double")
    got = {r["s"]: r["risk_band"] for r in policy.with_decision(df, "s").collect()}
    assert got == {s: policy.BANDS[sum(s >= limit for limit in limits)][1] for s in scores}


def test_decision_fields(spark):
    row = policy.with_decision(spark.createDataFrame([(0.24,)], "s double"), "s").select(*policy.DECISION_COLUMNS).first()
    assert row["above_operating_threshold"] is True and row["operating_threshold"] == 0.24
    assert row["review_priority"] == "Elevated" and "does not establish" in row["disclaimer"]


@pytest.mark.parametrize("bad", [float("nan"), -0.01, 1.01, None])
def test_bad_scores(spark, bad):
    df = spark.createDataFrame([(bad,)], "s double")
    with pytest.raises(Exception, match="between 0 and 1"):
        policy.with_decision(df, "s").collect()
    relaxed = policy.with_decision(df, "s", strict=False).first()
    assert relaxed["risk_band"] is None and relaxed["above_operating_threshold"] is None


def test_claim_ids(spark):
    df = spark.createDataFrame([("A", 1), (" ", 2), (None, 3), (" x ", 4), (None, 1234567)], "r string, p long")
    assert [r[0] for r in df.select(policy.claim_id("r", "p")).collect()] == [
        "A", "CLM-00002", "CLM-00003", " x ", "CLM-1234567"]


def test_age_bands(spark):
    """Every whole age, against the upper ends of the bands searched from below."""
    upper = [high for high, _ in cleaning.AGE_BANDS]
    df = spark.range(-2, 100).selectExpr("CAST(id AS INT) AS Age")
    got = {r[0]: r[1] for r in df.select("Age", cleaning.age_band()).collect()}
    for age, band in got.items():
        inside = cleaning.AGE_MINIMUM <= age <= upper[-1]
        assert band == (cleaning.AGE_ZERO_BAND if age == 0 else cleaning.AGE_BANDS[bisect.bisect_left(upper, age)][1] if inside else None)
    assert len(set(got.values())) == len(upper) + 2


def test_cleaning_edges(spark):
    df = spark.createDataFrame([("0", "0", "0"), ("Monday", "Jan", "33"), (None, None, "x")],
                               "DayOfWeekClaimed string, MonthClaimed string, Age string")
    rows = [tuple(r) for r in cleaning.clean_claims(df, 38.5).collect()]
    assert rows == [("Unknown", "Unknown", 38.5), ("Monday", "Jan", 33.0), (None, None, None)]
    with pytest.raises(Exception, match="Age must be numeric"):
        df.select(cleaning.strict_numeric("Age")).collect()


def sample_claims(spark, n=3):
    values = {c: "x" for c in FEATURES} | {"Age": "30", "Make": "Porsche", "PoliceReportFiled": "Yes"}
    return spark.createDataFrame([(i, *[values[c] for c in FEATURES]) for i in range(n)],
                                 "id int, " + ", ".join(f"{c} string" for c in FEATURES))


def test_requests(spark):
    df = sample_claims(spark).withColumn("Age", F.element_at(F.array(*map(F.lit, ["30", "old", " "])), F.col("id") + 1))
    good, bad = cleaning.split_rejects(cleaning.request_frame(df.drop("AgeOfPolicyHolder")))
    row = good.first()
    assert good.count() == 1 and row["Make"] == "Porche" and row["AgeOfPolicyHolder"] == "31 to 35"
    assert good.columns == ["id", *FEATURES]
    assert {r["id"]: r["problems"] for r in bad.collect()} == {1: ["Age must be numeric"], 2: ["Age is required"]}
    with pytest.raises(ValueError, match="Sex"):
        cleaning.request_frame(df.drop("Sex"))


def test_cues(spark):
    quiet = sample_claims(spark, 1).withColumn("DriverRating", F.lit(2))
    assert quiet.select(policy.context_cues()).first()[0] == ["Police report filed", "No witness recorded"]
    loud = quiet.withColumns({"PoliceReportFiled": F.lit("No"), "Days_Policy_Accident": F.lit("more than 30"),
                              "PastNumberOfClaims": F.lit("2 to 4"), "NumberOfSuppliments": F.lit("3 to 5"),
                              "AddressChange_Claim": F.lit("1 year"), "DriverRating": F.lit(1), "Fault": F.lit("Third Party")})
    assert len(loud.select(policy.context_cues()).first()[0]) == 8


def test_csv_keeps_the_answer_none(spark, tmp_path):
    df = sample_claims(spark).withColumns({"Days_Policy_Claim": F.lit("none"), "Sex": F.lit(None).cast("string")}).drop("id")
    tables.write_report(df, str(tmp_path / "c"))
    row = tables.read_upload(spark, str(tmp_path / "c")).first()
    assert row["Days_Policy_Claim"] == "none" and row["Sex"] is None
    with pytest.raises(ValueError, match="FraudFound_P"):
        tables.read_claims(spark, str(tmp_path / "c"))
