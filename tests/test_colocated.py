"""Bucketed tables: joins without an exchange, equal to plain joins."""

import pytest
from pyspark.sql import functions as F

from triagelake.operators import portfolio
from triagelake.sources.colocated import bucket_count, write_colocated


@pytest.fixture
def pair(spark):
    rows = spark.range(5000).select((F.col("id") * 7 % 5003).alias("claim_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    scores = rows.select("claim_id", (F.col("claim_id") / 5003).alias("score")).orderBy(F.desc("claim_id"))
    return rows, scores


def no_broadcast(spark, run):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairing_needs_no_exchange(spark, pair):
    labels, scores = pair

    def run():
        tables = write_colocated({"labels": labels, "scores": scores}, "claim_id", 8)
        joined = portfolio.paired_scores(tables["labels"], tables["scores"], "claim_id")
        assert "Exchange" not in plan(joined) and "Exchange" in plan(portfolio.paired_scores(labels, scores, "claim_id"))
        # The full join's id comes from either side, so only the tables themselves are known to be grouped by it.
        assert "Exchange" not in plan(tables["scores"].groupBy("claim_id").agg(F.max("score").alias("score")))
        assert "Exchange" not in plan(tables["labels"].join(tables["scores"], "claim_id").groupBy("claim_id").count())
        return sorted(map(tuple, joined.collect()))

    assert no_broadcast(spark, run) == sorted(map(tuple, labels.join(scores, "claim_id").collect()))


def test_missing_rows_null_ids_and_empty_tables(spark, pair):
    labels, scores = pair
    tables = write_colocated({"a": labels, "b": scores.where("claim_id > 10")}, "claim_id", 4)
    with pytest.raises(Exception, match="different rows"):
        portfolio.paired_scores(tables["a"], tables["b"], "claim_id").collect()
    null = labels.limit(1).select(F.lit(None).cast("long").alias("claim_id"), "label")
    tables = write_colocated({"a": labels.unionByName(null), "none": scores.limit(0)}, "claim_id", 4)
    assert tables["a"].count() == 5001 and tables["a"].join(tables["none"], "claim_id").count() == 0
    with pytest.raises(ValueError, match="types"):
        write_colocated({"a": labels, "b": scores.withColumn("claim_id", F.col("claim_id").cast("int"))}, "claim_id", 4)


def test_bucket_count_follows_the_rows():
    assert [bucket_count(n, 8) for n in (0, 16_000_000, 16_000_001, 10**10)] == [8, 8, 16, 8192]
    assert bucket_count(0, 0) == 1
