"""Review policies as a table: any number of bands, in versions per model.

A policy row says from which score (inclusive) up to which score (exclusive, null: no end) a
band of a model's version holds, and carries any further columns. Scores and bands meet by
equal (model, version, slice of the score range): a band is entered in each slice that it
touches, a score lies in one. So the join is an equi-join that adaptive execution broadcasts
or splits by measured size, and never compares every score with every band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.policy import BANDS, valid_probability

SLICES = 64
KEYS = ["model", "version"]


def _slice(score: Column, slices: int) -> Column:
    return F.least(F.floor(score * slices), F.lit(slices - 1)).cast("int")


def check_policies(policies: DataFrame) -> DataFrame:
    """Rows of ``policies`` that overlap the band before them or leave a gap to it, with ``problem``; empty if all is well."""
    order = W.partitionBy(*KEYS).orderBy("low", "high")
    before, first = F.lag("high").over(order), F.row_number().over(order) == 1
    last = F.lead("low").over(order).isNull()
    problem = F.when(F.col("low").isNull() | (F.col("high") <= F.col("low")), "empty band").when(
        first & (F.col("low") > 0), "no band from 0").when(~first & (before.isNull() | (before > F.col("low"))), "overlap").when(
        ~first & (before < F.col("low")), "gap").when(last & (F.col("high") <= 1), "no band up to 1")
    return policies.withColumn("problem", problem).where("problem IS NOT NULL")


def with_policy(scores: DataFrame, policies: DataFrame, score: str, model: str = "model", version: str = "version",
                slices: int = SLICES) -> DataFrame:
    """``scores`` with the columns of the band that holds; null where no band does or the score is no probability."""
    extra = [c for c in policies.columns if c not in (*KEYS, "low", "high")]
    high = F.coalesce(F.least("high", F.lit(1.0)), F.lit(1.0))
    touched = F.explode(F.sequence(_slice(F.greatest("low", F.lit(0.0)), slices), _slice(high, slices)))
    bands = policies.where("low <= 1 AND coalesce(high, 2) > 0").select(
        *[F.col(k).alias(f"__{k}") for k in KEYS], F.col("low").alias("__low"), F.col("high").alias("__high"),
        touched.alias("__slice"), *[F.col(c).alias(f"__x_{c}") for c in extra])
    value = F.when(valid_probability(score), F.col(score).cast("double"))
    rows = scores.withColumn("__at", value).withColumn("__in", _slice(F.col("__at"), slices))
    holds = ((F.col(model) == F.col("__model")) & (F.col(version) == F.col("__version")) & (F.col("__in") == F.col("__slice"))
             & (F.col("__at") >= F.col("__low")) & (F.col("__high").isNull() | (F.col("__at") < F.col("__high"))))
    return rows.join(bands, holds, "left").select(*[F.col(c) for c in scores.columns], *[F.col(f"__x_{c}").alias(c) for c in extra])


def standard_policy(spark, model: str = "standard", version: int = 1) -> DataFrame:
    """The four bands of the fixed policy as rows."""
    limits = [0.0, *(band[0] for band in BANDS)]
    rows = [(model, version, low, *band) for low, band in zip(limits, BANDS)]
    return spark.createDataFrame(rows, "model string, version int, low double, high double, risk_band string, review_priority string, "
                                 "recommended_action string, business_interpretation string")
