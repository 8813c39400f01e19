"""Cleaning rules as column expressions; none of them needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import FEATURES, SENTINEL_COLUMNS, require_columns

# Upper age of each policy-holder band in the claims contract.
AGE_BANDS = [
    (17, "18 to 20"), (20, "21 to 25"), (25, "26 to 30"), (35, "31 to 35"),
    (45, "36 to 40"), (55, "41 to 50"), (65, "51 to 65"), (80, "over 65"),
]
AGE_ZERO_BAND = "16 to 17"
AGE_MINIMUM = 16
FORM_FEATURES = [c for c in FEATURES if c != "AgeOfPolicyHolder"]


def repair_sentinel(column: str) -> Column:
    """The whole value ``0`` means unknown."""
    return F.when(F.col(column) == "0", F.lit("Unknown")).otherwise(F.col(column))


def numeric_age(column: str = "Age") -> Column:
    """Age as double; text that is no number becomes null."""
    return F.col(column).try_cast("double")


def repair_age(fill: float | Column, column: str = "Age") -> Column:
    """Age 0 stands for unknown and takes the fill value of the training rows."""
    age = numeric_age(column)
    return F.when(age == 0, F.lit(fill) if not isinstance(fill, Column) else fill).otherwise(age)


def clean_claims(df: DataFrame, age_fill: float | Column) -> DataFrame:
    """Repair sentinels and age in place; all other columns pass through."""
    fixes = {c: repair_sentinel(c) for c in SENTINEL_COLUMNS if c in df.columns}
    if "Age" in df.columns:
        fixes["Age"] = repair_age(age_fill)
    return df.withColumns(fixes)


def finite_number(column: str) -> Column:
    """Number, or null for what is none or not finite."""
    value = F.col(column).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def strict_numeric(column: str) -> Column:
    """Number or a runtime error naming the column."""
    value = finite_number(column)
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"{column} must be numeric")).cast("double"))


def age_is_valid(column: str = "Age") -> Column:
    age = numeric_age(column)
    return age.isNotNull() & ~F.isnan(age)


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def repair_make(column: str = "Make") -> Column:
    """Spelling of the form to spelling of the data."""
    return F.when(F.col(column) == "Porsche", "Porche").otherwise(F.col(column))


def display_make(column: str = "Make") -> Column:
    return F.when(F.col(column) == "Porche", "Porsche").otherwise(F.col(column))


def age_band(column: str = "Age") -> Column:
    """Policy-holder band from age; null where no band exists."""
    age = numeric_age(column).cast("int")
    banded = F.when(age == 0, AGE_ZERO_BAND)
    low = AGE_MINIMUM
    for high, name in AGE_BANDS:
        banded = banded.when(age.between(low, high), name)
        low = high + 1
    return banded


def _checked(df: DataFrame, derived: Column) -> DataFrame:
    """Contract columns plus ``problems``; where ``derived`` holds, the age band came from age."""
    required = FORM_FEATURES + ["AgeOfPolicyHolder"]
    tests = [F.when(blank(c) if c != "AgeOfPolicyHolder" else blank(c) & ~derived, F.lit(f"{c} is required"))
             for c in required]
    tests.append(F.when(~age_is_valid() & ~blank("Age"), F.lit("Age must be numeric")))
    tests.append(F.when(derived & age_is_valid() & F.col("AgeOfPolicyHolder").isNull(),
                        F.lit("Age must be between 16 and 80, or 0")))
    others = [c for c in df.columns if c not in FEATURES]
    return df.select(*others, *FEATURES, F.array_compact(F.array(*tests)).alias("problems"))


def request_frame(df: DataFrame) -> DataFrame:
    """Requests with named fields to the 29 contract columns.

    ``AgeOfPolicyHolder`` may be absent; it is then derived from age. The alias of
    the make is repaired. Column ``problems`` lists why a row cannot be scored and
    is empty for good rows; other columns are kept in front.
    """
    require_columns(df, FORM_FEATURES, "input fields")
    out = df.withColumn("Make", repair_make())
    if "AgeOfPolicyHolder" in df.columns:
        return _checked(out, F.lit(False))
    return _checked(out.withColumn("AgeOfPolicyHolder", age_band()), F.lit(True))


def positional_request_frame(df: DataFrame, values: str) -> DataFrame:
    """Requests given as an array of 28 (form order) or 29 (contract order) values per row."""
    short, size = F.size(values) == len(FORM_FEATURES), F.size(values)
    at = lambda i: F.try_element_at(F.col(values), F.lit(i + 1))
    columns = []
    for i, name in enumerate(FEATURES):
        in_form = at(FORM_FEATURES.index(name)) if name in FORM_FEATURES else F.lit(None).cast("string")
        columns.append(F.when(size == len(FEATURES), at(i)).when(short, in_form).alias(name))
    others = [c for c in df.columns if c != values]
    named = df.select(*others, *columns, size.alias("__size")).withColumn("Make", repair_make())
    derived = F.col("__size") == len(FORM_FEATURES)
    band = F.when(derived, age_band()).otherwise(F.col("AgeOfPolicyHolder"))
    checked = _checked(named.withColumn("AgeOfPolicyHolder", band), derived)
    wrong = ~F.col("__size").isin(len(FORM_FEATURES), len(FEATURES))
    return checked.withColumn("problems", F.when(wrong, F.array(F.lit(
        f"Expected {len(FORM_FEATURES)} visible claim fields"))).otherwise(F.col("problems"))).drop("__size")


def scoring_problems(features: list[str], categorical: list[str], bad_record: str | None = None) -> Column:
    """Why a claim cannot be scored: an array that is empty for good rows.

    A malformed record comes first and alone, since its other fields may be shifted. Otherwise
    blank fields, then numbers that are not finite numbers. Unknown categories are no problem.
    """
    tests = [F.when(blank(c), F.lit(f"{c} is required")) for c in features]
    for c in features:
        if c not in categorical:
            tests.append(F.when(~blank(c) & finite_number(c).isNull(), F.lit(f"{c} must be numeric")))
    found = F.array_compact(F.array(*tests))
    return F.when(F.col(bad_record).isNotNull(), F.array(F.lit("malformed record"))).otherwise(found) if bad_record else found


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their problems)."""
    bad = F.size("problems") > 0
    return checked.filter(~bad).drop("problems"), checked.filter(bad)
