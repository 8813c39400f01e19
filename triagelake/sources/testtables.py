"""Claims derived from the order and customer tables of the test data.

One order is one claim. The expressions are plain ANSI SQL, so that a checker can
evaluate the same derivation in another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cleaning import AGE_BANDS, AGE_ZERO_BAND
from ..functions.vocabulary import FORM_ORDER, MONTHS, WEEKDAYS
from ..session import compiled_rows, spread

LABEL = (
    "CASE WHEN (o_orderkey * 7919 + o_custkey * 104729) % 100 < "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 14 WHEN '2-HIGH' THEN 8 ELSE 3 END THEN 1 ELSE 0 END"
)
SCORE = f"CAST((o_orderkey * 48271) % 10007 + 2500 * {LABEL} AS DOUBLE) / CAST(12507 AS DOUBLE)"
AGE = "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 16 + o_custkey % 65 END AS INT)"
WEEKDAY = "CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE o_orderstatus END"

CORE = {
    "claim_id": "o_orderkey", "label": LABEL, "score": SCORE, "age": AGE, "claim_weekday": WEEKDAY,
    "o_custkey": "o_custkey", "o_orderpriority": "o_orderpriority", "o_totalprice": "o_totalprice",
}
# Makes, categories and covers as spelled in the claims contract.
MAKES = ["Accura", "BMW", "Chevrolet", "Dodge", "Ferrari", "Ford", "Honda", "Jaguar", "Lexus", "Mazda",
         "Mecedes", "Mercury", "Nisson", "Pontiac", "Porche", "Saab", "Saturn", "Toyota", "VW"]
CATEGORIES = ["Sedan", "Sport", "Utility"]
COVERS = ["All Perils", "Collision", "Liability"]


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


def _age_band() -> str:
    out, low = f"CASE WHEN {AGE} = 0 THEN '{AGE_ZERO_BAND}'", 16
    for high, name in AGE_BANDS:
        out += f" WHEN {AGE} BETWEEN {low} AND {high} THEN '{name}'"
        low = high + 1
    return out + " END"


def contract_expressions(weekday: str) -> dict[str, str]:
    """All contract columns; ``weekday`` is the engine's expression for 0 = Sunday … 6 = Saturday."""
    month = "CAST(extract(month FROM o_orderdate) AS INT)"
    day = "CAST(extract(day FROM o_orderdate) AS INT)"
    week = lambda d: f"CAST(CASE WHEN {d} <= 7 THEN 1 WHEN {d} <= 14 THEN 2 WHEN {d} <= 21 THEN 3 WHEN {d} <= 28 THEN 4 ELSE 5 END AS INT)"
    sunday_first = WEEKDAYS[-1:] + WEEKDAYS[:-1]
    kind, cover = _pick("o_custkey % 3", CATEGORIES), _pick("o_orderkey % 3", COVERS)
    answers = lambda column, index: _pick(f"({index}) % {len(FORM_ORDER[column])}", FORM_ORDER[column])
    yes_no = lambda index: f"CASE WHEN {index} = 0 THEN 'Yes' ELSE 'No' END"
    price = "o_totalprice / 5"
    return {
        "Month": _pick(f"{month} - 1", MONTHS),
        "WeekOfMonth": week(day),
        "DayOfWeek": _pick(weekday, sunday_first),
        "Make": _pick("o_custkey % 19", MAKES),
        "AccidentArea": "CASE WHEN o_custkey % 10 = 0 THEN 'Rural' ELSE 'Urban' END",
        "DayOfWeekClaimed": f"CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE {_pick(f'({weekday} + o_orderkey % 40) % 7', sunday_first)} END",
        "MonthClaimed": f"CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE {_pick(f'({month} - 1 + o_orderkey % 3) % 12', MONTHS)} END",
        "WeekOfMonthClaimed": week(f"(({day} + o_orderkey % 11) % 31 + 1)"),
        "Sex": "CASE WHEN o_custkey % 6 = 0 THEN 'Female' ELSE 'Male' END",
        "MaritalStatus": _pick("o_custkey % 4", ["Divorced", "Married", "Single", "Widow"]),
        "Age": AGE,
        "Fault": "CASE WHEN o_orderkey % 4 = 0 THEN 'Third Party' ELSE 'Policy Holder' END",
        "PolicyType": f"concat({kind}, ' - ', {cover})",
        "VehicleCategory": kind,
        "VehiclePrice": f"CASE WHEN {price} < 20000 THEN 'less than 20000' WHEN {price} < 30000 THEN '20000 to 29000' "
                        f"WHEN {price} < 40000 THEN '30000 to 39000' WHEN {price} < 60000 THEN '40000 to 59000' "
                        f"WHEN {price} < 70000 THEN '60000 to 69000' ELSE 'more than 69000' END",
        "Deductible": "CAST(300 + 100 * (o_custkey % 5) AS INT)",
        "DriverRating": "CAST(1 + o_orderkey % 4 AS INT)",
        "Days_Policy_Accident": answers("Days_Policy_Accident", "o_orderkey * 3 + o_custkey"),
        "Days_Policy_Claim": answers("Days_Policy_Claim", "o_orderkey + o_custkey * 5"),
        "PastNumberOfClaims": "CASE o_orderpriority WHEN '1-URGENT' THEN 'more than 4' WHEN '2-HIGH' THEN '2 to 4' "
                              "WHEN '3-MEDIUM' THEN '1' ELSE 'none' END",
        "AgeOfVehicle": answers("AgeOfVehicle", "o_custkey * 7"),
        "AgeOfPolicyHolder": _age_band(),
        "PoliceReportFiled": yes_no("o_orderkey % 9"),
        "WitnessPresent": yes_no("o_custkey % 11"),
        "AgentType": "CASE WHEN o_custkey % 20 = 0 THEN 'Internal' ELSE 'External' END",
        "NumberOfSuppliments": answers("NumberOfSuppliments", "o_orderkey * 7 + o_custkey"),
        "AddressChange_Claim": answers("AddressChange_Claim", "o_orderkey * 2 + o_custkey * 3"),
        "NumberOfCars": answers("NumberOfCars", "o_custkey * 2 + o_orderkey"),
        "BasePolicy": cover,
        "PolicyNumber": "o_orderkey",
        "RepNumber": "1 + o_custkey % 16",
        "Year": "CAST(extract(year FROM o_orderdate) AS BIGINT)",
        "FraudFound_P": f"CAST({LABEL} AS INT)",
        "score": SCORE,
    }


def _select(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in expressions.items()]


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")


def core_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claim id, label, score, age, weekday and order columns; one scan, no join."""
    return orders(spark, folder).selectExpr(*_select(CORE))


def wide_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Core claims with segment, balance and nation of the customer."""
    customer = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    claims = spread(orders(spark, folder)).selectExpr(*_select(CORE))
    return (
        claims.join(customer, claims.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .drop("c_custkey", "c_nationkey", "n_nationkey")
    )


def contract_claims(spark: SparkSession, folder: str) -> DataFrame:
    """All contract columns plus ``score``; one scan of orders."""
    compiled_rows(spark)
    return spread(orders(spark, folder)).selectExpr(*_select(contract_expressions("(dayofweek(o_orderdate) - 1)")))


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a real 0/1 label (``toxic``) and their descriptive columns."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    return labels.join(documents, "doc_id").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"), "lang", "source", "n_chars")


CORE_SQL = "SELECT " + ", ".join(_select(CORE)) + " FROM orders"
WIDE_SQL = (f"SELECT c.*, k.c_acctbal, k.c_mktsegment, n.n_name FROM ({CORE_SQL}) c "
            "JOIN customer k ON c.o_custkey = k.c_custkey JOIN nation n ON k.c_nationkey = n.n_nationkey")
CONTRACT_SQL = "SELECT " + ", ".join(_select(contract_expressions("dayofweek(o_orderdate)"))) + " FROM orders"
