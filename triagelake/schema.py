"""The claims contract: column names, types and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Column names and order of the claims file format.
FEATURES = [
    "Month", "WeekOfMonth", "DayOfWeek", "Make", "AccidentArea",
    "DayOfWeekClaimed", "MonthClaimed", "WeekOfMonthClaimed", "Sex",
    "MaritalStatus", "Age", "Fault", "PolicyType", "VehicleCategory",
    "VehiclePrice", "Deductible", "DriverRating", "Days_Policy_Accident",
    "Days_Policy_Claim", "PastNumberOfClaims", "AgeOfVehicle",
    "AgeOfPolicyHolder", "PoliceReportFiled", "WitnessPresent", "AgentType",
    "NumberOfSuppliments", "AddressChange_Claim", "NumberOfCars", "BasePolicy",
]
NUMERIC_FEATURES = ["WeekOfMonth", "WeekOfMonthClaimed", "Age", "Deductible", "DriverRating"]
CATEGORICAL_FEATURES = [c for c in FEATURES if c not in NUMERIC_FEATURES]
IDENTIFIERS = ["PolicyNumber", "RepNumber", "Year"]
TARGET = "FraudFound_P"
SENTINEL_COLUMNS = ["DayOfWeekClaimed", "MonthClaimed"]


def claims_schema(with_target: bool = True) -> T.StructType:
    """Typed claims schema; ``Age`` stays a string so that bad values reach the cleaning rules."""
    fields = []
    for name in FEATURES:
        kind = T.IntegerType() if name in NUMERIC_FEATURES and name != "Age" else T.StringType()
        fields.append(T.StructField(name, kind))
    fields += [T.StructField(name, T.LongType()) for name in IDENTIFIERS]
    if with_target:
        fields.append(T.StructField(TARGET, T.IntegerType()))
    return T.StructType(fields)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: list[str], what: str = "required columns") -> None:
    """Raise with the sorted list of absent names."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"input is missing {what}: {missing}")


def require_training_columns(df: DataFrame) -> None:
    require_columns(df, FEATURES + IDENTIFIERS + [TARGET])


def require_exact_order(df: DataFrame, features: list[str] = FEATURES) -> None:
    """Fitting and scoring accept the feature frame only in contract order."""
    if df.columns != list(features):
        raise ValueError("columns differ from the contract in name or order")


def feature_kinds(df: DataFrame, target: str = TARGET) -> tuple[list[str], list[str]]:
    """Column names split into (categorical, numeric) by type, target left out."""
    categorical, numeric = [], []
    for field in df.schema.fields:
        if field.name == target:
            continue
        if isinstance(field.dataType, T.StringType):
            categorical.append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
    return categorical, numeric
