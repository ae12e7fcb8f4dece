"""Record layouts shared by the batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """Like ``StructType.fromDDL``, which would need a running session at import time."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: the record layouts that other systems exchange with this library ---

RAW_SCHEMA = _schema(
    "RowNumber BIGINT, CustomerId BIGINT, Surname STRING, CreditScore INT, Geography STRING, "
    "Gender STRING, Age INT, Tenure INT, Balance DOUBLE, NumOfProducts INT, HasCrCard INT, "
    "IsActiveMember INT, EstimatedSalary DOUBLE, Exited INT"
)

# CustomerId is wider than the producers' 32-bit id so that larger key spaces survive.
SCORING_SCHEMA = _schema(
    "CustomerId BIGINT, Surname STRING, CreditScore INT, Age INT, Tenure INT, Balance DOUBLE, "
    "NumOfProducts INT, HasCrCard INT, IsActiveMember INT, EstimatedSalary DOUBLE, "
    "BalanceSalary DOUBLE, TenureAge DOUBLE, ScoreAge DOUBLE, tenure_age DOUBLE, "
    "tenure_salary DOUBLE, score_age DOUBLE, score_salary DOUBLE, newAge INT, "
    "newCreditScore INT, AgeScore INT, BalanceScore INT, SalaryScore INT, "
    "newEstimatedSalary DOUBLE, score_balance DOUBLE, age_balance DOUBLE, "
    "balance_salary DOUBLE, age_hascrcard DOUBLE, product_utilization_rate_by_year DOUBLE, "
    "product_utilization_rate_by_salary DOUBLE, countries_monthly_average_salaries DOUBLE, "
    "Germany BOOLEAN, Spain BOOLEAN, Female BOOLEAN, Male BOOLEAN"
)

IDENTIFIERS = ("RowNumber", "CustomerId", "Surname")
LABEL = "Exited"
PREDICTION = "ChurnPrediction"
KEY = "CustomerId"

# --- end of fixed values ---

BOOLEAN_COLUMNS = tuple(
    f.name for f in SCORING_SCHEMA if isinstance(f.dataType, T.BooleanType)
)
FEATURES = tuple(f.name for f in SCORING_SCHEMA if f.name not in IDENTIFIERS)


def prediction_schema() -> T.StructType:
    """The scored record: booleans become 0/1 integers and the prediction is appended."""
    fields = [
        T.StructField(f.name, T.IntegerType() if f.name in BOOLEAN_COLUMNS else f.dataType)
        for f in SCORING_SCHEMA
    ]
    return T.StructType([*fields, T.StructField(PREDICTION, T.DoubleType())])


PREDICTION_SCHEMA = prediction_schema()

FEATURE_SCHEMA = T.StructType(
    [f for f in RAW_SCHEMA if f.name in IDENTIFIERS]
    + [f for f in SCORING_SCHEMA if f.name not in IDENTIFIERS]
    + [T.StructField(LABEL, T.IntegerType())]
)

_SQL_TYPES = {
    T.LongType(): "BIGINT",
    T.IntegerType(): "INTEGER",
    T.StringType(): "TEXT",
    T.DoubleType(): "DOUBLE PRECISION",
}


def jdbc_column_types(schema: T.StructType = PREDICTION_SCHEMA, text_type: str = "TEXT") -> str:
    """Column list for the ``createTableColumnTypes`` option and for table definitions."""
    return ", ".join(
        f"{f.name.lower()} {text_type if isinstance(f.dataType, T.StringType) else _SQL_TYPES[f.dataType]}"
        for f in schema
    )


def prediction_table_ddl(table: str, text_type: str = "TEXT") -> str:
    """CREATE TABLE statement of the prediction store, keyed by customer."""
    return (
        f"CREATE TABLE {table} ({jdbc_column_types(text_type=text_type)}, "
        f"PRIMARY KEY ({KEY.lower()}))"
    )
