"""Row-local projections, filters and cleaning steps. None of them shuffles."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.schemas import BOOLEAN_COLUMNS, IDENTIFIERS, LABEL, PREDICTION

# Rows matching any of these conditions count as outliers.
OUTLIER_RULES = (("CreditScore", "<=", 382), ("Age", ">=", 63), ("NumOfProducts", ">=", 4))

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*IDENTIFIERS)


def project(df: DataFrame, columns: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """Keep ``columns``; a mapping gives new names (``{"old": "new"}``)."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(old).alias(new) for old, new in columns.items()])
    return df.select(*columns)


def feature_columns(df: DataFrame, exclude: Iterable[str] = (*IDENTIFIERS, LABEL)) -> list[str]:
    """Every column but identifiers and label, in schema order."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def cast_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int"))


def bool_to_int(df: DataFrame, columns: Iterable[str] = BOOLEAN_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def fill_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace nulls (and NaN) in numeric columns; text and boolean columns are untouched."""
    return df.fillna(value)


def filter_class(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    return df.filter(F.col(label) == value)


def remove_outliers(df: DataFrame, rules: Iterable[tuple] = OUTLIER_RULES) -> DataFrame:
    """Drop rows that match any rule. A comparison with null does not match, so the row stays.

    Each rule becomes its own conjunct of the form ``c IS NULL OR NOT (c op v)``, which the
    Parquet reader can use to skip row groups.
    """
    for name, op, bound in rules:
        c = F.col(name)
        df = df.filter(c.isNull() | ~_COMPARE[op](c, F.lit(bound)))
    return df


def drop_intermediate(df: DataFrame, columns: Iterable[str] = (
    "features", "scaled_features", "rawPrediction", "probability", "prediction",
)) -> DataFrame:
    return df.drop(*columns)


def mapped(column: Column | str, mapping: Mapping) -> Column:
    """Look a code up in a small literal mapping; a code without entry gives null."""
    c = F.col(column) if isinstance(column, str) else column
    chain = None
    for code, text in mapping.items():
        chain = F.when(c == F.lit(code), F.lit(text)) if chain is None else chain.when(
            c == F.lit(code), F.lit(text)
        )
    return chain if chain is not None else F.lit(None)


def label_map(df: DataFrame, column: str, mapping: Mapping, output: str | None = None) -> DataFrame:
    return df.withColumn(output or column, mapped(column, mapping))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def is_empty(df: DataFrame) -> bool:
    """True when there is no row; reads at most one row instead of counting."""
    return df.isEmpty()


def preview(df: DataFrame, n: int = 5, order_by: Iterable[str] = ()) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the plan is a distributed take-ordered."""
    order = list(order_by)
    return (df.orderBy(*order) if order else df).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def at_risk(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    return df.filter(F.col(prediction) == 1)
