"""Prediction store behind JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.functions.columns import lower_columns
from attrition.schemas import KEY, PREDICTION_SCHEMA, jdbc_column_types

BATCH_ROWS = 10_000


def store_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns in the order of the store, in lower case."""
    return lower_columns(df.select(*(columns or PREDICTION_SCHEMA.fieldNames())))


def last_per_key(
    df: DataFrame, key: str = KEY, order_by: str | Sequence[str] | None = None
) -> DataFrame:
    """One record per key: the last by ``order_by`` (one column or several), else any one of the
    records.

    Records of a key shrink map-side (``max_by`` is a partial aggregate), so a key with very many
    records does not gather in one task."""
    others = [c for c in df.columns if c != key]
    record = F.struct(*[F.col(c) for c in others])
    by = [order_by] if isinstance(order_by, str) else list(order_by or [])
    order = F.struct(*by) if by else F.xxhash64(*[F.col(c) for c in df.columns])
    last = df.groupBy(key).agg(F.max_by(record, order).alias("_last"))
    return last.select(
        *[F.col(c) if c == key else F.col("_last")[c].alias(c) for c in df.columns]
    )


def merge_statement(
    table: str, staging: str, columns: Sequence[str], key: str = KEY.lower(), dialect: str = "merge"
) -> str:
    """One statement that moves a staging table into the store: update known keys, insert others."""
    others = [c for c in columns if c != key]
    if dialect == "on_conflict":
        assignments = ", ".join(f"{c} = EXCLUDED.{c}" for c in others)
        return (
            f"INSERT INTO {table} ({', '.join(columns)}) "
            f"SELECT {', '.join(columns)} FROM {staging} "
            f"ON CONFLICT ({key}) DO UPDATE SET {assignments}"
        )
    if dialect != "merge":
        raise ValueError(f"unknown dialect {dialect}")
    assignments = ", ".join(f"{c} = s.{c}" for c in others)
    return (
        f"MERGE INTO {table} t USING {staging} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {assignments} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def jdbc_write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, text_type: str = "TEXT",
    columns: Sequence[str] | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS), **(properties or {})}
    if columns is None:
        options["createTableColumnTypes"] = jdbc_column_types(text_type=text_type)
    return options


def execute_statements(
    spark: SparkSession, url: str, statements: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> None:
    """Run set statements inside the database in one transaction; no rows pass the driver."""
    jvm = spark._jvm
    given = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        given.setProperty(name, value)
    if properties and "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.executeUpdate(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    upsert: bool = False,
    order_by: str | Sequence[str] | None = None,
    dialect: str = "merge",
    text_type: str = "TEXT",
) -> None:
    """Append the records, each partition through its own connection.

    With ``upsert``, the last record of each key goes to a staging table first and one statement
    merges it, so that repeating a batch updates rows instead of failing on the key."""
    if not upsert:
        options = jdbc_write_options(url, table, properties, text_type, columns)
        store_columns(df, columns).write.format("jdbc").options(**options).mode("append").save()
        return
    rows = store_columns(last_per_key(df, order_by=order_by), columns)
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    options = jdbc_write_options(url, staging, properties, text_type, columns)
    merge = merge_statement(table, staging, rows.columns, dialect=dialect)
    try:
        rows.write.format("jdbc").options(**options).mode("append").save()
        execute_statements(df.sparkSession, url, [merge], properties)
    finally:
        # Also after a failure, so that nothing is left behind.
        execute_statements(df.sparkSession, url, [f"DROP TABLE IF EXISTS {staging}"], properties)
