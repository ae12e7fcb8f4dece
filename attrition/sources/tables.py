"""Tables in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    infer_schema: bool = False,
    **options,
) -> DataFrame:
    """A file table with a fixed schema. CSV has a header; inferring its types costs one more
    pass over the data and must be asked for."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            if not infer_schema:
                raise ValueError("give a schema for CSV, or ask for infer_schema")
            reader = reader.option("inferSchema", True)
    elif fmt == "json" and schema is None and not infer_schema:
        raise ValueError("give a schema for JSON, or ask for infer_schema")
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    single_file: bool = False,
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Replace the table at ``path``. ``single_file`` sends all rows through one task; it is meant
    for small extracts and is off by default."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**options)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
