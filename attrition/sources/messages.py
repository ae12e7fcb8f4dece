"""JSON messages in topics or in directories of JSON lines.

The same functions serve a message broker (``fmt="kafka"``, whose connector the caller's session
must provide) and files (``text``, ``parquet``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.schemas import PREDICTION_SCHEMA, SCORING_SCHEMA

CORRUPT = "_corrupt_record"
VALUE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def broker_options(
    servers: str, topic: str, start: str | None = None, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Reader options of a topic subscription."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start is not None:
        options["startingOffsets"] = start
    return {**options, **(extra or {})}


def topic_write_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options: wait for all replicas, retry three times."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def stream_source(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Streaming reader with a ``value`` column. File formats take ``path`` in ``options``."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema or VALUE_SCHEMA)
    return reader.load()


def decode_json(
    df: DataFrame,
    schema: T.StructType = SCORING_SCHEMA,
    column: str = "value",
    corrupt: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Bytes or text to typed columns. With ``corrupt``, the text of a record that is missing,
    malformed or breaks a type is returned in ``_corrupt_record``."""
    raw = F.col(column).cast("string")
    if not corrupt:
        return df.select(*keep, F.from_json(raw, schema).alias("d")).select(*keep, "d.*")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(
        *keep,
        raw.alias("_raw"),
        F.from_json(raw, wide, {"columnNameOfCorruptRecord": CORRUPT}).alias("d"),
    )
    broken = F.when(F.col("_raw").isNull(), F.lit("")).otherwise(F.col(f"d.{CORRUPT}"))
    return parsed.select(*keep, *[F.col("d")[f.name].alias(f.name) for f in schema],
                         broken.alias(CORRUPT))


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON ``value``, with types and nulls kept; ``key`` names a message key."""
    value = F.to_json(
        F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}
    ).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def write_topic(
    df: DataFrame, options: Mapping[str, str], fmt: str = "kafka", key: str | None = None,
    mode: str = "append",
) -> None:
    """Publish every row as JSON. The executors write their own partitions."""
    message = encode_json(df, key if fmt == "kafka" else None)
    message.write.format(fmt).options(**options).mode(mode).save()


def read_predictions(
    spark: SparkSession, fmt: str, options: Mapping[str, str],
    schema: T.StructType = PREDICTION_SCHEMA,
) -> DataFrame:
    """The whole prediction log as a table."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
        return decode_json(spark.read.format(fmt).options(**options).load(), schema)
    reader = spark.read.format(fmt).options(**options).schema(VALUE_SCHEMA)
    return decode_json(reader.load(), schema)


def tail_predictions(
    spark: SparkSession, fmt: str, options: Mapping[str, str],
    schema: T.StructType = PREDICTION_SCHEMA,
) -> DataFrame:
    """Predictions as they arrive. A broker starts at its latest offsets unless told otherwise;
    a directory is read from its first file, its checkpoint then marks what is new."""
    if fmt == "kafka":
        options = {"startingOffsets": "latest", **options}
    return decode_json(stream_source(spark, fmt, options), schema)
