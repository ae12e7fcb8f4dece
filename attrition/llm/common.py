"""What the operators share: reading tables, words, row keys, written intermediate tables."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition import ship
from attrition.sources.scratch import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Digits, lower-case letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words. Single characters, as Java looks them up in a bit set.
BETWEEN, BETWEEN_ANY_CASE = (
    "[" + "".join(f"\\x{b:02X}" for b in range(128) if chr(b) not in kept) + "]+"
    for kept in ("0123456789" + LOWER, "0123456789" + LOWER + UPPER)
)
#: The same on UTF-8 bytes: bytes that are no part of a word become spaces, A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables; the package's code goes to the executors first."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the built-in's fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none. The text is split at what stands between
    words, which takes half the time of matching the words."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def word_count(text: Column) -> Column:
    """How many words a text has; the case of letters does not matter for that."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_ANY_CASE), ""))


def words_of(text: str | None) -> list[bytes]:
    """The same words as UTF-8, inside Python tasks."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the folder shared by all executors and read it back: later jobs neither
    compute it again nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but those named, as columns of a select list."""
    dropped = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in dropped]


def fresh(df: DataFrame, name: str) -> str:
    """A name that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system. Python workers are used again by later tasks, and their
    allocators would keep what a finished task has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
