"""Train/test split, class sampling and class weights.

``method="hash"`` decides on a hash of the row key: the same rows on any partitioning, after any
retry and in any engine. A row without a key is hashed by its values. ``method="native"`` is Spark's
own sampler.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.hashing import below, key_or_row, poisson_copies, row_hash
from attrition.schemas import KEY, LABEL

MAX_CLASSES = 1000


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def class_counts(df: DataFrame, label: str = LABEL, max_classes: int = MAX_CLASSES) -> dict:
    """Rows per class on the driver. A label with more than ``max_classes`` values raises."""
    rows = (
        class_distribution(df.filter(F.col(label).isNotNull()), label)
        .limit(max_classes + 1)
        .collect()
    )
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes")
    return {r[label]: r["n_rows"] for r in sorted(rows, key=lambda r: r[label])}


def split_part(key: Column | str, weights: Sequence[float], seed: int) -> Column:
    """Number of the part a row belongs to."""
    total = float(sum(weights))
    h = row_hash(key, seed)
    chain, upto = None, 0.0
    for part, weight in enumerate(weights[:-1]):
        upto += weight / total
        chain = (F if chain is None else chain).when(below(h, upto), F.lit(part))
    last = F.lit(len(weights) - 1)
    return last if chain is None else chain.otherwise(last)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, key: str = KEY,
    method: str = "hash",
) -> list[DataFrame]:
    if method == "native":
        return df.randomSplit(list(weights), seed)
    part = split_part(key_or_row(df, key), weights, seed)
    return [df.filter(part == i) for i in range(len(weights))]


def undersample(
    df: DataFrame, cls, fraction: float, seed: int = 42, key: str = KEY, label: str = LABEL,
    method: str = "hash",
) -> DataFrame:
    """Keep about ``fraction`` of one class, without replacement. Other classes are left out."""
    rows = df.filter(F.col(label) == cls)
    if method == "native":
        return rows.sample(False, fraction, seed)
    return rows.filter(below(row_hash(key_or_row(df, key), seed, "under"), fraction))


def oversample(
    df: DataFrame, cls, fraction: float, seed: int = 42, key: str = KEY, label: str = LABEL,
    method: str = "hash",
) -> DataFrame:
    """Each row of one class appears Poisson(``fraction``) times. Other classes are left out."""
    rows = df.filter(F.col(label) == cls)
    if method == "native":
        return rows.sample(True, fraction, seed)
    # The hash is a column of its own, so it is computed once per row for all its comparisons; an
    # empty array drops the row without a filter that would compute it again.
    return (
        rows.withColumn("_hash", row_hash(key_or_row(df, key), seed, "over"))
        .withColumn("_copies", F.array_repeat(F.lit(1), poisson_copies(F.col("_hash"), fraction)))
        .withColumn("_copy", F.explode("_copies"))
        .drop("_hash", "_copies", "_copy")
    )


def union_classes(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def balance_classes(
    df: DataFrame, keep: float = 0.5, repeat: float = 2.0, seed: int = 42, key: str = KEY,
    label: str = LABEL, method: str = "hash",
) -> DataFrame:
    """``keep`` of class 0 without replacement and ``repeat`` times class 1 with replacement."""
    return union_classes(
        undersample(df, 0, keep, seed, key, label, method),
        oversample(df, 1, repeat, seed, key, label, method),
    )


def _two_classes(df: DataFrame, label: str) -> tuple:
    counts = class_counts(df, label, max_classes=2)
    if len(counts) != 2:
        raise ValueError(f"two classes needed, found {sorted(counts)}")
    small, large = sorted(counts, key=lambda c: (counts[c], -c))
    return small, large, counts[large] / counts[small]


def oversample_to_ratio(
    df: DataFrame, seed: int = 0, key: str = KEY, label: str = LABEL, method: str = "hash"
) -> DataFrame:
    """The whole larger class and the smaller one drawn to about the same size."""
    small, large, ratio = _two_classes(df, label)
    return union_classes(
        df.filter(F.col(label) == large),
        oversample(df, small, ratio, seed, key, label, method),
    )


def undersample_to_ratio(
    df: DataFrame, seed: int = 42, key: str = KEY, label: str = LABEL, method: str = "hash"
) -> DataFrame:
    """The whole smaller class and the larger one thinned to about the same size."""
    small, large, ratio = _two_classes(df, label)
    return union_classes(
        undersample(df, large, 1 / ratio, seed, key, label, method),
        df.filter(F.col(label) == small),
    )


def class_weights(df: DataFrame, label: str = LABEL, output: str = "weight") -> DataFrame:
    """Weight total / (classes * rows of the class), for any number of classes; null has none.

    The counts are joined by label; a class with a large share of the rows is split by the
    adaptive join, or its side is broadcast where Spark finds it small."""
    counts = class_distribution(df.filter(F.col(label).isNotNull()), label)
    total, classes = counts.agg(F.sum("n_rows"), F.count(F.lit(1))).first()
    weights = counts.select(
        F.col(label).alias("_class"),
        (F.lit(total or 0) / (F.lit(classes or 1) * F.col("n_rows"))).alias(output),
    )
    return df.drop(output).join(weights, F.col(label) == F.col("_class"), "left").drop("_class")
