"""Synthetic minority rows for nominal features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators.balance import class_counts
from attrition.operators.encode import not_behind, rank_cuts
from attrition.operators.neighbors import knn
from attrition.operators.order_stats import OrderStatistics
from attrition.schemas import FEATURES, KEY, LABEL
from attrition.sources.scratch import cut_lineage

# A value with more than 1/HOT_SHARE of all rows is joined by broadcast: there are at most
# HOT_SHARE such values per feature, and no other value has more rows than that in one task.
HOT_SHARE = 1000
# Distances that agree to this many decimals are ties.
DIGITS = 9


def _cells(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.posexplode("values").alias("f", "v"))


def value_codes(rows: DataFrame, classes: Sequence) -> DataFrame:
    """For each value of each feature: its rows, and the share of each of the ``classes`` among them. Of two classes the
    second one's share says it all."""
    told = classes[1:] if len(classes) == 2 else classes
    shares = [F.avg((F.col("label") == F.lit(c)).cast("double")) for c in told]
    return (
        _cells(rows, "label")
        .groupBy("f", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.array(*shares).alias("code"))
    )


def _coded(rows: DataFrame, codes: DataFrame, n: int) -> DataFrame:
    """``rows`` with a vector of value codes: those of the first feature, of the second, and so on."""
    hot = codes.filter(F.col("n") > n / HOT_SHARE).select("f", "v", F.col("code").alias("hot"))
    cold = codes.filter(F.col("n") <= n / HOT_SHARE).select("f", "v", "code")
    split = _cells(rows, "id").join(F.broadcast(hot), ["f", "v"], "left")
    joined = (
        split.filter(F.col("hot").isNotNull())
        .select("id", "f", F.col("hot").alias("code"))
        .unionByName(
            split.filter(F.col("hot").isNull()).join(cold, ["f", "v"]).select("id", "f", "code")
        )
    )
    # One entry per feature, so a group has as many rows as there are features.
    vectors = joined.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("f", "code"))).alias("pairs")
    )
    return rows.join(vectors, "id").select(
        "id", "key", "copies", "values", F.flatten(F.col("pairs").getField("code")).alias("codes")
    )


def _most_frequent(lists: Column, i: int) -> Column:
    """Most frequent i-th entry of a few arrays; the smallest one of equally frequent ones."""
    entries = F.transform(lists, lambda x: F.element_at(x, i + 1))
    scored = F.transform(
        entries,
        lambda v: F.struct(
            F.size(F.filter(entries, lambda u: u == v)).alias("n"), (-v).alias("negated")
        ),
    )
    return -F.array_max(scored)["negated"]


@dataclass
class _Numbered:
    """The rows with a number of their own, the classes, and the codes of their values."""

    rows: DataFrame
    classes: list
    codes: DataFrame
    n: int


def _numbered(df: DataFrame, features: Sequence[str], classes: Sequence, seed: int, key: str, label: str) -> _Numbered:
    """Written once, for all passes that follow. A row is known by its key if that is a whole number and no other row
    has it, else by a number given here: repeated and missing keys are rows like any others."""
    rows = cut_lineage(
        df.filter(F.col(label).isNotNull()).select(
            F.col(key).alias("key"),
            F.array(*[F.col(c).cast("double") for c in features]).alias("values"),
            F.col(label).alias("label"),
        )
    )
    own = isinstance(df.schema[key].dataType, T.IntegralType)
    if own:
        own = rows.groupBy("key").count().filter((F.col("count") > 1) | F.col("key").isNull()).isEmpty()
    if own:
        rows = rows.withColumn("id", F.col("key").cast("bigint")).withColumn("name", F.col("key").cast("string"))
    else:
        name = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("id"))
        rows = cut_lineage(rows.withColumn("id", F.monotonically_increasing_id())).withColumn("name", name)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("name"))), 1, 15), 16, 10)
    rows = rows.withColumn("draw", draw.cast("bigint"))
    return _Numbered(rows, list(classes), cut_lineage(value_codes(rows, classes)), rows.count())


def _new_rows(
    numbered: _Numbered, n_new: int, minority, features: Sequence[str], k: int, **limits
) -> DataFrame:
    """Seed (``id``, ``key``), ``name`` and ``copy`` of exactly ``n_new`` new rows, and their ``values``."""
    own = numbered.rows.filter(F.col("label") == F.lit(minority))
    statistics = OrderStatistics(own, ["draw"])
    n_minority = statistics.counts["draw"]
    if n_minority <= k:
        raise ValueError(f"need more than {k} rows of class {minority}")
    base, extra = divmod(n_new, n_minority)
    copies = F.lit(base)
    if extra:
        (value,), (tie,) = rank_cuts(own, "draw", "id", statistics, [extra - 1])
        behind = not_behind(F.col("draw"), F.col("id"), F.lit(value), tie)
        copies = copies + behind.cast("int")
    coded = cut_lineage(_coded(own.withColumn("copies", copies), numbered.codes, numbered.n))
    near = knn(
        coded.filter(F.col("copies") > 0), coded, k, "id", "codes",
        exclude_self=True, carry=["values"], digits=DIGITS,
        groups=1 if len(numbered.classes) == 2 else len(numbered.classes), **limits,
    )
    # At most k neighbours per seed.
    lists = near.groupBy(F.col("src").alias("id")).agg(F.collect_list("values").alias("lists"))
    seeds = coded.select("id", "key", "copies").join(own.select("id", "name"), "id")
    return (
        lists.join(seeds, "id")
        .withColumn("values", F.array(*[_most_frequent(F.col("lists"), i) for i in range(len(features))]))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("id", "key", "name", "copy", "values")
    )


def _as_columns(df: DataFrame, features: Sequence[str]) -> list[Column]:
    return [F.col("values")[i].cast(df.schema[c].dataType).alias(c) for i, c in enumerate(features)]


def synthetic_rows(
    df: DataFrame, n_new: int, minority, features: Sequence[str] = FEATURES, k: int = 5,
    seed: int = 42, key: str = KEY, label: str = LABEL, **limits,
) -> DataFrame:
    """Exactly ``n_new`` new rows of the ``minority`` class: (seed_key, copy, *features).

    Two rows are near when their values go along with the classes alike (value difference metric):
    values differ by the sum over all classes of the difference of the class's shares among their rows, and rows by the
    root of the sum of squares over all features. With two classes that is twice the Euclidean distance of one
    class's shares. A new row takes, for each feature, the most frequent value among the ``k`` nearest rows of its
    class to a seed row. Seeds are spread evenly; a hash of the key decides who gets one more.

    Keys may repeat or be missing: each row is a seed and a neighbour of its own."""
    numbered = _numbered(df, features, _sorted_classes(class_counts(df, label), minority), seed, key, label)
    made = _new_rows(numbered, n_new, minority, features, k, **limits)
    return made.select(F.col("key").alias("seed_key"), "copy", *_as_columns(df, features))


def _sorted_classes(counts: dict, minority=None) -> list:
    """The classes; of two the one to be made anew comes last."""
    classes = sorted(counts)
    return sorted(classes, key=lambda c: c == minority) if len(classes) == 2 else classes


def copy_key(kind: T.DataType) -> Column:
    """Key of a synthetic row, from the ``name`` of its seed row and its number: for 64-bit numbers a negative one of 60
    bits, taken from a hash, for text the name and the number; other types cannot hold it and get null."""
    if isinstance(kind, T.LongType):
        digits = F.substring(F.md5(F.concat_ws("#", "name", "copy")), 1, 15)
        return -(F.conv(digits, 16, 10).cast("bigint") + 1)
    if isinstance(kind, T.StringType):
        return F.concat_ws("#", "name", "copy")
    return F.lit(None).cast(kind)


def smoten_oversample(
    df: DataFrame, features: Sequence[str] = FEATURES, k: int = 5, seed: int = 42, key: str = KEY,
    label: str = LABEL, **limits,
) -> DataFrame:
    """The given rows, and as many synthetic rows of every other class as bring it to the size of the largest.

    A synthetic row's key is made from its seed row's and the number of the copy (:func:`copy_key`). Rows without a
    label stay and count for no class. Columns: key, features, label."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        raise ValueError(f"two classes needed, found {sorted(counts)}")
    balanced = df.select(key, *features, label)
    largest = max(counts.values())
    small = [c for c in sorted(counts, key=lambda c: (counts[c], -c)) if counts[c] < largest]
    if not small:
        return balanced
    numbered = _numbered(df, features, _sorted_classes(counts, small[0]), seed, key, label)
    for minority in small:
        new = _new_rows(numbered, largest - counts[minority], minority, features, k, **limits)
        balanced = balanced.unionByName(
            new.select(
                copy_key(df.schema[key].dataType).alias(key),
                *_as_columns(df, features),
                F.lit(minority).cast(df.schema[label].dataType).alias(label),
            )
        )
    return balanced
