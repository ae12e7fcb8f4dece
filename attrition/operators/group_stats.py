"""Exact quantiles and box statistics of any number of groups.

A group and column with at most ``small`` values is sorted
as a whole, which is one small array. A larger one is narrowed: approximate percentiles, whose partial results are
merged, give two values around each wanted rank; counting tells exactly how many values lie below and between them; and
this goes on among those between until they are few, or all the same.

The rows, with the wanted columns alone, are shuffled once, by group, and written in that order; no pass shuffles them again, as
what it needs to know of a group is kept in one row that lies with them. Groups with more than about ``hot`` rows, which a sample
tells, and the rows without group stay where they are: what a pass needs to know of them goes to all tasks, and
only their counts and sketches are shuffled. So a group with a third of all rows is no hot spot, and no such group is gathered
as a whole. The number of groups is
bounded by nothing: there is no list of them on the driver, and no expression for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.operators.stats import WHISKER
from attrition.sources.scratch import cut_lineage

SMALL = 50_000
#: Of the approximate percentiles: the error of a rank is at most this part of the rows.
ACCURACY = 2_000
STEPS, MOST_PASSES = 200, 30
#: Rows of a group that is not moved, rows of such a group in the sample that finds it, and rows of a part that is written.
HOT, HOT_SAMPLE, PART_ROWS = 50_000, 400, 500_000


@dataclass
class _Layout:
    """Rows with ``_group`` and the wanted columns as ``_0``, ``_1`` and so on. Those of a group lie together unless it is hot."""

    rows: DataFrame
    names: list[str]
    hot: bool

    def meet(self, state: DataFrame) -> DataFrame:
        """The rows with what is known of their groups, which has one row for each."""
        if not self.hot:
            return self.rows.join(state, "_group")
        known = F.broadcast(state.withColumnRenamed("_group", "_own"))
        return self.rows.join(known, F.col("_group").eqNullSafe(F.col("_own"))).drop("_own")

    def value(self, f: Column) -> Column:
        return F.get(F.array(*[f"_{i}" for i in range(len(self.names))]), f)


def _layouts(df: DataFrame, columns: Iterable[str], by: str, hot: int) -> list[_Layout]:
    names = list(columns)
    values = [F.col(f"`{c}`").cast("double") for c in names]
    wide = df.select(F.col(f"`{by}`").alias("_group"), *[F.when(~F.isnan(v), v).alias(f"_{i}") for i, v in enumerate(values)])
    wide = wide.filter(reduce(lambda a, b: a | b, [F.col(f"_{i}").isNotNull() for i in range(len(names))]))
    # The sample only tells which rows stay where they are.
    share = min(1.0, HOT_SAMPLE / hot)
    some = wide.select("_group") if share == 1 else wide.select("_group").filter(F.rand(7) < share)
    large = some.groupBy("_group").count().filter(F.col("_group").isNotNull() & (F.col("count") > hot * share)).select("_group")
    large = cut_lineage(large)
    none = F.col("_group").isNull()
    if large.isEmpty():
        moved, kept = wide.filter(~none), wide.filter(none)
    else:
        moved = wide.filter(~none).join(F.broadcast(large), "_group", "left_anti")
        kept = wide.filter(none).unionByName(wide.join(F.broadcast(large), "_group", "left_semi"))
    # No fewer than Spark's own, or it would deal the rows anew.
    parts = max(math.ceil(df.count() / PART_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    moved = _dealt(moved.repartition(parts, "_group").sortWithinPartitions("_group"))
    kept = cut_lineage(kept)
    return [_Layout(moved, names, False)] + ([] if kept.isEmpty() else [_Layout(kept, names, True)])


def _dealt(df: DataFrame) -> DataFrame:
    """Written so that Spark still knows which rows lie together and in what order. Of an adaptive plan it does not know, so this one
    plan is not."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    was = conf.get(name)
    conf.set(name, "false")
    try:
        return cut_lineage(df)
    finally:
        conf.set(name, was)


def _inside(value: Column) -> Column:
    """Whether a value lies between the borders of an open rank, which are null at first and no part of it."""
    low, high = F.col("o.low"), F.col("o.high")
    return (low.isNull() | (value > low)) & (high.isNull() | (value < high))


def _interpolated(n: Column, p: float, at_rank) -> Column:
    """The quantile ``p`` of ``n`` values, of which ``at_rank`` tells those at ranks. Whole numbers up to 2^53 are exact in a double,
    as ranks are here."""
    place = F.lit(float(p)) * (n - 1)
    low = F.floor(place).cast("bigint")
    part = place - F.floor(place)
    a, b = at_rank(low), at_rank(F.least(low + 1, n - 1))
    return F.when((a == b) | (part == 0), a).otherwise(a + (b - a) * part)


def _small(layout: _Layout, counts: DataFrame, probabilities: Sequence[float], small: int) -> DataFrame:
    """``_group``, ``f``, ``n``, ``quantiles`` and sorted ``values`` of the groups and columns that are sorted as a whole."""
    every = range(len(layout.names))
    # Lists of larger ones stay empty.
    lists = [F.sort_array(F.collect_list(F.when(F.col(f"n{i}") <= small, F.col(f"_{i}")))).alias(f"v{i}") for i in every]
    whole = layout.meet(counts).groupBy("_group").agg(*lists)
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"v{i}").alias("values")) for i in every])
    cells = whole.select("_group", F.explode(F.filter(cells, lambda c: F.size(c["values"]) > 0)).alias("c"))
    n = F.size("values").cast("bigint")
    return cells.select("_group", "c.f", "c.values").select(
        "_group", "f", n.alias("n"),
        F.array(*[_interpolated(n, p, lambda at: F.get("values", at.cast("int"))) for p in probabilities]).alias("quantiles"), "values",
    )


def _large(layout: _Layout, counts: DataFrame, probabilities: Sequence[float], small: int) -> DataFrame | None:
    """``_group``, ``f``, ``n`` and ``quantiles`` of those that are narrowed."""
    asked = []
    for i in range(len(layout.names)):
        n = F.col(f"n{i}")
        places = [F.floor(F.lit(float(p)) * (n - 1)).cast("bigint") for p in probabilities]
        ranks = F.array_distinct(F.array(*places, *[F.least(at + 1, n - 1) for at in places]))
        ranks = F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("left")))
        none = F.lit(None).cast("double")
        asked.append(F.struct(F.lit(i).alias("f"), n.alias("size"), n.alias("n"), none.alias("low"), none.alias("high"), ranks.alias("ranks")))
    opened = F.filter(F.array(*asked), lambda o: o["n"] > small)
    still = counts.select("_group", opened.alias("open")).filter(F.size("open") > 0)
    if still.isEmpty():
        return None
    found = cut_lineage(_narrowed(layout, still, small))
    whole = found.groupBy("_group", "f", "size").agg(F.map_from_entries(F.collect_list(F.struct("rank", "q"))).alias("at"))
    quantiles = [_interpolated(F.col("size"), p, lambda at: F.element_at("at", at)) for p in probabilities]
    return whole.select("_group", "f", F.col("size").alias("n"), F.array(*quantiles).alias("quantiles"))


def _narrowed(layout: _Layout, still: DataFrame, small: int) -> DataFrame:
    """The values at the ranks of large groups: ``_group``, ``f``, ``size``, ``rank`` and ``q``. An open rank has ``n`` values between its
    borders, and ``left`` counts from the first of these; ranks with the same borders are looked for together. Each pass finds two values
    around each: the rank's value is one of them or lies between
    them, and if few do, these are sorted. So a value that very many rows share is passed over or found at once."""
    value = layout.value(F.col("o.f")).alias("v")
    found = []

    def near(state: DataFrame) -> DataFrame:
        rows = layout.meet(state).withColumn("o", F.explode("open"))
        return rows.select("_group", "o", value).filter(F.col("v").isNotNull() & _inside(F.col("v")))

    def by_group(rows: DataFrame, *names: str) -> DataFrame:
        return rows.groupBy("_group").agg(F.collect_list(F.struct(*names)).alias("open"))

    for _ in range(MOST_PASSES):
        points = near(still).groupBy("_group", "o").agg(
            F.percentile_approx("v", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]), ACCURACY).alias("points"),
            F.min("v").alias("least"), F.max("v").alias("most"),
        )
        around = points.select("_group", "o.f", "o.size", "o.n", "o.low", "o.high", "points", "least", "most", F.explode("o.ranks").alias("r"))
        around = around.withColumn("left", F.col("r.left")).select("_group", "f", "size", "low", "high", "r", *_around())
        around = around.groupBy("_group", "f", "size", "low", "high", "from", "to").agg(F.collect_list("r").alias("ranks"))
        v, a, b = F.col("v"), F.col("o.from"), F.col("o.to")
        counted = near(by_group(around, "f", "size", "low", "high", "from", "to", "ranks")).groupBy("_group", "o").agg(
            F.count_if(v < a).alias("below"), F.count_if(v == a).alias("at_from"),
            F.count_if((v > a) & (v < b)).alias("n"),
        )
        placed = counted.select("_group", "o.f", "o.size", "o.from", "o.to", "n", "below", "at_from", F.explode("o.ranks").alias("r"))
        place = F.col("r.left") - F.col("below") - F.col("at_from")
        placed = cut_lineage(placed.select("_group", "f", "size", "from", "to", "n", F.col("r.rank").alias("rank"), place.alias("place")))
        edge = (F.col("place") < 0) | (F.col("place") >= F.col("n"))
        q = F.when(F.col("place") < 0, F.col("from")).otherwise(F.col("to")).alias("q")
        found.append(placed.filter(edge).select("_group", "f", "size", "rank", q))
        rest = placed.filter(~edge).groupBy("_group", "f", "size", "n", F.col("from").alias("low"), F.col("to").alias("high"))
        rest = rest.agg(F.collect_list(F.struct("rank", F.col("place").alias("left"))).alias("ranks"))
        state = ("f", "size", "n", "low", "high", "ranks")
        few = rest.filter(F.col("n") <= small)
        if not few.isEmpty():
            lists = near(by_group(few, *state)).groupBy("_group", "o").agg(F.sort_array(F.collect_list("v")).alias("values"))
            lists = lists.select("_group", "o.f", "o.size", "values", F.explode("o.ranks").alias("r"))
            found.append(lists.select("_group", "f", "size", "r.rank", F.get("values", F.col("r.left").cast("int")).alias("q")))
        more = rest.filter(F.col("n") > small)
        if more.isEmpty():
            return reduce(DataFrame.unionByName, found)
        still = cut_lineage(by_group(more, *state))
    raise RuntimeError("quantiles of groups did not come to an end")


def _around() -> list[Column]:
    """A value surely at or below the one at the rank, and one surely at or above it."""
    error = 2.0 / ACCURACY
    first = F.floor((F.col("left") / F.col("n") - error) * STEPS)
    last = F.ceil(((F.col("left") + 1) / F.col("n") + error) * STEPS)
    at = lambda i: F.element_at("points", (F.greatest(F.least(i, F.lit(STEPS)), F.lit(0)) + 1).cast("int"))
    return [
        F.when(first < 0, F.col("least")).otherwise(at(first)).alias("from"),
        F.when(last > STEPS, F.col("most")).otherwise(at(last)).alias("to"),
    ]


def _counts(layout: _Layout) -> DataFrame:
    """Values of each column, one row for each group."""
    return cut_lineage(layout.rows.groupBy("_group").agg(*[F.count(f"_{i}").alias(f"n{i}") for i in range(len(layout.names))]))


def _named(names: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in names]), F.col("f")).alias("feature")


def grouped_quantiles(
    df: DataFrame, columns: Iterable[str], by: str, probabilities: Sequence[float], small: int = SMALL, hot: int = HOT
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``_group``, ``feature``, ``n`` and the array ``quantiles``. Groups and columns
    without values have no row; null is a group."""
    parts = []
    for layout in _layouts(df, columns, by, hot):
        counts = _counts(layout)
        both = [_small(layout, counts, probabilities, small).drop("values"), _large(layout, counts, probabilities, small)]
        parts += [p.select("_group", _named(layout.names), "n", "quantiles") for p in both if p is not None]
    return reduce(DataFrame.unionByName, parts)


def grouped_box_stats(df: DataFrame, columns: Iterable[str], by: str, small: int = SMALL, hot: int = HOT) -> DataFrame:
    """As :func:`attrition.operators.stats.box_stats`, for any number of groups: per group and column the quartiles, whisker
    ends and number of points beyond."""
    steps = (0.25, 0.5, 0.75)
    q = [F.get("quantiles", F.lit(i)) for i in range(3)]
    reach = F.lit(WHISKER) * (q[2] - q[0])
    bounds = [q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), (q[0] - reach).alias("low"), (q[2] + reach).alias("high")]
    parts = []
    for layout in _layouts(df, columns, by, hot):
        counts = _counts(layout)
        whole = _small(layout, counts, steps, small).select("_group", "f", "values", *bounds)
        inside = F.filter("values", lambda v: v.between(F.col("low"), F.col("high")))
        whole = whole.withColumn("inside", inside)
        beyond = (F.size("values") - F.size("inside")).cast("bigint")
        both = [whole.withColumns({"first": F.array_min("inside"), "last": F.array_max("inside"), "n_outliers": beyond})]
        large = _large(layout, counts, steps, small)
        if large is not None:
            boxes = large.select("_group", F.struct("f", *bounds).alias("b")).groupBy("_group").agg(F.collect_list("b").alias("b"))
            met = layout.meet(boxes).withColumn("o", F.explode("b")).select("_group", "o", layout.value(F.col("o.f")).alias("v"))
            met = met.filter(F.col("v").isNotNull())
            inside = F.when(F.col("v").between(F.col("o.low"), F.col("o.high")), F.col("v"))
            ends = met.groupBy("_group", "o").agg(
                F.min(inside).alias("first"), F.max(inside).alias("last"), F.count_if(inside.isNull()).alias("n_outliers")
            )
            both.append(ends.select("_group", "o.*", "first", "last", "n_outliers"))
        parts += [
            p.select(
                F.col("_group").alias(by), _named(layout.names), "q1", "median", "q3",
                F.least("q1", "first").alias("whisker_low"), F.greatest("q3", "last").alias("whisker_high"), "n_outliers",
            )
            for p in both
        ]
    return reduce(DataFrame.unionByName, parts)
