"""Binning, encoding and scaling as fitted stages.

Fitting reads the data; every fitted stage is row-local, so it runs inside code generation, on
any partitioning and on streams.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from fractions import Fraction

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators.order_stats import OrderStatistics
from attrition.sources.scratch import pinned, shared_dir

MAX_LEVELS = 1000


class DuplicateEdges(ValueError):
    """Two quantile edges coincide, so the bins are not well defined."""


def _check_edges(name: str, edges: list[float]) -> list[float]:
    if any(e is None for e in edges):
        raise ValueError(f"{name} has no value to cut")
    if len(set(edges)) != len(edges):
        raise DuplicateEdges(f"bin edges of {name} must be unique: {edges}")
    return edges


def missing(column: Column) -> Column:
    """Null, or a number that is none."""
    return column.isNull() | F.isnan(column.cast("double"))


def _bin_probabilities(bins: int) -> list[Fraction]:
    return [Fraction(k, bins) for k in range(bins + 1)]


def _cut_ranks(n: int, bins: int) -> list[int]:
    """0-based rank of the last row of each bin but the last one."""
    return [(k * (n - 1)) // bins for k in range(1, bins)]


# --- quantile bins -------------------------------------------------------------------------


class _CutParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to cut", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "bin columns", TypeConverters.toListString)


class QuantileCut(Estimator, _CutParams, DefaultParamsReadable, DefaultParamsWritable):
    """Equal-frequency bins 1..q between linearly interpolated quantiles, closed on the right.

    Coinciding edges raise :class:`DuplicateEdges`; a null has no bin.
    """

    bins = Param(Params._dummy(), "bins", "bins of each column", TypeConverters.toListInt)

    def __init__(self, inputCols=None, outputCols=None, bins=None):
        super().__init__()
        self._set(inputCols=inputCols, outputCols=outputCols, bins=bins)

    def _fit(self, df: DataFrame) -> QuantileCutModel:
        names = self.getOrDefault("inputCols")
        bins = dict(zip(names, self.getOrDefault("bins")))
        with pinned(df.select(*names)) as part:
            edges = OrderStatistics(part, names).quantiles(
                {c: _bin_probabilities(q) for c, q in bins.items()}
            )
        return QuantileCutModel(
            names, self.getOrDefault("outputCols"), [_check_edges(c, edges[c]) for c in names]
        )


class QuantileCutModel(Model, _CutParams, DefaultParamsReadable, DefaultParamsWritable):
    """New values outside the fitted range belong to the first or last bin; null and NaN to none."""

    edges = Param(Params._dummy(), "edges", "edges of each column", TypeConverters.toListListFloat)

    def __init__(self, inputCols=None, outputCols=None, edges=None):
        super().__init__()
        self._set(inputCols=inputCols, outputCols=outputCols, edges=edges)

    def bin_of(self, column: Column, edges: list[float]) -> Column:
        chain = F.when(missing(column), F.lit(None).cast("int"))
        for label, edge in enumerate(edges[1:-1], start=1):
            chain = chain.when(column <= F.lit(edge), F.lit(label))
        return chain.otherwise(F.lit(len(edges) - 1))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                out: self.bin_of(F.col(c), edges)
                for c, out, edges in zip(
                    self.getOrDefault("inputCols"),
                    self.getOrDefault("outputCols"),
                    self.getOrDefault("edges"),
                )
            }
        )


# --- bins of the unique rank ---------------------------------------------------------------


class _RankParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "column to rank", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "bin column", TypeConverters.toString)
    orderCol = Param(
        Params._dummy(), "orderCol", "unique integer that orders equal values",
        TypeConverters.toString,
    )


def rank_cuts(
    df: DataFrame, column: str, order_col: str, statistics: OrderStatistics, ranks: list[int]
) -> tuple[list, list[int | None]]:
    """(value, tie) pairs of the rows at 0-based ``ranks`` by ``column``, then ``order_col``.

    The tie is None where the rank is the last one of its value, so that no row behind it shares
    the value; otherwise it is the row's order, of any sign."""
    if not isinstance(df.schema[order_col].dataType, T.IntegralType):
        raise TypeError(f"{order_col} must be an integer column")
    rows = statistics.at({column: ranks})[column]
    inside = {
        i: (rows[r].value, r - rows[r].below)
        for i, r in enumerate(ranks)
        if r - rows[r].below < rows[r].equal - 1
    }
    ties: list[int | None] = [None] * len(ranks)
    if inside:
        wanted: dict[str, list[int]] = {}
        for value, place in inside.values():
            wanted.setdefault(repr(value), []).append(place)
        named = {
            repr(value): F.when(F.col(column) == F.lit(value), F.col(order_col))
            for value, _ in inside.values()
        }
        hits = OrderStatistics(df, named).at(wanted)
        for i, (value, place) in inside.items():
            ties[i] = hits[repr(value)][place].value
    return [rows[r].value for r in ranks], ties


def not_behind(column: Column, order: Column, value: Column, tie: int | None) -> Column:
    """The row is at or before a (value, tie) cut."""
    if tie is None:
        return column <= value
    return (column < value) | ((column == value) & (order <= F.lit(tie)))


def _rank_bin_cuts(
    df: DataFrame, column: str, order_col: str, statistics: OrderStatistics, bins: int
) -> tuple[list, list[int | None]]:
    n = statistics.counts[column]
    if n < 2:
        raise ValueError("rank bins need at least two rows")
    return rank_cuts(df, column, order_col, statistics, _cut_ranks(n, bins))


class RankCut(Estimator, _RankParams, DefaultParamsReadable, DefaultParamsWritable):
    """Equal-frequency bins of the unique rank, where equal values rank in ``orderCol`` order.

    Only the rows that end a bin are looked up (:class:`OrderStatistics`); no row is numbered, so
    there is neither a global sort nor a one-partition window.
    """

    bins = Param(Params._dummy(), "bins", "number of bins", TypeConverters.toInt)

    def __init__(self, inputCol=None, outputCol=None, orderCol=None, bins=None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, orderCol=orderCol, bins=bins)

    def _fit(self, df: DataFrame) -> RankCutModel:
        column, order = self.getOrDefault("inputCol"), self.getOrDefault("orderCol")
        with pinned(df.select(column, order)) as part:
            values, ties = _rank_bin_cuts(
                part, column, order, OrderStatistics(part, [column]), self.getOrDefault("bins")
            )
        return rank_cut_model(column, self.getOrDefault("outputCol"), order, values, ties)


def rank_cut_model(
    column: str, output: str, order: str, values: list, ties: list[int | None]
) -> RankCutModel:
    texts = [repr(v) if isinstance(v, float) else str(v) for v in values]
    return RankCutModel(column, output, order, texts, ["" if t is None else str(t) for t in ties])


class RankCutModel(Model, _RankParams, DefaultParamsReadable, DefaultParamsWritable):
    # As text: a float would not hold every 64-bit integer or decimal.
    values = Param(Params._dummy(), "values", "value ending a bin", TypeConverters.toListString)
    ties = Param(
        Params._dummy(), "ties", "order ending a bin, empty: none", TypeConverters.toListString
    )

    def __init__(self, inputCol=None, outputCol=None, orderCol=None, values=None, ties=None):
        super().__init__()
        self._set(
            inputCol=inputCol, outputCol=outputCol, orderCol=orderCol, values=values, ties=ties
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.getOrDefault("inputCol"))
        order = F.col(self.getOrDefault("orderCol"))
        values, ties = self.getOrDefault("values"), self.getOrDefault("ties")
        kind = df.schema[self.getOrDefault("inputCol")].dataType
        chain = F.when(missing(c), F.lit(None).cast("int"))
        for label, (value, tie) in enumerate(zip(values, ties), start=1):
            cut = F.lit(value).cast(kind)
            chain = chain.when(not_behind(c, order, cut, int(tie) if tie else None), F.lit(label))
        return df.withColumn(
            self.getOrDefault("outputCol"), chain.otherwise(F.lit(len(values) + 1))
        )


# --- categories ----------------------------------------------------------------------------


def levels_of(
    df: DataFrame, columns: Iterable[str], max_levels: int = MAX_LEVELS
) -> dict[str, list]:
    """Sorted distinct non-null values of each category column, in one job.

    A column with more than ``max_levels`` values is not a category and raises."""
    names = list(columns)
    pairs = (
        df.select(
            F.explode(
                F.array(
                    *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in names]
                )
            ).alias("e")
        )
        .select("e.*")
        .filter(F.col("v").isNotNull())
        .distinct()
        .limit(max_levels * len(names) + 1)
        .collect()
    )
    found = {c: sorted(r["v"] for r in pairs if r["c"] == c) for c in names}
    if len(pairs) > max_levels * len(names) or any(len(v) > max_levels for v in found.values()):
        raise ValueError(f"more than {max_levels} levels in {names}")
    return found


class _OneHotParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "category columns", TypeConverters.toListString)


class OneHot(Estimator, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """One boolean column per level, named after the level; a null sets none of them.

    ``dropFirst`` names the columns whose alphabetically first level gets no column. Two columns may
    not share a level, nor may a level be named like another column of the input, unless ``prefix`` puts
    the column's name and an underscore before the level. More than ``maxLevels`` levels in a
    column raise: each would become a column."""

    dropFirst = Param(
        Params._dummy(), "dropFirst", "columns without first level", TypeConverters.toListString
    )

    prefix = Param(Params._dummy(), "prefix", "name columns by both", TypeConverters.toBoolean)
    maxLevels = Param(Params._dummy(), "maxLevels", "most levels", TypeConverters.toInt)

    def __init__(self, inputCols=None, dropFirst=None, prefix=False, maxLevels=MAX_LEVELS):
        super().__init__()
        self._set(
            inputCols=inputCols, dropFirst=dropFirst or [], prefix=prefix, maxLevels=maxLevels
        )

    def _fit(self, df: DataFrame) -> OneHotModel:
        names = self.getOrDefault("inputCols")
        levels = levels_of(df, names, self.getOrDefault("maxLevels"))
        first = set(self.getOrDefault("dropFirst"))
        pairs = [(c, v) for c in names for v in levels[c][c in first:]]
        outputs = [f"{c}_{v}" if self.getOrDefault("prefix") else v for c, v in pairs]
        # Names of columns do not differ by the case of their letters.
        taken = [o.lower() for o in outputs] + [c.lower() for c in df.columns]
        clashing = sorted({o for o in outputs if taken.count(o.lower()) > 1})
        if clashing:
            raise ValueError(f"more than one column would be named {clashing}; set prefix")
        return OneHotModel([c for c, _ in pairs], [v for _, v in pairs], outputs)


class OneHotModel(Model, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(
        Params._dummy(), "levels", "level of each output column", TypeConverters.toListString
    )

    outputCols = Param(
        Params._dummy(), "outputCols", "name of each output column", TypeConverters.toListString
    )

    def __init__(self, inputCols=None, levels=None, outputCols=None):
        super().__init__()
        self._set(inputCols=inputCols, levels=levels, outputCols=outputCols or levels)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                output: F.coalesce(F.col(c).cast("string") == F.lit(level), F.lit(False))
                for c, level, output in zip(
                    self.getOrDefault("inputCols"),
                    self.getOrDefault("levels"),
                    self.getOrDefault("outputCols"),
                )
            }
        )


def one_hot(
    df: DataFrame, columns: Iterable[str], drop_first: Iterable[str] = (), prefix: bool = False,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    return OneHot(list(columns), list(drop_first), prefix, max_levels).fit(df).transform(df)


def _level_codes(df: DataFrame, column: str) -> DataFrame:
    """Each level with its alphabetical position, for any number of levels.

    The levels are range-partitioned and written once; a level's position is its number inside its
    range plus the levels of the ranges before."""
    levels = (
        df.select(F.col(column).cast("string").alias("_level"))
        .filter(F.col("_level").isNotNull())
        .distinct()
    )
    path = shared_dir(df.sparkSession, "levels")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels.repartitionByRange(n, "_level").withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.schema("_level string, _part int").parquet(path)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = ranged.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_level"))
    return ranged.withColumn("_inside", inside).join(before, "_part").select(
        "_level", (F.col("_before") + F.col("_inside") - 1).cast("int").alias("_code")
    )


def label_encode(
    df: DataFrame, columns: Iterable[str], suffix: str = "_code", listed: int = MAX_LEVELS
) -> DataFrame:
    """Alphabetical position 0..k-1 of each category; null stays null. Up to ``listed`` levels are
    looked up in the row; more are ranked as a table and joined, with the same result."""
    for c in columns:
        found = df.select(F.col(c).cast("string").alias("v")).filter("v IS NOT NULL").distinct()
        few = sorted(r.v for r in found.limit(listed + 1).collect())
        if len(few) <= listed:
            code = F.nullif(F.array_position(F.lit(few), F.col(c).cast("string")), F.lit(0)) - 1
            df = df.withColumn(c + suffix, (code if few else F.lit(None)).cast("int"))
        else:
            codes = _level_codes(df, c).withColumnRenamed("_code", c + suffix)
            same = F.col(c).cast("string") == F.col("_level")
            df = df.drop(c + suffix).join(codes, same, "left").drop("_level")
    return df


# --- scaling -------------------------------------------------------------------------------


class _ScaleParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "scaled columns", TypeConverters.toListString)


class Standardize(Estimator, _ScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Column-wise (x - mean) / std; ``ddof`` 1 is the sample, 0 the population deviation.

    A constant column becomes 0. All columns are measured in one aggregation."""

    ddof = Param(Params._dummy(), "ddof", "0 or 1", TypeConverters.toInt)
    withMean = Param(Params._dummy(), "withMean", "subtract the mean", TypeConverters.toBoolean)
    withStd = Param(Params._dummy(), "withStd", "divide by std", TypeConverters.toBoolean)

    def __init__(self, inputCols=None, outputCols=None, ddof=1, withMean=True, withStd=True):
        super().__init__()
        self._set(
            inputCols=inputCols, outputCols=outputCols or inputCols, ddof=ddof,
            withMean=withMean, withStd=withStd,
        )

    def _fit(self, df: DataFrame) -> StandardizeModel:
        names = self.getOrDefault("inputCols")
        deviation = F.stddev_samp if self.getOrDefault("ddof") == 1 else F.stddev_pop
        row = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)],
            *[deviation(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(names)],
        ).first()
        centred, scaled = self.getOrDefault("withMean"), self.getOrDefault("withStd")
        mean = [float(row[f"m{i}"] or 0.0) if centred else 0.0 for i in range(len(names))]
        std = [float(row[f"s{i}"] or 0.0) if scaled else 1.0 for i in range(len(names))]
        return StandardizeModel(names, self.getOrDefault("outputCols"), mean, std)


class StandardizeModel(Model, _ScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "subtracted", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "divisors", TypeConverters.toListFloat)

    def __init__(self, inputCols=None, outputCols=None, means=None, deviations=None):
        super().__init__()
        self._set(inputCols=inputCols, outputCols=outputCols, means=means, deviations=deviations)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = zip(
            self.getOrDefault("inputCols"), self.getOrDefault("outputCols"),
            self.getOrDefault("means"), self.getOrDefault("deviations"),
        )
        return df.withColumns(
            {
                out: F.col(c) * F.lit(0.0)
                if std == 0 or math.isnan(std)
                else (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
                for c, out, mean, std in columns
            }
        )


def standardize(
    df: DataFrame, columns: Iterable[str], ddof: int = 1, with_mean: bool = True,
    with_std: bool = True,
) -> DataFrame:
    names = list(columns)
    return Standardize(names, names, ddof, with_mean, with_std).fit(df).transform(df)


def assemble(df: DataFrame, columns: Iterable[str], output: str = "features") -> DataFrame:
    """Numeric and boolean columns to one vector; a null raises, so fill nulls first."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def cut_all(
    df: DataFrame, quantile_bins: Mapping[str, tuple[str, int]], rank_column: str,
    rank_output: str, rank_bins: int, order_col: str,
) -> tuple[QuantileCutModel, RankCutModel]:
    """Fit quantile bins of several columns and rank bins of another in shared passes."""
    names = list(quantile_bins)
    statistics = OrderStatistics(df, [*names, rank_column])
    wanted = {c: _bin_probabilities(bins) for c, (_, bins) in quantile_bins.items()}
    # Everything is asked for at once, so that no column costs passes of its own.
    statistics.at(
        {
            **{c: statistics.quantile_ranks(c, p) for c, p in wanted.items()},
            rank_column: _cut_ranks(statistics.counts[rank_column], rank_bins),
        }
        if statistics.counts[rank_column] > 1
        else {}
    )
    edges = statistics.quantiles(wanted)
    values, ties = _rank_bin_cuts(df, rank_column, order_col, statistics, rank_bins)
    return (
        QuantileCutModel(
            names, [out for out, _ in quantile_bins.values()],
            [_check_edges(c, edges[c]) for c in names],
        ),
        rank_cut_model(rank_column, rank_output, order_col, values, ties),
    )
