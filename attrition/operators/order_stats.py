"""Exact order statistics of columns of any size.

The built-in exact percentile merges every distinct value of a column into one task. Here a
column with few distinct values is answered from its value counts; any other column is narrowed
first: quantiles of a sample cut it into buckets, one aggregation over all rows counts the buckets,
and only the buckets that hold a wanted rank are looked at again. The sample only steers where the
cuts fall; the counts, and so the results, are exact. Full data is never sorted or shuffled,
each pass aggregates map-side to a table whose size does not depend on the number of rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_LIMIT = 50_000
BUCKETS = 1024
# Sampled rows per bucket.
SAMPLE_ROWS = 200


@dataclass(frozen=True)
class Ranked:
    """Value at a rank, with the number of rows below it and equal to it."""

    value: float | int
    below: int
    equal: int


@dataclass(frozen=True)
class _Interval:
    name: str
    low: float | int | None
    high: float | int | None
    offset: int
    size: int
    distinct: int
    ranks: tuple[int, ...]


class OrderStatistics:
    """Order statistics of several columns or expressions of one table.

    ``columns`` maps a name to an expression; nulls and NaN are left out. All names share their
    passes over the table.
    """

    def __init__(
        self,
        df: DataFrame,
        columns: Mapping[str, Column] | Iterable[str],
        distinct_limit: int = DISTINCT_LIMIT,
        buckets: int = BUCKETS,
    ):
        if not isinstance(columns, Mapping):
            columns = {c: F.col(c) for c in columns}
        self._names = list(columns)
        self._alias = {name: f"c{i}" for i, name in enumerate(self._names)}
        selected = df.select(*[columns[n].alias(self._alias[n]) for n in self._names])
        self._integral = {
            n: isinstance(selected.schema[self._alias[n]].dataType, T.IntegralType)
            for n in self._names
        }
        self._df = selected.select(
            *[
                F.col(a).cast("bigint").alias(a)
                if self._integral[n]
                else F.nanvl(F.col(a).cast("double"), F.lit(None).cast("double")).alias(a)
                for n, a in self._alias.items()
            ]
        )
        self._limit = distinct_limit
        self._buckets = buckets
        self._tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self._known: dict[str, dict[int, Ranked]] = {n: {} for n in self._names}
        profile = self._df.agg(
            *[F.count(a).alias(f"n_{a}") for a in self._alias.values()],
            *[F.approx_count_distinct(a).alias(f"d_{a}") for a in self._alias.values()],
        ).first()
        self.counts = {n: profile[f"n_{a}"] for n, a in self._alias.items()}
        self._distinct = {n: profile[f"d_{a}"] for n, a in self._alias.items()}

    def at(self, ranks: Mapping[str, Iterable[int]]) -> dict[str, dict[int, Ranked]]:
        """Rows at 0-based ranks of each named column in ascending order. Ranks asked for together
        share their passes; known ones are not looked up again."""
        found = self._known
        pending = []
        for name, wanted in ranks.items():
            wanted = tuple(sorted(set(wanted) - found[name].keys()))
            if wanted and (wanted[0] < 0 or wanted[-1] >= self.counts[name]):
                raise ValueError(f"rank outside 0..{self.counts[name] - 1} of {name}")
            if wanted:
                pending.append(self._whole(name, wanted))
        while pending:
            small = [i for i in pending if i.distinct <= self._limit]
            large = [i for i in pending if i.distinct > self._limit]
            if small:
                self._resolve(small, found)
            pending = self._narrow(large, found) if large else []
        return {name: {r: found[name][r] for r in wanted} for name, wanted in ranks.items()}

    def _positions(self, name: str, probabilities: Iterable[float]) -> list[tuple[int, float]]:
        """Rank below each quantile and the part of the way to the next rank."""
        places = []
        for p in probabilities:
            # Exact arithmetic on the number as it is written: a product of floats may fall just
            # beside a whole rank. Thirds and the like come as fractions.
            share = p if isinstance(p, Fraction) else Fraction(repr(float(p)))
            position = share * max(self.counts[name] - 1, 0)
            low = math.floor(position)
            places.append((low, float(position - low)))
        return places

    def quantile_ranks(self, name: str, probabilities: Iterable[float]) -> list[int]:
        """Ranks that :meth:`quantiles` needs."""
        if not self.counts[name]:
            return []
        return [
            r
            for low, part in self._positions(name, probabilities)
            for r in ((low, low + 1) if part else (low,))
        ]

    def quantiles(self, probabilities: Mapping[str, Iterable[float]]) -> dict[str, list[float]]:
        """Linearly interpolated quantiles (``None`` for a column without values)."""
        probabilities = {name: list(wanted) for name, wanted in probabilities.items()}
        rows = self.at({n: self.quantile_ranks(n, wanted) for n, wanted in probabilities.items()})
        result: dict[str, list[float]] = {}
        for name, wanted in probabilities.items():
            if not self.counts[name]:
                result[name] = [None] * len(wanted)
                continue
            values = []
            for low, part in self._positions(name, wanted):
                a = rows[name][low].value
                b = rows[name][low + 1].value if part else a
                values.append(float(a) if a == b else a + (b - a) * part)
            result[name] = values
        return result

    def _whole(self, name: str, ranks: tuple[int, ...] = ()) -> _Interval:
        return _Interval(name, None, None, 0, self.counts[name], self._distinct[name], ranks)

    def _cuts(self, intervals: list[_Interval]) -> list[list[float]]:
        """Approximate quantiles of each interval's values.

        Each interval is sampled by its own size, so one small interval does not make the digests
        of the large ones take all rows: what tasks send to the final merge stays bounded by the
        samples, however many tasks there are."""
        grid = F.lit([i / self._buckets for i in range(1, self._buckets)])

        def quantiles(of: list[_Interval], sampled: bool) -> list:
            values = []
            for i, interval in enumerate(of):
                share = SAMPLE_ROWS * self._buckets / interval.size
                value = self._member(interval)
                if sampled and share < 1:
                    value = F.when(F.rand(i) < share, value)
                values.append(value.alias(f"v{i}"))
            size = F.lit(10 * self._buckets)
            wanted = [F.percentile_approx(f"v{i}", grid, size) for i in range(len(of))]
            return list(self._df.select(*values).agg(*wanted).first())

        cuts = quantiles(intervals, True)
        empty = [i for i, c in enumerate(cuts) if not c]
        if empty:
            for i, c in zip(empty, quantiles([intervals[i] for i in empty], False)):
                cuts[i] = c
        return [list(c) for c in cuts]

    def _member(self, interval: _Interval) -> Column:
        """The column's value inside the interval, null elsewhere."""
        c = F.col(self._alias[interval.name])
        if interval.low is None:
            return c
        return F.when((c >= F.lit(interval.low)) & (c <= F.lit(interval.high)), c)

    def _long(self, intervals: list[_Interval], bucket: Callable[[int], Column]) -> DataFrame:
        """(key, bucket, l, d) rows: the members of all intervals below each other."""
        entries = []
        for key, interval in enumerate(intervals):
            value = self._member(interval)
            whole = self._integral[interval.name]
            entries.append(
                F.when(
                    value.isNotNull(),
                    F.struct(
                        F.lit(key).alias("key"),
                        bucket(key).alias("bucket"),
                        (value if whole else F.lit(None)).cast("bigint").alias("l"),
                        (F.lit(None) if whole else value).cast("double").alias("d"),
                    ),
                )
            )
        members = [self._member(i).isNotNull() for i in intervals]
        return (
            self._bucketed.filter(reduce(operator.or_, members))
            .select(F.explode(F.array(*entries)).alias("e"))
            .filter(F.col("e").isNotNull())
            .select("e.*")
        )

    def _value_counts(self, intervals: list[_Interval]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sorted values and their row counts inside each interval of few distinct values."""
        self._bucketed = self._df
        counts = (
            self._long(intervals, lambda key: F.lit(0))
            .groupBy("key", "l", "d")
            .agg(F.count(F.lit(1)).alias("n"))
            .toPandas()
        )
        tables = []
        for key, interval in enumerate(intervals):
            whole = self._integral[interval.name]
            part = counts[counts["key"] == key]
            values = part["l" if whole else "d"].to_numpy(np.int64 if whole else np.float64)
            order = np.argsort(values, kind="stable")
            tables.append((values[order], part["n"].to_numpy(np.int64)[order]))
        return tables

    def _resolve(self, intervals: list[_Interval], found: dict) -> None:
        """Answer intervals with few distinct values from their value counts. The counts of all
        such columns are read together and kept, so that later questions need no pass."""
        wanted = [i for i in intervals if i.low is not None]
        if any(i.low is None and i.name not in self._tables for i in intervals):
            wanted += [
                self._whole(n)
                for n, d in self._distinct.items()
                if d <= self._limit and n not in self._tables
            ]
        tables = {}
        for interval, table in zip(wanted, self._value_counts(wanted) if wanted else []):
            if interval.low is None:
                self._tables[interval.name] = table
            else:
                tables[interval] = table
        for interval in intervals:
            values, n = tables[interval] if interval in tables else self._tables[interval.name]
            upto = np.cumsum(n)
            for rank in interval.ranks:
                i = int(np.searchsorted(upto, rank - interval.offset, side="right"))
                found[interval.name][rank] = Ranked(
                    values[i].item(), interval.offset + int(upto[i] - n[i]), int(n[i])
                )

    def _narrow(self, intervals: list[_Interval], found: dict) -> list[_Interval]:
        """Replace each interval by the buckets of it that hold a wanted rank."""
        splits = []
        for cuts in self._cuts(intervals):
            # Each cut value gets a bucket of its own, so a frequent value is settled at once
            # and every round makes progress.
            points = {float(s) for s in cuts}
            points |= {float(np.nextafter(s, np.inf)) for s in points}
            splits.append([-math.inf, *sorted(points), math.inf])
        keys = range(len(intervals))
        self._bucketed = Bucketizer(
            inputCols=[f"v{k}" for k in keys],
            outputCols=[f"b{k}" for k in keys],
            splitsArray=splits,
            handleInvalid="keep",
        ).transform(
            self._df.withColumns(
                {f"v{k}": self._member(intervals[k]).cast("double") for k in keys}
            )
        )
        rows = (
            self._long(intervals, lambda key: F.col(f"b{key}").cast("int"))
            .groupBy("key", "bucket")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("l").alias("min_l"),
                F.max("l").alias("max_l"),
                F.min("d").alias("min_d"),
                F.max("d").alias("max_d"),
                F.approx_count_distinct("l").alias("dl"),
                F.approx_count_distinct("d").alias("dd"),
            )
            .orderBy("key", "bucket")
            .collect()
        )
        pending = []
        for key, interval in enumerate(intervals):
            kind = "l" if self._integral[interval.name] else "d"
            below = interval.offset
            for row in (r for r in rows if r["key"] == key):
                ranks = tuple(r for r in interval.ranks if below <= r < below + row["n"])
                low, high = row[f"min_{kind}"], row[f"max_{kind}"]
                if ranks and low == high:
                    for rank in ranks:
                        found[interval.name][rank] = Ranked(low, below, row["n"])
                elif ranks:
                    pending.append(
                        _Interval(
                            interval.name, low, high, below, row["n"], row[f"d{kind}"], ranks
                        )
                    )
                below += row["n"]
        return pending


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column] | Iterable[str],
    probabilities: Iterable[float],
    **limits,
) -> dict[str, list[float]]:
    """The same quantiles of every column (see :class:`OrderStatistics`)."""
    wanted = list(probabilities)
    statistics = OrderStatistics(df, columns, **limits)
    return statistics.quantiles({name: wanted for name in statistics.counts})
