"""Descriptive statistics of the raw table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.operators.balance import class_counts
from attrition.operators.order_stats import OrderStatistics
from attrition.schemas import LABEL
from attrition.sources.scratch import pinned

# Fixed value: points further than this many interquartile ranges out are outliers.
WHISKER = 1.5


def churn_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and percentage (one decimal) of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    # One row per class is left here, so the unpartitioned window is small.
    total = F.sum("n_rows").over(W.partitionBy())
    return counts.withColumn("percentage", F.round(100 * F.col("n_rows") / total, 1))


def _bounds(quartiles: list[float]) -> tuple[float, float, float, float]:
    q1, q3 = quartiles
    reach = WHISKER * (q3 - q1)
    return q1, q3, q1 - reach, q3 + reach


_IQR_SCHEMA = (
    "feature string, q1 double, q3 double, lower_bound double, upper_bound double, "
    "n_outliers bigint, expected_outlier double"
)


def iqr_summary(df: DataFrame, columns: Iterable[str], **limits) -> DataFrame:
    """Quartiles, outlier bounds and outlier count of each column, and the expected outlier: the
    outlier nearest to the box on the side where the mean of all outliers lies, or null.

    The table is aggregated right away; the result has one row per column."""
    names = list(columns)
    with pinned(df.select(*names)) as part:
        quartiles = OrderStatistics(part, names, **limits).quantiles(
            {c: (0.25, 0.75) for c in names}
        )
        names = [c for c in names if quartiles[c][0] is not None]
        bounds = {c: _bounds(quartiles[c]) for c in names}
        measures = []
        for i, c in enumerate(names):
            _, _, low, high = bounds[c]
            outside = (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))
            outlier = F.when(outside, F.col(c).cast("double"))
            measures += [
                F.count(outlier).alias(f"n{i}"),
                F.when(F.avg(outlier) < F.lit(low), F.max(outlier))
                .when(F.avg(outlier) > F.lit(high), F.min(outlier))
                .alias(f"e{i}"),
            ]
        row = part.agg(*measures).first() if measures else {}
    return df.sparkSession.createDataFrame(
        [
            (c, *map(float, bounds[c]), row[f"n{i}"], row[f"e{i}"])
            for i, c in enumerate(names)
        ],
        _IQR_SCHEMA,
    )


def box_stats(
    df: DataFrame, columns: Iterable[str], by: str = LABEL, **limits
) -> DataFrame:
    """Per class and column: quartiles, median, whisker ends (the furthest points within 1.5
    interquartile ranges of the box, at least the box itself) and number of points beyond.

    The table is aggregated right away; the result has one row per class and column."""
    names = list(columns)
    with pinned(df.select(by, *names)) as part:
        classes = list(class_counts(part, by))
        cells = {f"{i}.{c}": (v, c) for i, v in enumerate(classes) for c in names}
        values = {
            name: F.when(F.col(by) == F.lit(v), F.col(c).cast("double"))
            for name, (v, c) in cells.items()
        }
        boxes = OrderStatistics(part, values, **limits).quantiles(
            {name: (0.25, 0.5, 0.75) for name in cells}
        )
        names = [name for name in cells if boxes[name][0] is not None]
        measures = []
        for i, name in enumerate(names):
            value = values[name]
            _, _, low, high = _bounds([boxes[name][0], boxes[name][2]])
            inside = F.when((value >= F.lit(low)) & (value <= F.lit(high)), value)
            measures += [
                F.min(inside).alias(f"l{i}"),
                F.max(inside).alias(f"h{i}"),
                (F.count(value) - F.count(inside)).alias(f"n{i}"),
            ]
        # One ungrouped aggregation: partial results per task, no shuffle by class.
        row = part.agg(*measures).first() if measures else {}
    kind = df.schema[by].dataType.simpleString()
    return df.sparkSession.createDataFrame(
        [
            (
                *cells[name], *map(float, boxes[name]),
                min(boxes[name][0], row[f"l{i}"]), max(boxes[name][2], row[f"h{i}"]), row[f"n{i}"],
            )
            for i, name in enumerate(names)
        ],
        f"`{by}` {kind}, feature string, q1 double, median double, q3 double, "
        "whisker_low double, whisker_high double, n_outliers bigint",
    )
