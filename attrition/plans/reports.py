"""Reports over scored records. Each is a grouped aggregate, so the same function serves a
finished table and a running stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.columns import at_risk, label_map, mapped
from attrition.schemas import PREDICTION

# Display names of the codes.
GENDER_NAMES = {1: "Female", 0: "Male"}
CHURN_NAMES = {0: "Stayed", 1: "Churned"}


def prediction_counts(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    """Rows per predicted class. The known classes are reported even without rows, as 0; any other
    class, and null, has a row where it occurs."""
    seen = df.groupBy(F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return seen if df.isStreaming else with_known_classes(seen)


def with_known_classes(counts: DataFrame) -> DataFrame:
    """Counts per class, and 0 for each known class that has none. A stream cannot do this itself:
    its reader does."""
    known = counts.sparkSession.createDataFrame(
        [(cls, 0) for cls in CHURN_NAMES], "prediction int, n_rows long"
    )
    return counts.unionByName(known).groupBy("prediction").agg(F.sum("n_rows").alias("n_rows"))


def churn_by_gender(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    rates = df.groupBy(F.col("Female").cast("int").alias("Female")).agg(
        F.avg(prediction).alias("churn_rate")
    )
    return label_map(rates, "Female", GENDER_NAMES, output="Gender")


def score_range(df: DataFrame, column: str = "CreditScore") -> tuple[float, float]:
    """Smallest and largest number; (0, 0) without any."""
    number = F.when(~F.isnan(F.col(column).cast("double")), F.col(column))
    row = df.agg(F.min(number), F.max(number)).first()
    return float(row[0] or 0), float(row[1] or 0)


def credit_histogram(
    df: DataFrame,
    bins: int = 30,
    low: float | None = None,
    high: float | None = None,
    column: str = "CreditScore",
    prediction: str = PREDICTION,
) -> DataFrame:
    """Rows per bin of equal width and predicted class. The last bin includes ``high``. Values below
    the range are counted in bin -1, which has no start, values above it in bin ``bins``, which has
    no end; null and NaN are in no bin. Without a given range it is measured first (not possible
    on a stream)."""
    if low is None or high is None:
        low, high = score_range(df, column)
    return with_bin_edges(
        df.groupBy(
            histogram_bin(F.col(column), bins, low, high).alias("bin"),
            mapped(F.col(prediction).cast("int"), CHURN_NAMES).alias("churn_label"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("bin").isNotNull()),
        bins, low, high,
    )


def histogram_bin(value: Column, bins: int, low: float, high: float) -> Column:
    """Number of the bin, null for null and NaN; see :func:`credit_histogram`."""
    width = (high - low) / bins or 1.0
    inside = F.floor((value - F.lit(low)) / F.lit(width)).cast("int")
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), F.when(value < low, F.lit(-1))
        .when(value > high, F.lit(bins))
        .otherwise(F.least(inside, F.lit(bins - 1))))


def with_bin_edges(df: DataFrame, bins: int, low: float, high: float) -> DataFrame:
    width = (high - low) / bins or 1.0
    return df.withColumns(
        {
            "bin_start": F.when(F.col("bin") >= 0, F.lit(low) + F.col("bin") * F.lit(width)),
            "bin_end": F.when(F.col("bin") < bins, F.lit(low) + (F.col("bin") + 1) * F.lit(width)),
        }
    )


def churn_by_age(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    """Mean prediction per age. The live form leaves the order to the reader."""
    rates = df.groupBy("Age").agg(F.avg(prediction).alias("churn_rate"))
    return rates if df.isStreaming else rates.orderBy("Age")


def products_by_prediction(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    return df.groupBy("NumOfProducts", F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def at_risk_customers(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    return at_risk(df, prediction)
