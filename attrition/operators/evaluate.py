"""Classification metrics from grouped counts.

One grouped pass over the predictions gives the confusion table (classes x classes rows);
every metric below is computed from that table and stays a DataFrame.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.schemas import LABEL, PREDICTION
from attrition.sources.scratch import cut_lineage


def confusion_counts(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """A row for every pair of classes that occur as label or prediction, zero cells included."""
    cells = confusion_counts(df, label, prediction)
    grid = (
        cells.agg(
            F.array_distinct(
                F.flatten(F.array(F.collect_set("label"), F.collect_set("prediction")))
            ).alias("classes"),
            F.collect_list(F.struct("label", "prediction", "n")).alias("cells"),
        )
        .select("cells", "classes", F.explode("classes").alias("label"))
        .select("cells", "label", F.explode("classes").alias("prediction"))
    )
    match = F.filter(
        "cells",
        lambda c: (c["label"] == F.col("label")) & (c["prediction"] == F.col("prediction")),
    )
    return grid.select(
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        F.coalesce(F.get(match, 0)["n"], F.lit(0)).cast("bigint").alias("n_rows"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """A class without rows scores 0, as is usual for these metrics."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _class_totals(cells: DataFrame, *keys: str) -> DataFrame:
    """Per class (and key): rows labelled so, rows predicted so, and rows that are both."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    as_label = F.struct(
        F.col("label").alias("cls"), F.col("n").alias("support"),
        zero.alias("predicted"), hit.alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("cls"), zero.alias("support"),
        F.col("n").alias("predicted"), zero.alias("hits"),
    )
    return (
        cells.select(*keys, F.explode(F.array(as_label, as_prediction)).alias("e"))
        .select(*keys, "e.*")
        .groupBy(*keys, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .select(
            *keys,
            F.col("cls").cast("int").alias("label"),
            "support",
            "hits",
            _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            _ratio(F.col("hits"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        )
    )


def by_label(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Support, precision, recall and f1 of each class that occurs as label or prediction."""
    return _class_totals(confusion_counts(df, label, prediction))


def precision_recall_by_label(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    return by_label(df, label, prediction).select("label", "precision", "recall")


def _weighted(metric: str) -> Column:
    return F.sum(F.col(metric) * F.col("support")) / F.sum("support")


def summary_metrics(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: accuracy, support-weighted and unweighted precision, recall and f1."""
    return by_label(df, label, prediction).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("weighted_precision"),
        _weighted("recall").alias("weighted_recall"),
        _weighted("f1").alias("f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    return summary_metrics(df, label, prediction).select("accuracy")


def classification_report(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION, digits: int = 4
) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("entry") if isinstance(name, str) else name.alias("entry"),
            F.round(precision, digits).alias("precision"),
            F.round(recall, digits).alias("recall"),
            F.round(f1, digits).alias("f1"),
            support.cast("bigint").alias("support"),
        )

    columns = ("precision", "recall", "f1")
    nothing = F.lit(None).cast("double")
    # The per-class table has one row per class, so gathering it in one row is bounded.
    gathered = by_label(df, label, prediction).agg(
        F.collect_list(
            row(F.col("label").cast("string"), *[F.col(c) for c in columns], F.col("support"))
        ).alias("classes"),
        row("accuracy", nothing, nothing, F.sum("hits") / F.sum("support"), F.sum("support")).alias(
            "acc"
        ),
        row("macro avg", *[F.avg(c) for c in columns], F.sum("support")).alias("macro"),
        row("weighted avg", *[_weighted(c) for c in columns], F.sum("support")).alias("weighted"),
    )
    return gathered.select(
        F.explode(F.concat("classes", F.array("acc", "macro", "weighted"))).alias("e")
    ).select("e.*")


def auc_roc(
    df: DataFrame, score: str, label: str = LABEL, rows_per_range: int = 1_000_000
) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in right order,
    ties counting half. Rows whose score is null or NaN are left out.

    Rows shrink to one per distinct score, which are written once. Negatives below a score are
    counted by ranges of about ``rows_per_range`` scores: totals of earlier ranges from a table with a
    row for each range, the rest within the range.
    """
    positive = (F.col(label) == 1).cast("bigint")
    value = F.col(score).cast("double")
    scores = cut_lineage(
        df.filter(value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
        .groupBy(value.alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )
    # Range borders only steer the distribution; the result does not depend on them, so they come
    # from a sample.
    rows = scores.count()
    ranges = max(1, math.ceil(rows / rows_per_range))
    cuts = None
    if ranges > 1:
        sampled = scores.sample(min(1.0, 200 * ranges / rows), seed=1)
        shares = F.lit([i / ranges for i in range(1, ranges)])
        cuts = sampled.agg(F.percentile_approx("score", shares, F.lit(20 * ranges))).first()[0]
    ranged = Bucketizer(
        inputCol="score", outputCol="bucket",
        splits=[-math.inf, *sorted(set(cuts or [0.0])), math.inf],
    ).transform(scores)
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("bucket")
        .agg(F.sum("neg").alias("bucket_neg"))
        .select("bucket", F.coalesce(F.sum("bucket_neg").over(before), F.lit(0)).alias("offset"))
    )
    within = W.partitionBy("bucket").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("inside", F.coalesce(F.sum("neg").over(within), F.lit(0)))
        .join(F.broadcast(offsets), "bucket")
        .agg(
            F.try_divide(
                F.sum(F.col("pos") * (F.col("offset") + F.col("inside") + 0.5 * F.col("neg"))),
                F.sum("pos").cast("double") * F.sum("neg"),
            ).alias("auc")
        )
    )


def run_history(
    df: DataFrame, step: str = "step", label: str = LABEL, prediction: str = PREDICTION,
    rows: Column | None = None,
) -> DataFrame:
    """Accuracy and unweighted precision, recall and f1 of the predictions of each step.

    ``rows`` counts the rows behind each input row if the input is already grouped."""
    cells = df.groupBy(
        F.col(step).alias("step"),
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg((F.count(F.lit(1)) if rows is None else F.sum(rows)).alias("n"))
    return (
        _class_totals(cells, "step")
        .groupBy("step")
        .agg(
            (F.sum("hits") / F.sum("support")).alias("accuracy"),
            *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        )
    )


METRICS = ("accuracy", "precision", "recall", "f1")


def best_metrics(history: DataFrame) -> DataFrame:
    """Largest value of each metric over all steps."""
    return history.agg(*[F.max(m).alias(f"best_{m}") for m in METRICS])


def metric_history(history: DataFrame) -> DataFrame:
    return history.select("step", *METRICS).orderBy("step")
