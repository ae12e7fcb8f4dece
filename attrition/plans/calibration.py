"""Probabilities of classifiers that give margins only.

The rows are dealt to folds by key. Each fold is scored by a model that has not seen it; on these margins
a calibration is fitted: a logistic curve of the margin (Platt), with targets a little within 0 and 1 so that it stays finite,
or a rising step function (isotonic, pool adjacent violators). The final model is fitted on all rows, and the
calibration becomes a further stage of its pipeline: it is saved, loaded and put behind a stream like any other. All
fits are Spark jobs; nothing but models of fixed size, or one number for each step, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.columns import drop_intermediate
from attrition.functions.hashing import key_or_row
from attrition.operators.balance import split_part
from attrition.plans.models import few_tasks
from attrition.schemas import FEATURES, KEY, LABEL, PREDICTION
from attrition.sources.scratch import cut_lineage, pinned

PROBABILITY = "ChurnProbability"
MARGIN, CALIBRATED, CURVE = "margin", "calibrated", "calibrated_vector"


def _sliced() -> VectorSlicer:
    return VectorSlicer(inputCol="rawPrediction", outputCol=MARGIN, indices=[1])


def cross_fitted_margins(
    df: DataFrame, train: Callable[[DataFrame], PipelineModel], folds: int = 5, seed: int = 42, key: str = KEY, label: str = LABEL
) -> DataFrame:
    """Label and margin of every row, from a model that has not seen its fold. Copies of one key share a fold; a fold whose
    other rows have one class only gives no margins."""
    fold = split_part(key_or_row(df, key), [1.0] * folds, seed)
    scored = None
    with pinned(df.withColumn("_fold", fold)) as rows:
        for i in range(folds):
            # Kept for the steps of the fit, each of which is a job.
            with pinned(rows.filter(F.col("_fold") != i).drop("_fold")) as rest:
                if rest.select(label).distinct().limit(2).count() < 2:
                    continue
                part = _sliced().transform(train(rest).transform(rows.filter(F.col("_fold") == i)))
                part = cut_lineage(part.select(F.col(label).cast("int").alias(label), MARGIN))
            scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        raise ValueError("a calibration needs rows of both classes in several folds")
    return scored


@dataclass
class CrossFitted:
    """What calibrations of one classifier on the same rows share: its margins by folds, and the model of all rows."""

    margins: DataFrame
    model: PipelineModel


def cross_fitted(
    df: DataFrame, train: Callable[[DataFrame], PipelineModel], folds: int = 5, seed: int = 42, key: str = KEY, label: str = LABEL
) -> CrossFitted:
    margins = cross_fitted_margins(df, train, folds, seed, key, label)
    with pinned(df) as rows:
        return CrossFitted(margins, train(rows))


def train_calibrated(
    df: DataFrame,
    train: Callable[[DataFrame], PipelineModel],
    method: str = "platt",
    folds: int = 5,
    seed: int = 42,
    key: str = KEY,
    label: str = LABEL,
    fitted: CrossFitted | None = None,
) -> PipelineModel:
    """The model that ``train`` fits on all rows, with a calibration behind it; see :func:`predict_probability`. Several
    methods may share what :func:`cross_fitted` made with the same arguments, so that the fits are made once."""
    fitted = fitted or cross_fitted(df, train, folds, seed, key, label)
    margins = fitted.margins
    if method == "isotonic":
        curve = IsotonicRegression(featuresCol=MARGIN, labelCol=label, predictionCol=CALIBRATED).fit(margins)
    elif method == "platt":
        n1, n = margins.agg(F.sum(label), F.count(F.lit(1))).first()
        high, low = (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2)
        # A soft target is both classes, each with its weight.
        target = F.when(F.col(label) == 1, high).otherwise(low)
        both = F.array(F.struct(F.lit(1).alias("y"), target.alias("w")), F.struct(F.lit(0).alias("y"), (1 - target).alias("w")))
        soft = margins.select(MARGIN, F.explode(both).alias("_t")).select(MARGIN, "_t.y", "_t.w")
        with pinned(soft) as kept:
            curve = LogisticRegression(
                featuresCol=MARGIN, labelCol="y", weightCol="w", predictionCol="calibrated_class",
                probabilityCol=CURVE, rawPredictionCol="calibrated_raw",
            ).fit(few_tasks(kept))
    else:
        raise ValueError(f"unknown method {method}")
    return PipelineModel([*fitted.model.stages, _sliced(), curve])


def predict_probability(
    model: PipelineModel, df: DataFrame, output: str = PREDICTION, probability: str = PROBABILITY
) -> DataFrame:
    """Append the predicted class and the calibrated probability of class 1."""
    scored = model.transform(df).withColumn(output, F.col("prediction"))
    value = vector_to_array(CURVE)[1] if CURVE in scored.columns else F.col(CALIBRATED)
    scored = scored.withColumn(probability, value)
    given = set(df.columns) | {output, probability}
    return drop_intermediate(scored, [c for c in scored.columns if c not in given])


def reliability(scored: DataFrame, bins: int = 10, probability: str = PROBABILITY, label: str = LABEL) -> DataFrame:
    """Per bin of equal width: rows, mean probability, and the share of class 1 among them."""
    position = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(position.alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(probability).alias("mean_probability"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def calibration_error(scored: DataFrame, bins: int = 10, probability: str = PROBABILITY, label: str = LABEL) -> float | None:
    """Mean difference of probability and rate over the bins, weighted by their rows."""
    each = reliability(scored, bins, probability, label)
    difference = F.abs(F.col("mean_probability") - F.col("rate")) * F.col("n_rows")
    return each.agg(F.try_divide(F.sum(difference), F.sum("n_rows"))).first()[0]
