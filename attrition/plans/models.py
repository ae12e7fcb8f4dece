"""Classifiers as self-contained pipelines: assembler, scaler and model travel together, so what
scales the training rows also scales every later row, whatever its batch."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.columns import drop_intermediate
from attrition.functions.hashing import key_or_row
from attrition.operators.balance import (
    balance_classes,
    class_counts,
    class_weights,
    oversample_to_ratio,
    random_split,
    split_part,
)
from attrition.operators.encode import Standardize
from attrition.operators.evaluate import auc_roc, summary_metrics
from attrition.operators.neighbors import knn_classify
from attrition.operators.polynomial import PolynomialMachine
from attrition.operators.synthetic import smoten_oversample, synthetic_rows
from attrition.schemas import FEATURES, KEY, LABEL, PREDICTION
from attrition.sources.scratch import cut_lineage, pinned

SCALED = "scaled_features"
ROWS_PER_TASK = 50_000


def model_pipeline(
    classifier: Estimator, features: Sequence[str] = FEATURES, with_mean: bool = True,
    with_std: bool = True,
) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            StandardScaler(
                inputCol="features", outputCol=SCALED, withMean=with_mean, withStd=with_std
            ),
            classifier,
        ]
    )


def forest(
    num_trees: int = 100, max_depth: int = 10, min_instances: int = 1, subset: str = "auto",
    seed: int = 42, label: str = LABEL, max_bins: int = 32,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=SCALED, labelCol=label, seed=seed, numTrees=num_trees, maxDepth=max_depth,
        minInstancesPerNode=min_instances, featureSubsetStrategy=subset, maxBins=max_bins,
    )


def train_forest(
    df: DataFrame, features: Sequence[str] = FEATURES, **params
) -> PipelineModel:
    return model_pipeline(forest(**params), features).fit(df)


def few_tasks(df: DataFrame) -> DataFrame:
    """Few tasks for few rows: each step of a linear model is a job over all partitions. Only a
    kept table is counted, for any other that would be a pass of its own."""
    if df.storageLevel == StorageLevel.NONE:
        return df
    return df.coalesce(max(1, math.ceil(df.count() / ROWS_PER_TASK)))


def even_tasks(df: DataFrame, n: int) -> DataFrame:
    """Equal tasks for all cores, of about ``ROWS_PER_TASK`` of ``n`` rows: a forest passes over its rows once for each level,
    and the parts of a balanced table, kept rows and new ones, are of very different size."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_TASK)))


def train_logistic(
    df: DataFrame, weight_col: str | None = "weight", max_iter: int = 100, label: str = LABEL,
    features: Sequence[str] = FEATURES,
) -> PipelineModel:
    """Class-weighted logistic regression. The weights are computed here if ``df`` has none."""
    df = few_tasks(df)
    if weight_col and weight_col not in df.columns:
        df = class_weights(df, label, weight_col)
    classifier = LogisticRegression(featuresCol=SCALED, labelCol=label, maxIter=max_iter)
    if weight_col:
        classifier.setWeightCol(weight_col)
    return model_pipeline(classifier, features).fit(df)


def train_linear_svm(
    df: DataFrame, max_iter: int = 100, reg: float = 0.1, label: str = LABEL,
    features: Sequence[str] = FEATURES,
) -> PipelineModel:
    classifier = LinearSVC(featuresCol=SCALED, labelCol=label, maxIter=max_iter, regParam=reg)
    return model_pipeline(classifier, features).fit(few_tasks(df))


def _on_population_scale(
    df: DataFrame, make: Callable[[int], list], features: Sequence[str], key: str, label: str,
    balance: bool, seed: int, compact: bool = True,
) -> PipelineModel:
    """Scale by the population deviation of the given rows, bring the classes to parity with
    synthetic rows, then fit ``make(number of rows)``. Scaling keeps equal values equal and their
    order, so synthetic rows may be made before it. The rows are dealt to equal tasks, as each step of a fit waits
    for the largest."""
    names = list(features)
    scaler = Standardize(names, [f"{c}_scaled" for c in names], ddof=0).fit(df)
    rows = smoten_oversample(df, names, seed=seed, key=key, label=label) if balance else df
    assembler = VectorAssembler(inputCols=[f"{c}_scaled" for c in names], outputCol=SCALED)
    counts = class_counts(df, label).values() if balance else [df.count()]
    n = len(counts) * max(counts, default=0)
    with pinned(even_tasks(assembler.transform(scaler.transform(rows)).select(SCALED, label), n)) as ready:
        fitted = Pipeline(stages=make(ready.count())).fit(few_tasks(ready) if compact else ready)
    return PipelineModel([scaler, assembler, *fitted.stages])


def train_logistic_l2(
    df: DataFrame, c: float = 1.0, max_iter: int = 100, label: str = LABEL, key: str = KEY,
    features: Sequence[str] = FEATURES, balance: bool = True, seed: int = 42,
) -> PipelineModel:
    """L2 penalty with inverse strength ``c`` on the sum of losses: 1/(c n) on their mean."""
    return _on_population_scale(
        df,
        lambda n: [
            LogisticRegression(
                featuresCol=SCALED, labelCol=label, maxIter=max_iter, regParam=1 / (c * n),
                elasticNetParam=0.0, standardization=False,
            )
        ],
        features, key, label, balance, seed,
    )


def train_forest_default(
    df: DataFrame, label: str = LABEL, key: str = KEY, features: Sequence[str] = FEATURES,
    balance: bool = True, seed: int = 42, max_depth: int = 30,
) -> PipelineModel:
    """100 trees that grow until their leaves are pure or ``max_depth`` is reached; 30 is the most
    that Spark's trees allow. Each row's place in each tree is kept: otherwise every pass sends the deep trees to all tasks
    and sends each row down all of them again."""
    return _on_population_scale(
        df, lambda n: [forest(100, max_depth, seed=seed, label=label).setCacheNodeIds(True)],
        features, key, label, balance, seed, compact=False,
    )


def train_poly_svm(
    df: DataFrame, degree: int = 3, max_iter: int = 100, reg: float = 0.1, label: str = LABEL,
    key: str = KEY, features: Sequence[str] = FEATURES, balance: bool = True, seed: int = 42,
) -> PipelineModel:
    """Polynomial features and a linear machine: the primal form of a polynomial kernel, whose
    cost grows with the rows instead of their square. The features are made where they are needed."""
    return _on_population_scale(
        df, lambda n: [PolynomialMachine(SCALED, label, degree, max_iter, reg)],
        features, key, label, balance, seed, compact=False,
    )


# --- tuning --------------------------------------------------------------------------------

# The searched forests.
FOREST_GRID = {"numTrees": (50, 100), "maxDepth": (5, 10)}
WIDE_FOREST_GRID = {
    "numTrees": (50, 100, 150),
    "maxDepth": (5, 10, 15),
    "minInstancesPerNode": (1, 2, 5),
    "featureSubsetStrategy": ("auto", "sqrt", "log2"),
}


def evaluator(metric: str, label: str = LABEL):
    if metric == "auc":
        return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric)


def tune(
    df: DataFrame,
    classifier: Estimator | None = None,
    grid: Mapping[str, Iterable] = FOREST_GRID,
    metric: str = "auc",
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
    key: str = KEY,
    label: str = LABEL,
    features: Sequence[str] = FEATURES,
) -> CrossValidatorModel:
    """Cross-validated grid search. Folds come from the key's hash, so copies of one customer stay
    in one fold and the folds do not depend on partitioning."""
    classifier = classifier or forest(label=label, seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(classifier.getParam(name), list(values))
    rows = df.select(*features, label, split_part(key_or_row(df, key), [1.0] * folds, seed).alias("fold"))
    with pinned(even_tasks(rows, df.count())) as ready:
        return CrossValidator(
            estimator=model_pipeline(classifier, features),
            estimatorParamMaps=builder.build(),
            evaluator=evaluator(metric, label),
            numFolds=folds,
            foldCol="fold",
            seed=seed,
            parallelism=parallelism,
        ).fit(ready)


def model_summary(tuned: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """One row per searched setting: its parameters, mean metric, and whether it won."""
    metrics = tuned.avgMetrics
    larger = tuned.getEvaluator().isLargerBetter()
    best = (max if larger else min)(metrics)
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda i: i[0].name)),
            float(metric),
            bool(metric == best),
        )
        for setting, metric in zip(tuned.getEstimatorParamMaps(), metrics)
    ]
    return df.sparkSession.createDataFrame(
        rows, "setting string, avg_metric double, is_best boolean"
    )


# --- use -----------------------------------------------------------------------------------


def predict(
    model: PipelineModel, df: DataFrame, output: str = PREDICTION, score: str | None = None
) -> DataFrame:
    """Append the predicted class and, if ``score`` names a column, the number that ranks rows: the
    probability of class 1, or the margin of a machine without probabilities. Intermediate vectors
    are dropped."""
    scored = model.transform(df).withColumn(output, F.col("prediction"))
    if score:
        vector = "probability" if "probability" in scored.columns else "rawPrediction"
        scored = scored.withColumn(score, vector_to_array(vector)[1])
    given = set(df.columns) | {output} | ({score} if score else set())
    return drop_intermediate(scored, [c for c in scored.columns if c not in given])


def knn_holdout(
    df: DataFrame, k: int = 9, weights: Sequence[float] = (0.8, 0.2), seed: int = 0,
    features: Sequence[str] = FEATURES, key: str = KEY, label: str = LABEL, balance: bool = True,
    **limits,
) -> DataFrame:
    """Test rows with the class their k nearest training rows vote for, in population-scaled
    feature space; the training part is brought to parity with synthetic rows first."""
    names = list(features)
    train_rows, test_rows = random_split(df.select(key, *names, label), weights, seed, key)
    scaler = Standardize(names, names, ddof=0).fit(train_rows)

    def points(rows: DataFrame) -> DataFrame:
        vector = F.array(*[F.col(c) for c in names])
        return scaler.transform(rows).select(key, vector.alias("point"), label)

    corpus = points(train_rows)
    if balance:
        counts = class_counts(train_rows, label)
        minority, majority = sorted(counts, key=lambda c: (counts[c], -c))
        new = synthetic_rows(
            train_rows, counts[majority] - counts[minority], minority, names, seed=seed,
            key=key, label=label, **limits,
        )
        # Ids of synthetic rows only order equal distances; negative ones are not customers'.
        number = -1 - F.pmod(F.xxhash64("seed_key", "copy"), F.lit(2**62))
        corpus = corpus.unionByName(
            points(
                new.withColumns({key: number, label: F.lit(minority)}).select(key, *names, label)
            )
        )
    # The search reads its corpus several times; the synthetic rows in it are a search themselves.
    corpus = cut_lineage(corpus)
    votes = knn_classify(points(test_rows), corpus, k, label, key, "point", **limits)
    return test_rows.join(
        votes.select(key, F.col("prediction").cast("double").alias(PREDICTION)), key
    )


class FeatureOrderError(ValueError):
    """A stored model expects other features, or another order of them."""


def model_features(model: PipelineModel) -> list[str]:
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return [c.removesuffix("_scaled") for c in stage.getInputCols()]
    raise FeatureOrderError("the pipeline has no assembler")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, features: Sequence[str] = FEATURES) -> PipelineModel:
    model = PipelineModel.load(path)
    if model_features(model) != list(features):
        raise FeatureOrderError(f"{path} expects {model_features(model)}")
    return model


BALANCERS: dict[str, Callable[..., DataFrame]] = {
    "none": lambda df, **_: df,
    "double_and_halve": balance_classes,
    "oversample": oversample_to_ratio,
    "smoten": smoten_oversample,
}


def train_and_test(
    df: DataFrame,
    train: Callable[[DataFrame], PipelineModel] = train_forest,
    balance: str = "double_and_halve",
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = 42,
    balance_test: bool = False,
    leaky: bool = False,
    score: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training part and score the test part: (model, scored test rows).

    The split comes first. ``leaky=True`` balances and scales all rows first, so that copies of one
    customer may be on both sides and the training part has seen the test part's scale;
    ``balance_test`` balances the test part as well. ``score`` as in :func:`predict`."""
    balancer = BALANCERS[balance]
    if leaky:
        # Written, so that the sampler and the split see plain columns instead of the whole formula.
        df = cut_lineage(Standardize(list(FEATURES), list(FEATURES)).fit(df).transform(df))
        train_rows, test_rows = random_split(balancer(df, seed=seed), weights, seed, method="native")
    else:
        train_rows, test_rows = random_split(df, weights, seed)
        train_rows = balancer(train_rows, seed=seed)
        if balance_test:
            test_rows = balancer(test_rows, seed=seed)
    with pinned(train_rows) as ready:
        model = train(ready)
    return model, predict(model, test_rows, score=score)


def report(scored: DataFrame, score: str = "score", label: str = LABEL) -> DataFrame:
    """One row: the summary metrics of scored rows and the area under the ROC curve."""
    area = auc_roc(scored, score, label).first()[0]
    return summary_metrics(scored, label).withColumn("auc", F.lit(area).cast("double"))


def train_and_report(df: DataFrame, **settings) -> tuple[PipelineModel, DataFrame]:
    model, scored = train_and_test(df, **{"score": "score", **settings})
    return model, report(scored)


def tune_save_report(
    df: DataFrame, path: str, balance: str = "double_and_halve",
    weights: Sequence[float] = (0.8, 0.2), seed: int = 42, **search,
) -> tuple[CrossValidatorModel, DataFrame]:
    """The whole training flow: split, balance the training part, search the grid, save the best
    model at ``path``, and report on the test part."""
    train_rows, test_rows = random_split(df, weights, seed)
    tuned = tune(BALANCERS[balance](train_rows, seed=seed), seed=seed, **search)
    save_model(tuned.bestModel, path)
    return tuned, report(predict(load_model(path), test_rows, score="score"))
