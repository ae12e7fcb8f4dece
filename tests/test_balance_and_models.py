from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from attrition.operators import balance as B
from attrition.operators import evaluate as V
from attrition.operators.synthetic import smoten_oversample, synthetic_rows
from attrition.plans import models as M
from attrition.schemas import FEATURES, LABEL


def ids(df):
    return sorted(r.CustomerId for r in df.select("CustomerId").collect())


def test_hash_decisions_do_not_depend_on_partitions(features):
    one, many = features.coalesce(1), features.repartition(7)
    for change in (
        lambda df: B.random_split(df)[0],
        lambda df: B.undersample(df, 0, 0.5),
        lambda df: B.oversample(df, 1, 2.0),
        lambda df: B.oversample_to_ratio(df),
        lambda df: B.undersample_to_ratio(df),
    ):
        assert ids(change(one)) == ids(change(many))


def test_split_is_a_partition_of_the_rows(features):
    parts = B.random_split(features, (0.5, 0.3, 0.2), seed=7)
    assert sorted(i for p in parts for i in ids(p)) == ids(features)
    assert abs(parts[0].count() / features.count() - 0.5) < 0.08
    native = B.random_split(features, (0.5, 0.5), method="native")
    assert sum(p.count() for p in native) == features.count()


def test_poisson_copies_have_the_right_mean_and_spread(spark):
    df = spark.range(20_000).withColumn("Exited", F.lit(1))
    for rate in (0.7, 3.0, 90.0):
        n = (
            B.oversample(df, 1, rate, key="id").groupBy("id").count().toPandas()["count"].to_numpy()
        )
        counts = np.concatenate([n, np.zeros(20_000 - len(n))])
        assert abs(counts.mean() - rate) < 0.05 * rate
        assert abs(counts.var() - rate) < 0.08 * rate


def test_ratio_balancing_and_weights(features):
    counts = B.class_counts(features)
    over = B.class_counts(B.oversample_to_ratio(features))
    assert over[0] == counts[0] and abs(over[1] / over[0] - 1) < 0.2
    under = B.class_counts(B.undersample_to_ratio(features))
    assert under[1] == counts[1] and abs(under[0] / under[1] - 1) < 0.3
    total = B.class_weights(features).groupBy(LABEL).agg(F.sum("weight").alias("w")).collect()
    np.testing.assert_allclose([r.w for r in total], features.count() / 2)


def test_one_class_cannot_be_balanced(features):
    one = features.filter("Exited = 0")
    for change in (B.oversample_to_ratio, B.undersample_to_ratio, smoten_oversample):
        with pytest.raises(ValueError):
            change(one)
    with pytest.raises(ValueError):
        B.class_counts(features, "CustomerId", max_classes=10)


def test_smoten_reaches_parity_with_known_values(features):
    balanced = smoten_oversample(features).cache()
    counts = B.class_counts(balanced)
    assert counts[0] == counts[1] == B.class_counts(features)[0]
    new = balanced.filter("CustomerId < 0").toPandas()
    assert new["CustomerId"].is_unique
    minority = features.filter("Exited = 1").toPandas()
    assert len(new) == counts[1] - len(minority)
    for c in FEATURES:
        assert set(new[c]) <= set(minority[c]), c


def test_smoten_against_brute_force(spark):
    rng = np.random.default_rng(5)
    n, names = 120, ["a", "b", "c"]
    data = rng.integers(0, 4, size=(n, 3)).astype(float)
    label = (rng.random(n) < 0.3).astype(int)
    rows = [(i, *map(float, data[i]), int(label[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "CustomerId bigint, a double, b double, c double, Exited int")
    own = np.flatnonzero(label == 1)
    codes = np.array(
        [[label[data[:, f] == data[i, f]].mean() for f in range(3)] for i in own]
    )
    expected = {}
    for i, x in enumerate(codes):
        d = np.round(np.sqrt(((codes - x) ** 2).sum(axis=1)), 9)
        d[i] = np.inf
        near = own[np.lexsort((own, d))[:5]]
        new = []
        for f in range(3):
            values, times = np.unique(data[near, f], return_counts=True)
            new.append(values[times.argmax()])
        expected[int(own[i])] = tuple(new)
    for limits in ({}, {"block_rows": 8, "chunk_rows": 4}):
        made = synthetic_rows(df, len(own) * 2, 1, names, **limits).collect()
        assert len(made) == 2 * len(own)
        assert {r.seed_key: (r.a, r.b, r.c) for r in made} == expected


# --- metrics -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(features):
    return features.select(
        F.col("Exited"), (F.col("Age") >= 45).cast("double").alias("ChurnPrediction"),
        (F.col("Age") + F.col("NumOfProducts")).cast("double").alias("score"),
    ).cache()


def test_metrics_match_spark_ml(scored):
    got = V.summary_metrics(scored).first()
    for metric, name in (
        ("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
        ("weightedRecall", "weighted_recall"), ("f1", "f1"),
    ):
        expected = MulticlassClassificationEvaluator(
            labelCol="Exited", predictionCol="ChurnPrediction", metricName=metric
        ).evaluate(scored)
        assert abs(got[name] - expected) < 1e-9
    for r in V.precision_recall_by_label(scored).collect():
        for metric, name in (("precisionByLabel", "precision"), ("recallByLabel", "recall")):
            expected = MulticlassClassificationEvaluator(
                labelCol="Exited", predictionCol="ChurnPrediction", metricName=metric,
                metricLabel=float(r.label),
            ).evaluate(scored)
            assert abs(r[name] - expected) < 1e-9


def test_auc_matches_spark_ml(scored):
    expected = BinaryClassificationEvaluator(
        labelCol="Exited", rawPredictionCol="score", numBins=0
    ).evaluate(scored)
    for rows in (1, 40, 1_000_000):
        assert abs(V.auc_roc(scored, "score", rows_per_range=rows).first().auc - expected) < 1e-9
    assert V.auc_roc(scored.filter("Exited = 1"), "score").first().auc is None


def test_classes_that_only_one_side_knows(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 2.0), (1, 0.0)], "Exited int, ChurnPrediction double")
    cells = {(r.label, r.prediction): r.n_rows for r in V.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[(0, 2)] == 1 and cells[(2, 2)] == 0 and cells[(1, 0)] == 1
    report = {r.entry: r for r in V.classification_report(df).collect()}
    assert set(report) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert report["2"].support == 0 and report["1"].recall == 0.0 and report["0"].precision == 0.5


def test_run_history(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.0), (1, 1, 1.0), (2, 0, 1.0), (2, 1, 1.0)],
        "step int, Exited int, ChurnPrediction double",
    )
    history = V.run_history(df)
    assert [(r.step, r.accuracy) for r in V.metric_history(history).collect()] == [(1, 1.0), (2, 0.5)]
    assert V.best_metrics(history).first().best_accuracy == 1.0


# --- models --------------------------------------------------------------------------------


def test_forest_learns_and_survives_saving(features, tmp_path):
    model, scored = M.train_and_test(features, lambda df: M.train_forest(df, num_trees=20, max_depth=6))
    assert V.accuracy(scored).first().accuracy > 0.85
    assert scored.columns == [*features.columns, "ChurnPrediction"]
    M.save_model(model, str(tmp_path / "forest"))
    loaded = M.load_model(str(tmp_path / "forest"))
    a = M.predict(model, features).orderBy("CustomerId").collect()
    assert a == M.predict(loaded, features).orderBy("CustomerId").collect()
    with pytest.raises(M.FeatureOrderError):
        M.load_model(str(tmp_path / "forest"), FEATURES[::-1])


def test_one_row_scores_like_the_whole(features):
    model = M.train_forest(features, num_trees=10, max_depth=5)
    whole = {r.CustomerId: r.ChurnPrediction for r in M.predict(model, features).collect()}
    for row in features.limit(3).collect():
        alone = M.predict(model, features.filter(F.col("CustomerId") == row.CustomerId)).first()
        assert alone.ChurnPrediction == whole[row.CustomerId]


def test_logistic_weights_lift_the_small_class(features):
    weighted = M.predict(M.train_logistic(features), features)
    plain = M.predict(M.train_logistic(features, weight_col=None), features)
    recall = [
        {r.label: r.recall for r in V.precision_recall_by_label(x).collect()}[1]
        for x in (weighted, plain)
    ]
    assert recall[0] > recall[1]


def test_linear_svm(features):
    model = M.train_linear_svm(B.oversample_to_ratio(features), max_iter=20)
    assert V.summary_metrics(M.predict(model, features)).first().macro_recall > 0.6


def test_population_scale_models(features, tmp_path):
    for model in (
        M.train_logistic_l2(features, balance=False, max_iter=10),
        M.train_poly_svm(features, balance=False, max_iter=5),
        M.train_forest_default(features, balance=True, max_depth=4),
    ):
        M.save_model(model, str(tmp_path / "m"))
        loaded = M.load_model(str(tmp_path / "m"))
        assert M.predict(loaded, features).count() == features.count()
        assert M.predict(loaded, features).columns == [*features.columns, "ChurnPrediction"]


def test_population_scale_models_fit_on_equal_tasks(features, monkeypatch):
    sizes = []

    class Sizes(Estimator):
        def _fit(self, dataset):
            sizes.append([r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect()])
            return SQLTransformer(statement="SELECT * FROM __THIS__")

    monkeypatch.setattr(M, "ROWS_PER_TASK", 300)
    for balance in (False, True):
        for compact in (False, True):
            M._on_population_scale(
                features.coalesce(1), lambda n: [Sizes()], FEATURES, M.KEY, LABEL, balance, 42, compact=compact
            )
    for each in sizes:
        assert len(each) > 1 and max(each) < 3 * sum(each) / len(each)


def test_tuning_reports_every_setting(features):
    tuned = M.tune(features, grid={"numTrees": (3, 5), "maxDepth": (2, 4)}, folds=2)
    summary = M.model_summary(tuned, features).collect()
    assert len(summary) == 4 and sum(r.is_best for r in summary) == 1
    assert summary[0].setting.startswith("maxDepth=2, numTrees=")
    assert M.model_features(tuned.bestModel) == list(FEATURES)


def test_leaky_mode_and_balanced_test_part(features):
    def small(df):
        return M.train_forest(df, num_trees=3, max_depth=3)

    _, leaky = M.train_and_report(features, train=small, leaky=True)
    assert 0.5 < leaky.first().accuracy <= 1
    _, scored = M.train_and_test(features, small, balance="oversample", balance_test=True)
    counts = B.class_counts(scored)
    assert abs(counts[1] / counts[0] - 1) < 0.5
