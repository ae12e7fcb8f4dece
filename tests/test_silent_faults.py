"""Inputs on which rows were once dropped or binned wrongly."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import balance as B
from attrition.operators import encode as E
from attrition.operators.evaluate import auc_roc
from attrition.operators.order_stats import exact_quantiles
from attrition.operators.synthetic import smoten_oversample, synthetic_rows
from attrition.plans import reports as R


def test_rows_without_key_are_spread(spark):
    rows = [(i if i < 300 else None, i, int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "CustomerId long, x int, Exited int")
    nameless = "CustomerId IS NULL"
    parts = [p.where(nameless).count() for p in B.random_split(df, (0.5, 0.5))]
    assert sum(parts) == 300 and min(parts) > 100
    assert B.undersample(df, 0, 1.0).count() == 400
    assert abs(B.undersample(df, 0, 0.99).where(nameless).count() - 198) < 12
    assert B.oversample(df, 1, 2.0).where(nameless).count() > 140


def test_rank_bins_with_negative_keys(spark):
    df = spark.createDataFrame([(-1000 + i, 7.0) for i in range(100)], "k long, v double")
    got = E.RankCut("v", "bin", "k", 4).fit(df).transform(df).groupBy("bin").count().collect()
    assert {r["bin"]: r["count"] for r in got} == {1: 25, 2: 25, 3: 25, 4: 25}


def test_rank_bins_of_large_integers(spark):
    df = spark.createDataFrame([(i, 2**53 + i) for i in range(8)], "k long, v long")
    got = E.RankCut("v", "bin", "k", 4).fit(df).transform(df).groupBy("bin").count().collect()
    assert {r["bin"]: r["count"] for r in got} == {1: 2, 2: 2, 3: 2, 4: 2}


def test_nan_has_no_bin(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(40)] + [(99, math.nan), (98, None)], "k long, v double")
    quantile = E.QuantileCut(["v"], ["bin"], [4]).fit(df)
    rank = E.RankCut("v", "bin", "k", 4).fit(df)
    rank.write().save(str(tmp_path / "rank"))
    for model in (quantile, rank, E.RankCutModel.load(str(tmp_path / "rank"))):
        odd = model.transform(df).where("k > 90").collect()
        assert [r["bin"] for r in odd] == [None, None]


def test_one_hot_clashes(spark):
    df = spark.createDataFrame([("Yes", "No"), ("No", "Yes")], "a string, b string")
    with pytest.raises(ValueError, match="prefix"):
        E.one_hot(df, ["a", "b"])
    assert E.one_hot(df, ["a", "b"], prefix=True).columns == ["a", "b", "a_No", "a_Yes", "b_No", "b_Yes"]
    with pytest.raises(ValueError, match="prefix"):
        E.one_hot(spark.createDataFrame([("A",)], "a string"), ["a"])


def test_label_encode_of_many_levels(spark):
    df = spark.createDataFrame([(f"v{i % 1500:04d}",) for i in range(3000)] + [(None,)], "a string").repartition(5)
    got = E.label_encode(df, ["a"]).distinct().collect()
    assert {r.a: r.a_code for r in got} == {f"v{i:04d}": i for i in range(1500)} | {None: None}


def test_class_weights_of_many_classes(spark):
    df = spark.createDataFrame([(i % 1200,) for i in range(2400)] + [(None,)], "Exited int")
    got = B.class_weights(df).collect()
    assert len(got) == 2401 and {r.weight for r in got if r.Exited is not None} == {1.0}


def test_quantiles_at_odd_shares(spark):
    df = spark.range(1_000_001).select(F.col("id").cast("double").alias("v"))
    shares = [0.9999999, 0.12345678, 0.1]
    got = exact_quantiles(df, ["v"], shares)["v"]
    assert all(abs(a - b) < 1e-6 for a, b in zip(got, [999999.9, 123456.78, 100000.0]))


def test_other_classes_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (1.0,)], "ChurnPrediction double")
    got = {r.prediction: r.n_rows for r in R.prediction_counts(df).collect()}
    assert got == {0: 0, 1: 2, 2: 1, None: 1}


def test_histogram_beyond_its_range(spark):
    df = spark.createDataFrame([(s, 0.0) for s in (1, 300, 400, 850, 999)] + [(None, 0.0)], "CreditScore int, ChurnPrediction double")
    got = {r.bin: (r.n_rows, r.bin_start, r.bin_end) for r in R.credit_histogram(df, 11, 300.0, 850.0).collect()}
    assert got == {-1: (1, None, 300.0), 0: (1, 300.0, 350.0), 2: (1, 400.0, 450.0), 10: (1, 800.0, 850.0), 11: (1, 850.0, None)}
    assert R.credit_histogram(df.limit(0)).count() == 0


def test_area_without_nan_and_over_ranges(spark):
    df = spark.createDataFrame([(float(i % 50), int(i % 7 > 3)) for i in range(500)] + [(math.nan, 1)], "score double, Exited int")
    whole = auc_roc(df, "score").first()[0]
    assert abs(whole - auc_roc(df, "score", rows_per_range=5).first()[0]) < 1e-12


def test_synthetic_rows_with_repeated_large_negative_and_missing_keys(spark):
    """Repeated keys (one of them a third of all rows), keys beyond 10^13, negative ones and null."""
    rng = np.random.default_rng(8)
    keys = [7] * 40 + [None] * 5 + [10**15 + i for i in range(30)] + [-(58_000_173 + i) for i in range(45)]
    rows = [(k, float(rng.integers(0, 3)), float(rng.integers(0, 4)), int(i % 4 == 0)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "CustomerId bigint, a double, b double, Exited int")
    for kind in ("bigint", "string"):
        given = df.withColumn("CustomerId", F.col("CustomerId").cast(kind))
        balanced = smoten_oversample(given, ["a", "b"]).cache()
        assert {r.Exited: r["count"] for r in balanced.groupBy("Exited").count().collect()} == {0: 90, 1: 90}
        new = balanced.join(given.select("CustomerId").distinct(), "CustomerId", "left_anti").filter("CustomerId is not null")
        assert new.count() == new.select("CustomerId").distinct().count() == 60


def test_value_difference_over_three_classes(spark):
    rng = np.random.default_rng(9)
    n, names = 150, ["a", "b", "c"]
    data, label = rng.integers(0, 4, (n, 3)).astype(float), rng.choice(3, n, p=[0.5, 0.3, 0.2])
    rows = [(i, *map(float, data[i]), int(label[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "CustomerId bigint, a double, b double, c double, Exited int")
    share = np.array([[[(label[data[:, f] == data[i, f]] == c).mean() for c in range(3)] for f in range(3)] for i in range(n)])
    for cls, limits in ((1, {}), (2, {"block_rows": 6, "chunk_rows": 5})):
        own = np.flatnonzero(label == cls)
        expected = {}
        for i in own:
            d = np.round(np.sqrt((np.abs(share[own] - share[i]).sum(axis=2) ** 2).sum(axis=1)), 9)
            d[own == i] = np.inf
            near = own[np.lexsort((own, d))[:5]]
            counted = [np.unique(data[near, f], return_counts=True) for f in range(3)]
            expected[int(i)] = tuple(v[t.argmax()] for v, t in counted)
        made = synthetic_rows(df, len(own), cls, names, **limits).collect()
        assert {r.seed_key: (r.a, r.b, r.c) for r in made} == expected
    counts = smoten_oversample(df, names).groupBy("Exited").count().collect()
    assert len({r["count"] for r in counts}) == 1 and len(counts) == 3
