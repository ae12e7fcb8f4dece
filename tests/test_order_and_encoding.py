from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from attrition.operators import encode as E
from attrition.operators.order_stats import OrderStatistics, exact_quantiles
from attrition.operators.stats import box_stats, iqr_summary

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, values, parts=3):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id bigint, x double").repartition(parts)


@pytest.mark.parametrize("limit, buckets", [(50_000, 256), (40, 8), (5, 4)])
def test_quantiles_match_numpy(spark, limit, buckets):
    rng = np.random.default_rng(3)
    hot = np.where(rng.random(900) < 0.4, 7.0, rng.normal(size=900).round(2))
    whole = rng.integers(-(2**60), 2**60, size=900)
    df = spark.createDataFrame(
        pd.DataFrame({"a": rng.lognormal(size=900), "b": hot, "c": whole})
    ).repartition(3)
    p = [0, 0.1, 0.25, 0.3, 0.5, 0.75, 0.9, 1]
    got = exact_quantiles(df, ["a", "b"], p, distinct_limit=limit, buckets=buckets)
    pdf = df.toPandas()
    for c in ("a", "b"):
        np.testing.assert_allclose(got[c], np.quantile(pdf[c], p), rtol=1e-13)
    ranks = [0, 1, 450, 899]
    found = OrderStatistics(df, ["c"], limit, buckets).at({"c": ranks})["c"]
    ordered = np.sort(pdf["c"].to_numpy())
    assert [found[r].value for r in ranks] == [ordered[r] for r in ranks]


def test_rank_counts_of_a_hot_value(spark):
    df = frame(spark, [5.0] * 300 + list(map(float, range(300))))
    for limit in (1000, 10):
        hit = OrderStatistics(df, ["x"], limit, 8).at({"x": [100]})["x"][100]
        assert (hit.value, hit.below, hit.equal) == (5.0, 5, 301)


def test_nulls_and_nan_are_left_out(spark):
    df = frame(spark, [None, float("nan"), 1.0, 3.0])
    statistics = OrderStatistics(df, ["x"])
    assert statistics.counts == {"x": 2}
    assert statistics.quantiles({"x": [0.5]}) == {"x": [2.0]}
    empty = OrderStatistics(df.filter("false"), ["x"])
    assert empty.quantiles({"x": [0.5]}) == {"x": [None]}


@FEW
@given(st.lists(st.integers(0, 10_000), min_size=30, max_size=120, unique=True), st.sampled_from([4, 8, 10]))
def test_quantile_cut_is_qcut(spark, values, q):
    df = frame(spark, [float(v) for v in values])
    fitted = E.QuantileCut(["x"], ["bin"], [q]).fit(df)
    got = fitted.transform(df).orderBy("id").toPandas()["bin"].tolist()
    expected = pd.qcut(pd.Series(values), q, labels=range(1, q + 1)).astype(int).tolist()
    assert got == expected


@FEW
@given(st.lists(st.integers(0, 6), min_size=12, max_size=100), st.sampled_from([4, 10]))
def test_rank_cut_is_qcut_of_first_rank(spark, values, q):
    expected = pd.qcut(
        pd.Series(values).rank(method="first"), q, labels=range(1, q + 1)
    ).astype(int).tolist()
    for parts in (1, 5):
        df = frame(spark, [float(v) for v in values], parts=parts)
        fitted = E.RankCut("x", "bin", "id", q).fit(df)
        assert fitted.transform(df).orderBy("id").toPandas()["bin"].tolist() == expected


def test_quantile_cut_edges(spark):
    tied = frame(spark, [0.0] * 8 + [1.0, 2.0])
    with pytest.raises(E.DuplicateEdges):
        E.QuantileCut(["x"], ["bin"], [4]).fit(tied)
    fitted = E.QuantileCut(["x"], ["bin"], [2]).fit(frame(spark, [1.0, 2.0, 3.0, 4.0]))
    probe = frame(spark, [None, -9.0, 2.5, 2.6, 99.0])
    assert [r.bin for r in fitted.transform(probe).orderBy("id").collect()] == [None, 1, 1, 2, 2]


def test_rank_cut_needs_two_rows_and_whole_ties(spark):
    with pytest.raises(ValueError):
        E.RankCut("x", "bin", "id", 2).fit(frame(spark, [1.0]))
    with pytest.raises(TypeError):
        E.RankCut("id", "bin", "x", 2).fit(frame(spark, [1.0, 2.0]))


def test_stages_can_be_saved(spark, tmp_path):
    df = frame(spark, [float(i % 17) for i in range(60)]).withColumn(
        "g", F.when(F.col("id") % 2 == 0, "b").otherwise("a")
    )
    stages = [
        E.RankCut("x", "r", "id", 5), E.OneHot(["g"], ["g"]), E.Standardize(["x"], ["z"], ddof=0)
    ]
    model = Pipeline(stages=stages).fit(df)
    path = str(tmp_path / "p")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert (
        model.transform(df).orderBy("id").collect() == again.transform(df).orderBy("id").collect()
    )


def test_one_hot_is_get_dummies(spark):
    df = spark.createDataFrame(
        [(1, "x", "f"), (2, "y", "m"), (3, None, "m"), (4, "z", None)], "id int, a string, b string"
    )
    got = E.one_hot(df, ["a", "b"], ["a"]).orderBy("id").toPandas()
    pdf = df.toPandas().sort_values("id")
    expected = pd.concat(
        [pd.get_dummies(pdf["a"], drop_first=True), pd.get_dummies(pdf["b"])], axis=1
    )
    assert got[["y", "z", "f", "m"]].values.tolist() == expected.values.tolist()


def test_too_many_levels_raise(spark):
    with pytest.raises(ValueError):
        E.levels_of(frame(spark, [float(i) for i in range(30)]), ["x"], max_levels=10)


def test_standardize(spark):
    values = [1.0, 2.0, 3.0, 6.0]
    for ddof in (0, 1):
        got = [r.x for r in E.standardize(frame(spark, values), ["x"], ddof).orderBy("id").collect()]
        np.testing.assert_allclose(got, (np.array(values) - 3) / np.std(values, ddof=ddof))
    constant = E.standardize(frame(spark, [4.0, 4.0]), ["x"]).collect()
    assert {r.x for r in constant} == {0.0}
    scaled = E.standardize(frame(spark, values), ["x"], with_mean=False).orderBy("id").collect()
    np.testing.assert_allclose([r.x for r in scaled], np.array(values) / np.std(values, ddof=1))


def test_iqr_without_outliers(spark):
    r = iqr_summary(frame(spark, [float(i) for i in range(1, 11)]), ["x"]).first()
    assert r.n_outliers == 0 and r.expected_outlier is None
    assert (r.q1, r.q3) == (3.25, 7.75)


def test_iqr_sides(spark):
    middle = list(range(1, 21))
    high = iqr_summary(frame(spark, [*middle, 90, 99]), ["x"], distinct_limit=3, buckets=4).first()
    assert (high.n_outliers, high.expected_outlier) == (2, 90.0)
    low = iqr_summary(frame(spark, [*middle, -90, -99]), ["x"]).first()
    assert (low.n_outliers, low.expected_outlier) == (2, -90.0)
    # The mean of these outliers lies within the bounds, so none is expected.
    assert iqr_summary(frame(spark, [*middle, 70, -50]), ["x"]).first().expected_outlier is None


def test_box_per_class(spark):
    df = frame(spark, [1, 2, 3, 4, 100, 10, 20, 30]).withColumn(
        "Exited", (F.col("id") >= 5).cast("int")
    )
    rows = {r.Exited: r for r in box_stats(df, ["x"]).collect()}
    assert (rows[0].median, rows[0].whisker_high, rows[0].n_outliers) == (3.0, 4.0, 1)
    assert (rows[1].whisker_low, rows[1].whisker_high, rows[1].n_outliers) == (10.0, 30.0, 0)
