from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from attrition.operators import neighbors as K
from attrition.operators import udf as U


def points(spark, data):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)


def brute(data, k, exclude_self):
    d = np.sqrt(((data[:, None] - data[None]) ** 2).sum(axis=2))
    if exclude_self:
        np.fill_diagonal(d, np.inf)
    ids = np.arange(len(data))
    return {i: np.lexsort((ids, d[i]))[:k].tolist() for i in ids}


def clusters(n=400, dims=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=10, size=(8, dims))
    return centres[rng.integers(0, 8, n)] + rng.normal(size=(n, dims))


def found(df):
    pdf = df.toPandas().sort_values(["src", "rank"])
    return pdf.groupby("src")["dst"].apply(list).to_dict()


@pytest.mark.parametrize("block_rows, chunk_rows", [(10_000, 10_000), (50, 40)])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_exact_neighbours(spark, block_rows, chunk_rows, exclude_self):
    data = clusters()
    df = points(spark, data)
    got = K.knn(df, df, 5, exclude_self=exclude_self, block_rows=block_rows, chunk_rows=chunk_rows)
    assert found(got) == brute(data, 5, exclude_self)


@pytest.mark.parametrize("block_rows", [10_000, 30])
def test_a_third_of_the_rows_are_copies(spark, block_rows):
    data = clusters(240)
    data[::3] = data[0]
    df = points(spark, data)
    got = K.knn(df, df, 4, exclude_self=True, block_rows=block_rows, chunk_rows=50)
    assert found(got) == brute(data, 4, True)


@pytest.mark.parametrize("exclude_self", [True, False])
def test_cells_below_cells(spark, monkeypatch, exclude_self):
    """A few upper pivots, so that most cells are cut again, and a clump that no pivot cuts."""
    monkeypatch.setattr(K, "LOWER_ROWS", 30)
    data = clusters(500)
    data[:90] = data[0] + 1e-7 * np.arange(90)[:, None]
    df, work = points(spark, data), []
    got = K.knn(df, df, 5, exclude_self=exclude_self, block_rows=25, chunk_rows=40, pivots=3, work=work, carry=["label"])
    assert found(got) == brute(data, 5, exclude_self)
    assert len(work) == 2 and sum(work) < 0.6 * 500 * 500


def test_separate_query_and_short_corpus(spark):
    data = clusters(60)
    df = points(spark, data)
    corpus = df.filter("vec_id < 3")
    got = K.knn(df, corpus, 5, carry=["label"]).toPandas()
    assert len(got) == 60 * 3 and (got["label"] == got["dst"] % 3).all()
    holes = df.withColumn("embedding", F.when(F.col("vec_id") > 9, F.col("embedding")))
    assert K.knn(holes, holes, 2).select("src").distinct().count() == 50


def test_blocks_out_of_reach_are_not_searched():
    data = clusters()
    pivots = data[:6]
    apart = K._distances(data, pivots)
    cell = apart.argmin(axis=1)
    own = apart.min(axis=1)
    stats = pd.DataFrame({"cell": cell, "d": own}).groupby("cell")["d"].agg(["size", "min", "max"])
    stats = stats.reset_index().set_axis(["cell", "n", "near", "far"], axis=1)
    bound = K._Cells(pivots, stats).lower_bound(apart)
    true = K._distances(data, data)
    for j in range(6):
        assert (bound[:, j] <= true[:, cell == j].min(axis=1) + 1e-9).all()
    assert (bound > 5).mean() > 0.5


def test_votes(spark):
    train = spark.createDataFrame(
        [(1, [0.0], 1), (2, [1.0], 0), (3, [1.1], 0), (4, [0.0], 1)],
        "vec_id bigint, embedding array<double>, label int",
    )
    query = spark.createDataFrame(
        [(10, [0.0]), (11, [1.05]), (12, [0.5])], "vec_id bigint, embedding array<double>"
    )
    got = {r.vec_id: r.prediction for r in K.knn_classify(query, train, 4).collect()}
    assert got == {10: 1, 11: 0, 12: 1}


def test_python_models(spark):
    class Linear:
        def predict(self, matrix):
            return matrix @ np.array([1.0, 2.0])

    class Halve:
        def transform(self, matrix):
            return matrix / 2

    df = spark.createDataFrame([(1, [2.0, 4.0]), (2, [6.0, 8.0])], "id int, a array<double>")
    df = df.withColumn("features", array_to_vector("a")).repartition(4)
    scaled = U.scale_with(df, Halve())
    assert dict(scaled.dtypes)["scaled_features"] == "array<double>"
    scored = U.score_with(scaled, Linear()).orderBy("id").collect()
    assert [r.ChurnPrediction for r in scored] == [5.0, 11.0]
    assert U.score_with(df.filter("id > 5"), Linear(), "features").count() == 0
