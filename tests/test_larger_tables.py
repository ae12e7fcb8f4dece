from __future__ import annotations

import glob
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from attrition.operators import neighbors as K
from attrition.operators import polynomial as P
from attrition.plans import catalog

SMALL = "/root/testdata/sf0.001"


def test_products_are_those_of_the_expansion(spark):
    x = np.random.default_rng(2).normal(size=(5, 3))
    products = P.Products(3, 3)
    head, z = products.of(x)
    own = (head[:, :, None] * z[:, None, :])[:, products.allowed]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").select(array_to_vector("x").alias("x"))
    expanded = PolynomialExpansion(degree=3, inputCol="x", outputCol="e").transform(df)
    want = np.array([r.e for r in expanded.select(vector_to_array("e").alias("e")).collect()])
    assert np.allclose(np.sort(own, axis=1), np.sort(np.concatenate([np.ones((5, 1)), want], axis=1), axis=1))


def test_machine_reaches_the_objective_of_the_expansion(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    x[:, 0] = np.sign(x[:, 0])
    y = (x[:, 1] * x[:, 2] * x[:, 0] > 0.2).astype(int)
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "x array<double>, label int")
    df = df.select(array_to_vector("x").alias("x"), "label").repartition(3).cache()
    expansion = PolynomialExpansion(degree=3, inputCol="x", outputCol="e")
    want = LinearSVC(featuresCol="e", labelCol="label", maxIter=60, regParam=0.1).fit(expansion.transform(df))
    model = P.PolynomialMachine("x", "label", 3, 60, 0.1).fit(df)
    scored = model.transform(df).select("x", "label", "prediction", vector_to_array("rawPrediction")[1].alias("m")).collect()
    margin, sign = np.array([r.m for r in scored]), np.array([2 * r.label - 1 for r in scored])
    products = P.Products(4, 3)
    head, z = products.of(np.array([r.x.toArray() for r in scored]))
    unit = (head[:, :, None] * z[:, None, :])[:, products.allowed].std(axis=0, ddof=1)
    weights = np.array(model.getOrDefault("weights"))
    own = np.maximum(0, 1 - sign * margin).mean() + 0.05 * ((weights * unit)[1:] ** 2).sum()
    assert own <= want.summary().objectiveHistory[-1] * 1.002
    assert all(r.prediction == (r.m > 0) for r in scored)
    with pytest.raises(ValueError):
        P.PolynomialMachine("x", "label").fit(df.withColumn("label", F.lit(2)))


@pytest.mark.parametrize("shares", [True, False])
def test_grouped_distances_measure_few_pairs(shares, monkeypatch):
    rng = np.random.default_rng(3)
    table = [rng.dirichlet(np.ones(3), 12) if shares else rng.normal(size=(12, 3)) for _ in range(6)]
    c = np.concatenate([t[rng.integers(0, 12, 1500)] for t in table], axis=1)
    c[:40] = c[0]
    q, ids = c[:150], np.arange(1500)
    rows = np.abs(q[:, None] - c[None]).reshape(150, 1500, 6, 3).sum(-1)
    full = np.round(np.sqrt((rows**2).sum(-1)), 9)
    full[np.arange(150), np.arange(150)] = np.inf
    want = [sorted(zip(d, ids))[:5] for d in full]
    taken, norms = [], K._norms
    monkeypatch.setattr(K, "_norms", lambda d, g: taken.append(d.size // 18) or norms(d, g))
    a, b, dist = K._top_k(ids[:150], q, ids, c, 5, True, 9, 3)
    got = [[(d, i) for r, i, d in zip(a, b, dist) if r == n] for n in range(150)]
    assert [[i for _, i in g] for g in got] == [[i for _, i in w] for w in want]
    assert np.allclose([d for g in got for d, _ in g], [d for w in want for d, _ in w], atol=1e-9)
    assert sum(taken) < 0.5 * 150 * 1500


def test_messages_of_a_round_are_written_by_all_tasks(spark, monkeypatch):
    made, records = [], catalog._records
    shared_dir = catalog.shared_dir

    def noted(spark, name):
        made.append(shared_dir(spark, name))
        return made[-1]

    monkeypatch.setattr(catalog, "shared_dir", noted)
    monkeypatch.setattr(catalog, "_records", lambda *a: records(*a).repartition(3))
    got = {tuple(r) for r in catalog.last_message_wins(spark, SMALL).collect()}
    want = {(r.CustomerId, r.Age, float(r.Age >= 50)) for r in records(spark, SMALL).collect()}
    assert got == want
    (path,) = (p for p in made if "/thrice-" in p)
    assert [len(glob.glob(f"{path}/{i}/*.parquet")) for i in range(3)] == [3, 3, 3]


def test_blocks_of_customers_have_a_bound(spark, monkeypatch):
    seen, knn = {}, K.knn

    def noted(*args, **options):
        seen.update(options)
        return knn(*args, **options)

    monkeypatch.setattr(K, "knn", noted)
    monkeypatch.setattr(K, "BLOCK_ROWS", 16)
    monkeypatch.setattr(K, "CHUNK_ROWS", 32)
    catalog.knn_cells(spark, "/root/testdata/sf0.01").count()
    assert seen["block_rows"] <= 16 and seen["chunk_rows"] <= 32


def test_tables_of_distances_stay_small():
    rng = np.random.default_rng(6)
    c, q = rng.normal(size=(8192, 8)), rng.normal(size=(600, 8))
    tracemalloc.start()
    K._top_k(np.arange(600), q, np.arange(8192), c, 5, True, 9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * 2**20
