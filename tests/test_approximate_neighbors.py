from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import approximate as A
from attrition.operators import descent as G
from attrition.operators import neighbors as K
from test_neighbors_and_udf import clusters, points


def test_probe_sets_never_cross_both_borders():
    for depth in (1, 3, 6):
        sets = A.probe_sets(depth, 30)
        assert sets[0] == () and len(sets) == len(set(sets))
        assert all(2 * depth - 1 - r not in s for s in sets for r in s)
    assert len(A.probe_sets(1, 30)) == 3


def test_probes_are_the_buckets_next_door():
    rng = np.random.default_rng(3)
    tables = A.HashTables.drawn(3, 2, 5, 2.0, 9, 1)
    x = rng.normal(size=(200, 5))
    assert (tables.probed(x)[:, :, 0] == tables.buckets(x)).all()
    near = x + rng.normal(scale=0.3, size=x.shape)
    own = (tables.probed(x) == tables.buckets(near)[:, :, None])
    assert own.any(axis=2).mean() > own[:, :, 0].mean() + 0.1


@pytest.mark.parametrize("block_rows, chunk_rows", [(10_000, 10_000), (40, 30)])
def test_most_neighbours_are_found(spark, block_rows, chunk_rows):
    data = clusters(600)
    df = points(spark, data)
    got = A.knn_approximate(df, df, 5, exclude_self=True, carry=["label"], block_rows=block_rows, chunk_rows=chunk_rows).cache()
    (row,) = A.recall(got, K.knn(df, df, 5, exclude_self=True)).collect()
    assert row.n_wanted == 3000 and row.recall >= 0.9
    found = got.toPandas()
    assert len(found) == 3000 and (found["label"] == found["dst"] % 3).all()
    true = np.sqrt(((data[found["src"]] - data[found["dst"]]) ** 2).sum(axis=1))
    assert np.allclose(found["dist"], true) and (found["src"] != found["dst"]).all()
    assert not found.duplicated(["src", "dst"]).any()


def test_bad_tables_still_give_whole_results(spark):
    """Buckets so narrow that nothing meets, a third of the rows equal, rows without a vector."""
    data = clusters(240)
    data[::3] = data[0]
    df = points(spark, data).withColumn("embedding", F.when(F.col("vec_id") != 7, F.col("embedding")))
    tables = A.HashTables.drawn(1, 12, 6, 1e-3, 1, 5)
    got = A.knn_approximate(df, df, 4, exclude_self=True, tables=tables, block_rows=50, chunk_rows=50)
    (row,) = A.recall(got, K.knn(df, df, 4, exclude_self=True)).collect()
    assert (row.n_wanted, row.n_found) == (239 * 4, 239 * 4)
    assert A.knn_approximate(df.limit(0), df, 4).count() == 0
    assert A.knn_approximate(df, df.limit(0), 4).count() == 0


def test_graph_by_descent(spark):
    data = clusters(900, dims=8)
    data[-60:] = data[0]
    df = points(spark, data)
    graph = G.neighbour_graph(df, 6, window=24)
    edges = graph.edges.cache()
    (row,) = A.recall(edges, K.knn_edges(df, 6)).collect()
    assert row.recall >= 0.9 and graph.share < 0.8
    assert edges.groupBy("src").count().filter("count <> 6").count() == 0 and edges.select("src").distinct().count() == 900
    assert edges.filter("src = dst").count() == 0
    small = G.neighbour_graph(df.filter("vec_id < 40"), 6)
    assert small.edges.count() == 240


def test_first_graph_takes_few_rounds(spark):
    rng = np.random.default_rng(5)
    df = points(spark, rng.normal(size=(1500, 6)))
    graph = G.neighbour_graph(df, 9)
    (row,) = A.recall(graph.edges, K.knn_edges(df, 9)).collect()
    # Each round sends the vectors anew.
    assert row.recall >= 0.95 and len(graph.work) - 1 <= 4 and graph.share < 0.5
