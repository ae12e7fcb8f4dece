from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attrition.operators import neighbors as K
from test_neighbors_and_udf import points


def shares(n, rng, features=6):
    """Rows that lie around few centres, as vectors of three shares for each feature."""
    table = rng.dirichlet(np.ones(3), (features, 40))
    centre = rng.integers(0, 40, (30, features))[rng.integers(0, 30, n)]
    values = np.where(rng.random((n, features)) < 0.9, centre, rng.integers(0, 40, (n, features)))
    return np.concatenate([table[f][values[:, f]] for f in range(features)], axis=1)


@pytest.mark.parametrize("kind, groups, digits, offset", [("f4", 1, None, 0), ("f8", 1, 6, 1e5), ("f8", 3, 9, 0), ("f8", 3, None, -40)])
def test_slab_against_brute_force(monkeypatch, kind, groups, digits, offset):
    rng = np.random.default_rng(9)
    data = (shares(900, rng) if groups > 1 else rng.normal(size=(900, 12))) + offset
    data[::7] = data[0]
    data = data.astype(kind)
    monkeypatch.setattr(K, "HELD_PAIRS", 500)
    ids = 2**60 + rng.permutation(900)
    vectors = pa.array(list(data), pa.list_(pa.float32() if kind == "f4" else pa.float64()))
    slab = K._Slab(pa.table({"id": ids, "vec": vectors, "_row": np.arange(900)}), 40)
    assert np.diff(slab.borders).max() <= 40 and sorted(slab.rows) == list(range(900))
    q = data[:200]
    full = K._norms(q[:, None].astype(float) - data[None].astype(float), groups)
    if digits is not None:
        full = np.round(full, digits)
    np.fill_diagonal(full, np.inf)
    order = np.lexsort((np.broadcast_to(ids, full.shape), full), axis=1)[:, :5]
    # Some reach to the fourth neighbour only, others to all, one to none.
    reach = np.where(np.arange(200) % 3 == 0, np.take_along_axis(full, order, 1)[:, 3], np.inf)
    reach[4] = -1.0
    r, c, dist, n_met = slab.nearest(q, pa.array(ids[:200]), reach, 5, True, digits, groups)
    for i in range(200):
        got = [(d, x) for d, x in zip(dist[r == i], ids[slab.rows[c[r == i]]])]
        want = [(full[i, j], ids[j]) for j in order[i]]
        if i == 4:
            assert all(x in want for x in got)
            continue
        want = [w for w in want if w[0] <= reach[i]]
        assert got[: len(want)] == want
    assert 0 < n_met <= 200 * 900


def test_rows_without_structure_are_not_sent_to_all_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(1500, 10))
    rounds, slab_round = [], K._slab_round
    monkeypatch.setattr(K, "_slab_round", lambda *a: rounds.append(1) or slab_round(*a), raising=False)
    monkeypatch.setattr(K, "SLAB_BYTES", 400 * 80, raising=False)
    df = points(spark, data).withColumn("vec_id", F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 5, "0")))
    got = K.knn(df, df, 4, exclude_self=True, carry=["label"], block_rows=50, chunk_rows=50).collect()
    full = np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1))
    np.fill_diagonal(full, np.inf)
    want = np.argsort(full, axis=1, kind="stable")[:, :4]
    found = {(r.src, r["rank"]): r for r in got}
    assert len(got) == len(found) == 6000 and len(rounds) >= 4
    for i in range(1500):
        for place in range(4):
            row, j = found[f"v{i:05d}", place + 1], want[i, place]
            assert row.dst == f"v{j:05d}" and row.label == j % 3 and abs(row.dist - full[i, j]) < 1e-12


def test_grouped_neighbours_are_found_from_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(K, "TILE_ROWS", 32, raising=False)
    data = shares(3000, np.random.default_rng(8))
    df, work = points(spark, data), []
    got = K.knn(df, df, 3, exclude_self=True, digits=9, block_rows=400, chunk_rows=400, work=work, groups=3).collect()
    assert len(got) == 9000 and work[1] < 0.25 * 3000 * 3000
    full = np.round(K._norms(data[:300, None] - data[None], 3), 9)
    full[np.arange(300), np.arange(300)] = np.inf
    want = np.argsort(full, axis=1, kind="stable")[:, :3]
    for r in got:
        if r.src < 300:
            assert r.dst == want[r.src, r["rank"] - 1]
