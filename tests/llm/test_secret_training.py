"""The network of the secret scan learns from all documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from attrition.llm import secret_scan as S


def documents(spark, n: int):
    """``n`` different texts, each with a candidate of its own; every tenth also with an assignment."""
    body = F.concat(F.lit("see identifier_"), F.col("id").cast("string"), F.lit(" in this text"))
    assigned = F.when(F.col("id") % 10 == 0, F.concat(F.lit(" password=Qx"), F.md5(F.col("id").cast("string")))).otherwise("")
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat(body, assigned).alias("text"))


def test_every_candidate_of_every_document_is_learnt(spark):
    n = 25_000  # more rows, and more windows, than the sample of an earlier version had
    found = S.labelled_windows(documents(spark, n)).where("NOT made")
    want = {}
    for r in documents(spark, n).collect():
        spans = S.base_spans(r.text)
        for s, e in S.candidates(r.text):
            for a, b in S.pieces(s, e):
                want[S.window(r.text, a, b)] = S.covered(a, b, spans)
    assert len(want) > n
    assert {bytes(r.window): r.positive for r in found.collect()} == want


def test_all_shards_make_one_network_on_any_partitioning(spark):
    docs = documents(spark, 600)
    one = S.train_on(docs.coalesce(1), shard_windows=4000, epochs=3)
    other = S.train_on(docs.repartition(5, "text"), shard_windows=4000, epochs=3)
    for name in S.SHAPES:
        assert np.array_equal(getattr(one, name), getattr(other, name))
    assert one.threshold == np.float64(other.threshold) or abs(one.threshold - other.threshold) < 1e-9
    assert one.recall >= S.RECALL and one.precision > 0.9


def test_patterns_and_candidates_as_in_plain_search():
    text = "\ud800é API_KEY: 'abc0+/=_-.x' ſecret=abcdefgh " + "deadbeef" * 4 + "Z" + "0" * 23 + " AKIA" + "Q" * 17 + "é\x00" + "a" * 90
    plain = [(m.start(), 0, m.end()) for m in S.ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    plain += [(m.start(), 1, m.end()) for m in S.ACCESS.finditer(text) if m.end() - m.start() >= 20]
    plain += [(m.start(), 2, m.end()) for m in S.HEX.finditer(text)]
    assert S.base_spans(text) == sorted(plain)
    assert S.candidates(text) == [m.span() for m in S.CANDIDATE.finditer(text)]


def test_gradient_of_the_network():
    rng = np.random.default_rng(1)
    values, x, y = S._start(rng)[0], rng.integers(0, 98, (32, S.WIDTH)).astype(np.uint8), np.arange(32) % 2.0

    def loss(values):
        net = S._network(values)
        raw = net.raw(x)
        return (np.log1p(np.exp(raw)) - y * raw).mean() + 0.5e-4 * (net.weights**2).sum()

    gradient = S._gradient(values, x, y, np.ones(32))
    for i in (int(x[0, 30]) * S.EMBEDDED + 3, 1300, 1763, 1790, 1808):
        step = np.zeros_like(values)
        step[i] = 1e-3
        assert abs((loss(values + step) - loss(values - step)) / 2e-3 - gradient[i]) < 1e-3
