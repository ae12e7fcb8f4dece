"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from attrition.llm import treap


def terms_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def ranked(docs, items, top=20):
    """Item, rank, document and score, each document scored whole."""
    held = [(key, Counter(terms_of(text))) for key, text in docs]
    held = [(key, c) for key, c in held if c]
    n, every = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // every
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms_of(text) if c[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, r, None if null else key, -s) for r, (s, null, key) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def searched(index, items, **options):
    rows = treap.search(index, items, **options).collect()
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in rows)


@pytest.mark.parametrize("width", [1, 256])
def test_treap_equals_a_full_scan(monkeypatch, width):
    monkeypatch.setattr(treap, "WIDTH", width)
    rng = np.random.default_rng(1)
    for n_rows, n_columns, share in ((1, 1, 1.0), (3, 40, 0.5), (200, 30, 0.02), (60, 500, 0.1), (64, 64, 1.0)):
        table = np.where(rng.random((n_rows, n_columns)) < share, rng.integers(1, 30, (n_rows, n_columns)), 0)
        table[0, 0] = 7
        rows, columns = np.nonzero(table)
        grid = treap.Treap.of(rows, columns, table[rows, columns])
        assert len(grid.greatest) < 2 * len(rows) + 4 * grid.bits + 4 and grid.greatest[0] == table.max()
        for _ in range(20):
            own = rng.permutation(n_rows)[: rng.integers(1, n_rows + 1)]
            weights = rng.integers(0, 4, len(own))
            sums = weights @ table[own]
            best = np.lexsort((np.arange(n_columns), -sums))[:9]
            best = best[sums[best] > 0]
            found, score = grid.search(own.astype(np.int64), weights.astype(np.int64), 9)
            assert found.tolist() == best.tolist() and score.tolist() == sums[best].tolist()


def test_nothing_is_visited_that_cannot_be_found(monkeypatch):
    rng = np.random.default_rng(2)
    n = 20_000
    rows = np.concatenate([np.zeros(n, np.int64), np.arange(1, 31)])
    columns = np.concatenate([np.arange(n), rng.integers(0, n, 30)])
    grid = treap.Treap.of(rows, columns, np.concatenate([rng.integers(1, 900, n), np.full(30, 1000)]))
    seen = []
    halves = treap.Treap._halves
    monkeypatch.setattr(treap.Treap, "_halves", lambda self, c, *a: seen.append(len(c)) or halves(self, c, *a))
    monkeypatch.setattr(treap, "WIDTH", 1)
    found, _ = grid.search(np.array([0]), np.array([1]), 5)
    assert len(found) == 5 and sum(seen) < n / 10


def corpus():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)] + ["Él", "日本", "x9", "THE", "the"]
    docs = [(None, "w1 w2"), (None, "w1 w2"), (1, None), (2, ""), (3, " .,-\n"), (4, "the the THE"), (5, "w1"), (5, "w1"), (5, "w2 w1")]
    docs += [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))) for i in range(400)]
    docs += [(1000 + i, "copy of one text w7") for i in range(60)] + [(5000, "long w3 " * 3000)]
    items = [(i, " ".join(rng.choice(vocabulary + ["copy", "text"]) for _ in range(rng.randint(1, 30)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "unknown"), (33, "the"), (34, "copy"), (35, "w7 w7 copy"), (36, "Long, W3!"), (None, "w1")]
    return docs, items


@pytest.mark.parametrize("postings", [1, 700, 10**9])
def test_search_equals_brute_force(spark, postings):
    docs, items = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    index = treap.build_index(df, shard_postings=postings)
    assert searched(index, wanted) == ranked(docs, items)
    assert searched(index, wanted, top=3) == ranked(docs, items, 3)


def test_items_in_blocks_and_repeated(spark, monkeypatch):
    monkeypatch.setattr(treap, "BLOCK", 50)
    docs, items = corpus()
    index = treap.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    twice = items + items[:3]
    assert searched(index, spark.createDataFrame(twice, "item_id long, text string")) == ranked(docs, twice)


def test_nothing_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, _KEY int, score int")
    item = spark.createDataFrame([(1, "A", 2)], "item_id long, text string, rank int")
    assert treap.search(treap.build_index(none), item).count() == 0
    assert treap.search(treap.build_index(some), item.limit(0)).count() == 0
    (row,) = treap.search(treap.build_index(some), item).collect()
    assert (row.item_id, row["rank"], row.doc_id) == (1, 1, 1) and row.score > 0
