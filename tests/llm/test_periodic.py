"""Periodic runs against all periods of all places."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from attrition.llm import periodic
from attrition.llm.common import read

SMALL = "/root/testdata/sf0.001"


def runs_of(words):
    """For each period the maximal stretches; a stretch counts with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_of(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def strange_lists():
    rng = random.Random(3)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    yield from ([], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 300, list(fibonacci[-1]), list("ab" * 6), list("abc" * 4 + "ab"))
    yield list("aab" * 30 + "x" + "aab" * 30), list("aabaab" * 5 + "c") * 6
    yield ["x"] + ["y"] * 5 + ["x"] * 12 + ["y"] * 13
    yield [w for k in range(1, 14) for w in ["a"] * k + ["b"]] * 2
    for size in (2, 3, 30):
        for _ in range(120):
            words = [rng.randrange(size) for _ in range(rng.randint(1, 60))]
            for _ in range(rng.randint(0, 3)):
                i, q = rng.randrange(len(words)), rng.randint(1, 9)
                part = words[i : i + q]
                words[i:i] = (part * rng.randint(1, 9))[: rng.randint(1, 40)]
            yield [f"w{w}" for w in words]



def test_runs_equal_brute_force():
    lists = [w for item in strange_lists() for w in (item if isinstance(item, tuple) else (item,))]
    texts = [" ".join(w) for w in lists]
    for (n, runs, kept), words in zip(periodic.judged(texts), lists):
        assert n == len(words) and runs == runs_of(words), words
        assert kept.split() == kept_of(words, runs)
    # One by one as all together.
    assert [list(periodic.judged([t]))[0] for t in texts] == list(periodic.judged(texts))


def test_suffixes_are_sorted_and_prefixes_counted():
    rng = random.Random(4)
    texts = [[rng.randrange(3) for _ in range(rng.randint(1, 40))] for _ in range(50)]
    words = np.array([w for t in texts for w in t])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    levels = periodic.suffix_ranks(words, owner)
    order = np.argsort(levels[-1][1])
    end = np.searchsorted(owner, owner, side="right")
    suffixes = [words[i : end[i]].tolist() for i in order]
    assert [(owner[i], s) for i, s in zip(order, suffixes)] == sorted((owner[i], s) for i, s in zip(order, suffixes))
    some = order[:-1], order[1:]
    for a, b, got in zip(*some, periodic.common_prefixes(levels, *some, end)):
        x, y = words[a : end[a]].tolist(), words[b : end[b]].tolist()
        if owner[a] == owner[b]:
            assert got == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))


def planted(text, key):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = crc32(str(key).encode()), len(words)
    g = h // 10
    if key is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force(spark):
    docs = read(spark, SMALL, "documents").collect()
    got = {r.doc_id: r for r in periodic.op12_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    n_runs = 0
    for doc in docs:
        words = planted(doc.text, doc.doc_id)
        # The full search is quadratic; longer texts are searched by gram distances below.
        runs = runs_of(words) if len(words) < 1500 else runs_by_distance(words)
        row = got[doc.doc_id]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(kept_of(words, runs))
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        if best is None:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
        else:
            n, s, q = -best[0], best[1], best[2]
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
        n_runs += len(runs)
    assert n_runs > 10


def runs_by_distance(words):
    """The same by array comparison for each period."""
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x, found = np.array([code[w] for w in words]), {}
    for q in range(1, len(x) // 2 + 1):
        same = np.r_[0, x[q:] == x[:-q], 0].astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        for i, j in zip(edge[::2], edge[1::2]):
            if j - i + q >= max(12, 2 * q):
                found.setdefault((int(i), int(j - i + q)), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("words", [["a"] * 40_000, list("ab") * 20_000, [f"w{i}" for i in range(40_000)] * 2])
def test_long_texts_of_one_run(words):
    ((n, runs, kept),) = periodic.judged([" ".join(words)])
    period = len(dict.fromkeys(words))
    assert n == len(words) and runs == [(0, len(words), period)]
    assert kept.split() == words[:period]


def test_rows_keys_and_clashing_names(spark):
    run = "a b c " * 8
    rows = [(None, run, 1), (3, run, 2), (3, run, 2), (4, None, 3), (5, " \t\n", 4), (6, "plain  text", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _JUDGED int")
    out = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.kept) for r in periodic.periodic_runs(df).collect())
    assert out == sorted(
        [("None", 24, [(0, 24, 3)], "a b c"), ("4", 0, [], ""), ("5", 0, [], ""), ("6", 2, [], "plain text")]
        + [("3", 24, [(0, 24, 3)], "a b c")] * 2
    )
    kept = periodic.collapsed(df)
    assert kept.columns == df.columns
    assert sorted(str(r.text) for r in kept.collect()) == sorted(["a b c"] * 3 + ["None", " \t\n", "plain  text"])
    assert periodic.periodic_runs(df.limit(0)).count() == 0
