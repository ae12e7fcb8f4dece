"""URL filters, license scans, decontamination and mixing against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from attrition.llm import decontaminate, license_scan, mixing, url_filter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def judged(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, verdict in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), h + p, verdict))
    return host, path, best[1] if best else None, best[2] if best else "allow"


URLS = [
    "http://A.Example.NET/en/x?q#f", "https://example.net/en/", "https://notexample.net/en/1", "x",
    None, "", "://", "http://net", "http://net/", "http://a.net?x=/", "ftp://example.com/de/a#b",
    "http://sub.example.com/de", "http://org/fr/", "http://w.org/fr/q", "http://.net/", "http://a..net/",
    "http://example.net./en/", "http://EXAMPLE.net:80/en/", "http://é.net/É", "http://a.net/en/" + "x" * 5000,
]


def test_url_filter_equals_brute_force(spark):
    rules = url_filter.RULES + [
        ("example.net", "/en/x", "block"), ("a.example.net", "", "allow"), ("b.org", "/", "block"),
        ("b.org", "/fr/", "block"), ("b.org", "/fr/deep/er", "allow"), ("b.org", "/", "block"),
    ]
    rng = random.Random(3)
    made = [
        f"http://{rng.choice(['', 'a.', 'w.a.', 'b.'])}{rng.choice(['example.net', 'net', 'org', 'b.org', 'example.com'])}"
        f"{rng.choice(['/en/', '/fr/', '/de/', '/fr/deep/er/', '/', ''])}{rng.choice(['x', 'y', ''])}"
        for _ in range(300)
    ]
    urls = URLS + made + ["http://hot.b.org/fr/deep/er"] * 400
    rows = [(i if i % 7 else None, u, "kept", "mine") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, _extra string").repartition(5)
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge_urls(df, frame)
    assert got.columns == ["page_id", "url", "_extra", "host", "path", "rule", "verdict"]
    expected = Counter((r[0], r[1], r[3], *judged(r[1], rules)) for r in rows)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_url_filter_without_rows_or_rules(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(df, rules).collect()] == ["allow"]
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


def blocks(text, templates, threshold, stride):
    w, out = words(text), set()
    for i in range(0, len(w), stride):
        have = set(w[i : i + 2 * stride])
        for n, (t, label) in enumerate(templates):
            tokens = set(t.split(" "))
            need = len(tokens) if len(tokens) < 10 else math.ceil(threshold * len(tokens) - 1e-9)
            if len(have & tokens) >= need:
                out.add((n, label, i, round(len(have & tokens) / len(tokens), 9)))
    return out


def test_license_blocks_equal_brute_force(spark):
    rng = random.Random(5)
    common = ["the", "of", "and", "license", "software", "permission", "use", "this", "work", "is"]
    texts = [None, "", "Released under the MIT License.", "CC BY-NC 4.0 cc by nc", "é" * 3]
    for t, _ in license_scan.TEMPLATES:
        parts = t.split(" ")
        for keep in (1.0, 0.85, 0.7):
            chosen = [p for p in parts if rng.random() < keep]
            filler = [rng.choice(common) for _ in range(rng.randint(0, 90))]
            at = rng.randint(0, len(filler))
            texts.append(" ".join(filler[:at] + chosen + filler[at:]).title())
    texts.append("word " * 30000 + license_scan.TEMPLATES[0][0])
    texts += texts[-3:]
    rows = [(i % 40 if i % 9 else None, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    stride = max(len(t.split(" ")) for t, _ in license_scan.TEMPLATES)
    got = Counter(
        (r["_key"], r.template, r.label, r.first_word, round(r.containment, 9))
        for r in license_scan.license_blocks(df).collect()
    )
    expected = Counter({
        (k, *b) for k, t, _ in rows for b in blocks(t, license_scan.TEMPLATES, 0.8, stride)
    })
    assert set(got) == set(expected)

    report = license_scan.scan_licenses(df).collect()
    assert len(report) == len(rows)
    by_label = Counter((r.doc_id, r.n_words, r.labels, r.base_labels) for r in report)
    want = Counter()
    for k, t, _ in rows:
        w = words(t)
        base = {
            label for p, label in license_scan.PHRASES
            if any(w[i : i + len(p.split())] == p.split() for i in range(len(w)))
        }
        more = {b[1] for b in blocks(t, license_scan.TEMPLATES, 0.8, stride)}
        want[(k, len(w), ",".join(sorted(base | more)), ",".join(sorted(base)))] += 1
    assert by_label == want


def test_short_sentences_need_their_telling_word(spark):
    texts = ["Released under the BSD license", "released under the apache license", "released under the MIT license.",
             "licensed under the apache license version 1 0", "licensed under the Apache License, Version 2.0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.labels for r in license_scan.scan_licenses(df).orderBy("doc_id").collect()]
    assert got == ["", "", "mit", "", "apache-2"]


def test_license_phrases_and_empty_table(spark):
    df = spark.createDataFrame(
        [(1, "x CC-BY-NC, cc by nc"), (2, "under The MIT license"), (3, None)], "doc_id long, text string"
    )
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (2, 1, 4)
    assert (got[2].base_labels, got[2].score, got[3].n_base, got[3].first_word) == ("mit", 1.0, 0, None)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def contaminated(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(window, len(v))
        if not n:
            continue
        spans = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
        at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in spans]
        if at:
            found.add(item)
            hit |= {i + j for i in at for j in range(n)}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


def corpus_and_items():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(10, 40))) for i in range(12)]
    items += [(20, "Short one, here"), (21, "w1 w2"), (22, ""), (23, None), (24, items[0][1]), (25, "ß")]
    docs = [None, "", "w1", "short ONE here", "ß", "w1 w2 w1 w2 w2"]
    for _ in range(60):
        parts = words(text(rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            v = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(v) - 9))
            parts += v[a : a + rng.choice([9, 10, 11, 25])]
            parts += words(text(rng.randint(0, 4)))
        docs.append(", ".join(parts).upper())
    docs.append("common " * 30000 + items[3][1])
    docs += docs[-5:]
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 1)
    docs, items = corpus_and_items()
    rows = [(i % 50 if i % 8 else None, t, 1) for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in decontaminate.decontamination_report(df, bench).collect())
    assert got == Counter((k, *contaminated(t, items, 10)) for k, t, _ in rows)
    clean = Counter(tuple(r) for r in decontaminate.clean_documents(df, bench).collect())
    assert clean == Counter(r for r in rows if not contaminated(r[1], items, 10)[-1])


def test_decontamination_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (2, "...")], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.decontamination_report(df, none).collect()] == [False]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.decontamination_report(df.limit(0), some).count() == 0
    assert decontaminate.clean_documents(df, some).count() == 0


def poisson_copies(rate, key, seed):
    parts, total = math.ceil(rate / mixing.PART), 0
    for part in range(1, parts + 1):
        mean = rate / parts
        u = int(hashlib.md5(f"{seed}:{part}:{key}".encode()).hexdigest()[:13], 16) / 2**52
        term = cdf = math.exp(-mean)
        for k in range(1, mixing.MOST + 1):
            total += u >= cdf
            term *= mean / k
            cdf += term
    return total


def test_mixing_repeats_by_inverse_poisson(spark):
    rows = [(i, "big" if i % 3 else "small", f"t{i}", 9) for i in range(900)]
    rows += [(None, None, None, 9), (7, "small", "", 9), (7, "small", "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _n int")
    weights = {"big": 1.0, "small": 3.0, None: 0.01}
    sizes = Counter(r[1] for r in rows)
    rate = {s: weights[s] / 4.01 * len(rows) * 8 / n for s, n in sizes.items()}
    got = Counter(tuple(r) for r in mixing.mix_sources(df, weights, epochs=8.0, seed=4).collect())
    want = Counter()
    for r in rows:
        body = "" if r[2] is None else hashlib.md5(r[2].encode()).hexdigest()
        want[r] += poisson_copies(rate[r[1]], f"{'' if r[0] is None else r[0]}:{body}", 4)
    assert got == +want
    share = sum(n for r, n in got.items() if r[1] == "small") / got.total()
    assert abs(share - 3 / 4.01) < 0.03 and max(rate.values()) > mixing.PART


def test_mixing_cases(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(200)], "doc_id long, source string")
    assert {r.source for r in mixing.mix_sources(df, {"a": 1.0}).collect()} == {"a"}
    assert mixing.mix_sources(df.limit(0)).count() == 0
    copies = mixing.mix_sources(df.withColumn("copy", F.lit("x")), epochs=3.0, copy="copy")
    assert copies.columns == ["doc_id", "source", "copy"] and copies.agg(F.max("copy")).first()[0] > 1
    again = mixing.mix_sources(df.repartition(7), epochs=3.0, copy="copy").select(*copies.columns)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, copies.collect()))


def test_mixing_spreads_a_hot_key(spark):
    """A third of the rows has one key, a third none, and a ninth is one row again and again."""
    rows = [(7, "a", f"text {i}") for i in range(3000)] + [(None, "a", f"other {i}") for i in range(3000)]
    rows += [(i, "b", f"own {i}") for i in range(2000)] + [(8, "b", "same")] * 1000
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(8)
    mix = mixing.mix_sources(df, {"a": 1.0, "b": 1.0}, epochs=2.0)
    sizes = [r["count"] for r in mix.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.3 * sum(sizes) / len(sizes)
    draws = Counter(r["count"] for r in mix.where("doc_id = 7").groupBy("text").count().collect())
    assert len(draws) > 3
    share = mix.where("source = 'a'").count() / sum(sizes)
    assert abs(share - 0.5) < 0.06
