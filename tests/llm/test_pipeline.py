"""The pipeline stage by stage, and the registration of its queries."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from attrition.llm import decontaminate, simhash, toxicity
from attrition.llm.common import read, written

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs, kept = read(spark, SMALL, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if i < 4:
            assert out.columns == docs.columns
        kept.append((docs, written(out, "stage")))
        docs = kept[-1][1]
    (first, clean), (_, single), (_, safe), (_, mixed), (_, tokens) = kept
    report = toxicity.toxicity_report(first, read(spark, SMALL, "labels"))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(clean) == ids(report.where("predicted = 0"))
    groups = simhash.near_duplicates(clean)
    assert ids(single) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())
    dirty = decontaminate.decontamination_report(single, read(spark, SMALL, "benchmark"))
    assert ids(safe) == ids(dirty.where("not contaminated"))
    assert set(ids(mixed)) <= set(ids(safe)) and ids(tokens) == ids(mixed)
    assert ids(corpus_pipeline.run(spark, SMALL)) == ids(tokens)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and keys, a source with a third of all rows, further columns."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(None, None, "a", 1), (None, "x y z", None, 2), (1, "", "b", 3), (1, "other words here", "b", 4)]
    rows += [(2, "same text of this row", "hot", 5)] * 5 + [(i, f"own {i} text {i * i} here", "hot", i) for i in range(10, 20)]
    rows += [(30, long, "c", 6), (31, long + " end", "c", 7)]
    schema = "doc_id long, text string, source string, _PRINT int"
    full = spark.createDataFrame(rows, schema).withColumn("lang", F.lit(None).cast("string"))
    for name, docs in (("odd", full), ("none", full.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        read(spark, SMALL, "benchmark").write.parquet(f"{folder}/benchmark.parquet")
        read(spark, SMALL, "labels").limit(0).write.parquet(f"{folder}/labels.parquet")
        staged = read(spark, folder, "documents")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
            before, staged = staged, stage(spark, staged, folder)
            assert staged.columns == before.columns
        kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in staged.collect())
        if name == "none":
            assert kept == []
        else:
            prints = {simhash.fingerprint(t) for _, t, _, _ in rows}
            assert len(kept) <= len(prints) and len(kept) == len(set(kept))
            assert (False, 1, "") in kept and (False, 2, "same text of this row") in kept
            assert (False, 30, long) in kept and (False, 31, long + " end") not in kept
        out = corpus_pipeline.run(spark, folder)
        assert {r.doc_id for r in out.collect()} <= {k[1] if not k[0] else None for k in kept}


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
