"""The pipeline's near-duplicate stage computes fingerprints once."""

from __future__ import annotations

from attrition.llm import simhash


def test_what_stays_is_chosen_without_python(spark):
    rows = [(1, "one two three four", "a"), (2, "one two three four", "b"), (3, "quite another text of words", "c"), (None, "", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _mark string")
    kept = simhash.one_of_each_group(df)
    assert "EvalPython" not in kept._jdf.queryExecution().toString()
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.where("doc_id IS NOT NULL").collect()) == [(1, "one two three four", "a"), (3, "quite another text of words", "c")]
    assert kept.where("doc_id IS NULL").count() == 1
