"""Benchmark decontamination by winnowing.

A span of ``window`` words of a benchmark item (an item of fewer words is one span) makes a document
dirty where it occurs. Of every ``window - gram + 1`` successive hashes of ``gram`` words each text
keeps the smallest: two texts that share a span of ``window`` words have the same hashes there, keep
the same smallest one and meet in a join of the kept hashes. A hit is extended: the spans of the
document whose smallest hash met are compared, word for word, with those of the benchmark. So every
shared span is found and nothing else.

Hashes are computed inside each document's row; what is joined is one long for about every third
word. The benchmark's hashes are broadcast behind a check of their number; beyond it, hashes and
documents are joined by shuffles. Results are grouped by document only.

Cases: null texts have no words; an empty document is clean; an empty benchmark, or one whose items
have no words, leaves all documents clean; repeated documents and items get equal results, and an
item's id is listed once; null item ids are counted but not listed; only key and text are read, so
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import WORD, fresh, read, word_count, words, written

WINDOW, GRAM = 10, 5
#: Hashes of the benchmark are broadcast up to this number (16 bytes each).
BROADCAST_ROWS = 1_000_000


def _gram_hashes(hashes: Column, gram: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - gram),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(gram)]),
    )


def fingerprints(df: DataFrame, window: int, gram: int) -> DataFrame:
    """``df``, which has ``_words``, with ``_minima``: the smallest hash of every span."""
    enough = F.size("_words") >= window
    return (
        df.where(enough)
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_grams", _gram_hashes(F.col("_hashes"), gram))
        .withColumn("_minima", _smallest(F.col("_grams"), window - gram + 1))
        .drop("_hashes", "_grams")
    )


def _smallest(grams: Column, width: int) -> Column:
    if width == 1:
        return grams
    return F.transform(
        F.sequence(F.lit(0), F.size(grams) - width),
        lambda j: F.least(*[F.get(grams, j + i) for i in range(width)]),
    )


def _spans(df: DataFrame, window: int) -> DataFrame:
    """Starts and texts of the spans whose smallest hash is ``_print``."""
    places = F.filter(
        F.sequence(F.lit(0), F.size("_minima") - 1),
        lambda j: F.get("_minima", j) == F.col("_print"),
    )
    return (
        df.withColumn("_start", F.explode(places))
        .withColumn("_span", F.array_join(F.slice("_words", F.col("_start") + 1, window), " "))
    )


def shared_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Each span that a document shares with an item: ``_key``, ``_text`` (a hash of the document's
    text), ``_start``, ``_length``, ``_item``; positions count words from 0."""
    items = written(
        benchmark.select(
            F.col(f"`{item}`").alias("_item"), words(F.col(f"`{item_text}`")).alias("_words")
        ).where(F.size("_words") > 0),
        "benchmark-words",
    )
    split = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.xxhash64(f"`{text}`").alias("_text"),
        words(F.col(f"`{text}`")).alias("_words"),
    )
    # Lengths of spans: the window, and the at most window - 1 lengths of shorter items.
    sizes = items.select(F.least(F.size("_words"), F.lit(window)).alias("n")).distinct().collect()
    found = None
    for size in sorted(r.n for r in sizes):
        width = gram if size == window else size
        own = items.where(F.size("_words") >= window if size == window else F.size("_words") == size)
        own = fingerprints(own, size, width)
        prints = own.select(F.explode(F.array_distinct("_minima")).alias("_print")).distinct()
        spans = _spans(own.withColumn("_print", F.explode(F.array_distinct("_minima"))), size)
        spans = spans.select("_item", "_span").distinct()
        marked = fingerprints(split, size, width)
        if prints.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            met = marked.withColumn("_print", F.explode(F.array_distinct("_minima"))).join(
                F.broadcast(prints), "_print"
            )
        else:
            pairs = (
                marked.select("_key", "_text", F.explode(F.array_distinct("_minima")).alias("_print"))
                .join(prints, "_print")
                .distinct()
                .withColumnsRenamed({"_key": "_key2", "_text": "_text2"})
            )
            met = marked.join(
                pairs,
                F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_text") == F.col("_text2")),
            )
        hits = (
            _spans(met, size)
            .select("_key", "_text", "_start", "_span")
            .join(spans, "_span")
            .select("_key", "_text", "_start", F.lit(size).alias("_length"), "_item")
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return split.select(
            "_key", "_text", F.lit(0).alias("_start"), F.lit(0).alias("_length"),
            F.lit(None).cast(benchmark.schema[item].dataType).alias("_item"),
        ).where(F.lit(False))
    return found.distinct()


def decontamination_report(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each document: its words, the words inside shared spans, the items that occur."""
    spans = written(
        shared_spans(docs, benchmark, window, gram, key, text, item, item_text), "shared-spans"
    )
    ends = spans.groupBy("_key", "_text", "_start").agg(F.max("_length").alias("_length"))
    before = (
        W.partitionBy("_key", "_text").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    )
    end = F.col("_start") + F.col("_length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    hit = (
        ends.withColumn("_new", F.greatest(end - F.greatest(reached, F.col("_start")), F.lit(0)))
        .groupBy("_key", "_text")
        .agg(F.sum("_new").alias("_n_hit"))
    )
    listed = spans.groupBy("_key", "_text").agg(
        F.collect_set(F.col("_item").cast("string")).alias("_items"),
        F.max(F.col("_item").isNull().cast("int")).alias("_unnamed"),
    )
    per_doc = hit.join(listed.withColumnsRenamed({"_key": "_key2", "_text": "_text2"}),
        F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_text") == F.col("_text2")),
    ).drop("_key2", "_text2")
    rows = docs.select(
        F.col(f"`{key}`").alias(key),
        F.xxhash64(f"`{text}`").alias("_hash"),
        word_count(F.col(f"`{text}`")).cast("long").alias("n_words"),
    )
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return rows.join(
        per_doc, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_text")), "left"
    ).select(
        key,
        "n_words",
        F.coalesce("_n_hit", F.lit(0)).cast("long").alias("n_hit"),
        (F.size(items) + F.coalesce("_unnamed", F.lit(0))).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(items), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("_n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents that share no span with the benchmark, with all their columns."""
    text = options.get("text", "text")
    name, body = fresh(docs, "_key"), fresh(docs, "_text")
    dirty = (
        shared_spans(docs, benchmark, key=key, **options)
        .select(F.col("_key").alias(name), F.col("_text").alias(body))
        .distinct()
    )
    return docs.join(
        dirty,
        F.col(f"`{key}`").eqNullSafe(F.col(name)) & (F.xxhash64(f"`{text}`") == F.col(body)),
        "left_anti",
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination_report(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark),
s AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
    array_to_string(w[i + 1 : i + least(len(w), {WINDOW})], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
c AS (SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS span FROM
  (SELECT r, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM s))),
h AS MATERIALIZED (SELECT DISTINCT r, i, n, item_id FROM c JOIN s USING (n, span)),
x AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
y AS (SELECT r, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS items FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (r) LEFT JOIN y USING (r)
"""
