"""License scans: phrases that stand word by word, and an exact set-similarity join.

The join compares text blocks with the word sets of license templates. A block is a window of twice
``stride`` words that starts at a multiple of ``stride``; a passage of up to ``stride`` words, and so
every template, lies whole in some block. A block contains a template if it has at least the share
``threshold`` of the template's words, and all of them if they are fewer than ``ALL_BELOW``: in a short
sentence the one word that is missing may be the license's name. The words of a template are ordered from the rarest in the
corpus to the most frequent. A block that has enough of them has one of the first ``size - need + 1``
(prefix filter), so only these rare words are looked up; a candidate is dropped if the words of the
template from there on, or the words of the block, are too few (positional and length filter). All
others are verified by intersection. The filters lose nothing.

The lookup is a hash join of the corpus words with the prefix words, broadcast behind a check of
their number. Neither join nor verification gathers words of several documents in one group.

Cases: a null or empty text has no word, no place, no label and score 0; repeated rows get the same
result; long texts are scanned whole; an empty table gives an empty result; only the key and the
text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import WORD, read, words, written

#: Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Sentences by which licenses are known, and their labels.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("released under the mit license", "mit"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("licensed under a creative commons attribution noncommercial license", "cc-by-nc"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
THRESHOLD = 0.8
#: Templates of fewer distinct words have to be there whole.
ALL_BELOW = 10
#: Lookup tables are broadcast up to this number of rows.
BROADCAST_ROWS = 200_000


def _few(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it is small; otherwise the join shuffles."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _hashed(tokens: DataFrame) -> DataFrame:
    """Words to look up, with a hash: a join on a long is several times as fast as one on text."""
    return _few(tokens.withColumn("_hash", F.xxhash64("_token")))


def _same_word() -> Column:
    return (F.xxhash64("_word") == F.col("_hash")) & (F.col("_word") == F.col("_token"))


def phrase_places(words_column: Column, phrase: str) -> Column:
    """All places where the words of ``phrase`` stand one after another, counted from 0."""
    parts = phrase.split(" ")

    def stands(i: Column) -> Column:
        test = F.get(words_column, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            test = test & (F.get(words_column, i + j) == part)
        return test

    present = F.size(words_column) >= len(parts)
    for part in sorted(set(parts), key=len, reverse=True):
        present = present & F.array_contains(words_column, part)
    last = F.size(words_column) - len(parts)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)
    return F.when(present, starts).otherwise(F.array().cast("array<int>"))


def templates_frame(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    rows = [(i, label, sorted(set(text.split(" ")))) for i, (text, label) in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, tokens array<string>")


def ordered_templates(
    docs_words: DataFrame, templates: DataFrame, threshold: float
) -> DataFrame:
    """One row for each prefix word of each template: the word, its place in the template's order,
    the template's size and tokens, and the number of words that are needed."""
    tokens = templates.select("template", "label", F.explode("tokens").alias("_token"))
    vocabulary = _hashed(tokens.select("_token").distinct())
    frequency = (
        docs_words.select(F.explode("_words").alias("_word"))
        .join(vocabulary, _same_word())
        .groupBy("_token")
        .agg(F.count("*").alias("_frequency"))
    )
    order = W.partitionBy("template").orderBy("_frequency", "_token")
    whole = W.partitionBy("template")
    return (
        tokens.join(frequency, "_token", "left")
        .fillna(0, ["_frequency"])
        .withColumn("_place", F.row_number().over(order) - 1)
        .withColumn("_size", F.count("*").over(whole))
        .withColumn("_tokens", F.collect_list("_token").over(whole))
        .withColumn(
            "_need",
            F.when(F.col("_size") < ALL_BELOW, F.col("_size"))
            .otherwise(F.ceil(F.col("_size") * F.lit(threshold) - 1e-9)).cast("int"),
        )
        .where("_place <= _size - _need")
        .drop("_frequency")
    )


def license_blocks(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Blocks that contain a template: the key, a hash of the text, template, label, first word and
    word after the last of the block, containment."""
    spark = docs.sparkSession
    stride = max(len(t.split(" ")) for t, _ in templates)
    split = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.xxhash64(f"`{text}`").alias("_text"),
        words(F.col(f"`{text}`")).alias("_words"),
    )
    prefix = written(
        ordered_templates(split, templates_frame(spark, templates), threshold), "license-prefix"
    )
    found = split.select("*", F.posexplode("_words").alias("_at", "_word")).join(
        _hashed(prefix), _same_word()
    )
    block = F.expr(f"_at div {stride}").cast("int")
    return (
        found.withColumn("_block", F.explode(F.array(block, block - 1)))
        .where("_block >= 0")
        .withColumn("_window", F.array_distinct(F.slice("_words", F.col("_block") * stride + 1, 2 * stride)))
        .where("least(_size - _place, size(_window)) >= _need")
        .select(
            "_key",
            "_text",
            "template",
            "label",
            (F.col("_block") * stride).alias("first_word"),
            F.least(F.size("_words"), F.col("_block") * stride + 2 * stride).alias("end_word"),
            F.size(F.array_intersect("_window", "_tokens")).alias("_shared"),
            "_size",
            "_need",
        )
        .where(F.col("_shared") >= F.col("_need"))
        .withColumn("containment", F.col("_shared") / F.col("_size"))
        .drop("_shared", "_size", "_need")
        .distinct()
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document: number of words, places of phrases, labels, score. The score is 1
    with a phrase, else the largest containment of a template, else 0."""
    by_text = (
        license_blocks(docs, templates, threshold, key, text)
        .groupBy("_key", "_text")
        .agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_containment"))
    )
    split = docs.select(
        F.col(f"`{key}`").alias(key),
        F.xxhash64(f"`{text}`").alias("_hash"),
        words(F.col(f"`{text}`")).alias("_words"),
    )
    places = [phrase_places(F.col("_words"), p) for p, _ in phrases]
    base = split.select(
        key,
        "_hash",
        F.size("_words").cast("long").alias("n_words"),
        F.array(*places).alias("_places"),
    )
    labels = F.array(*[
        F.when(F.size(F.get("_places", F.lit(i))) > 0, label) for i, (_, label) in enumerate(phrases)
    ])
    joined = base.join(
        by_text, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_text")), "left"
    )
    flat = F.flatten("_places")
    return joined.withColumn("_base", F.array_compact(labels)).select(
        key,
        "n_words",
        F.size(flat).cast("long").alias("n_base"),
        F.array_min(flat).cast("long").alias("first_word"),
        F.array_max(flat).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(
            F.sort_array(
                F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>")))
            ),
            ",",
        ).alias("labels"),
        F.when(F.size(flat) > 0, 1.0).otherwise(F.coalesce("_containment", F.lit(0.0))).alias("score"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))


def needed(size: int, threshold: float = THRESHOLD) -> int:
    """How many of a template's distinct words a block must have."""
    return size if size < ALL_BELOW else math.ceil(size * threshold - 1e-9)


def oracle() -> str:
    """Every block against every template, without filters."""
    stride = max(len(t.split(" ")) for t, _ in TEMPLATES)
    values = ", ".join(
        f"('{label}', {sorted(set(text.split(' ')))!r}, {needed(len(set(text.split(' '))))})"
        for text, label in TEMPLATES
    )

    def places(phrase: str) -> str:
        parts = phrase.split(" ")
        test = " AND ".join(f"w[i + {j + 1}] = '{part}'" for j, part in enumerate(parts))
        return f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {test})"

    found = ", ".join(f"{places(p)} AS p{i}" for i, (p, _) in enumerate(PHRASES))
    every = "flatten([" + ", ".join(f"p{i}" for i in range(len(PHRASES))) + "])"
    names = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{n}' END" for i, (_, n) in enumerate(PHRASES))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
t(label, tokens, need) AS (VALUES {values}),
b AS (SELECT r, list_distinct(w[i * {stride} + 1 : i * {stride} + {2 * stride}]) AS block
  FROM (SELECT r, w, unnest(range(0, (len(w) + {stride} - 1) // {stride})) AS i FROM d)),
m AS (SELECT r, label, max(len(list_intersect(block, tokens)) / len(tokens)) AS containment FROM b, t
  WHERE len(list_intersect(block, tokens)) >= need GROUP BY r, label),
g AS (SELECT r, list(label) AS more, max(containment) AS containment FROM m GROUP BY r),
p AS (SELECT r, doc_id, len(w) AS n_words, {found} FROM d),
q AS (SELECT *, {every} AS places, list_filter([{names}], lambda x: x IS NOT NULL) AS base FROM p)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END::DOUBLE AS score
FROM q LEFT JOIN g USING (r)
"""


ORACLE = oracle()
