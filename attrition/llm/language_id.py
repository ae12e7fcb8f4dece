"""Language identification, words first.

A known word adds its log frequency in each language. An unseen word backs off to its character
n-grams: of the longest length at which the model knows any of them, the known ones' log
frequencies are averaged; otherwise shorter n-grams decide. The language with the largest sum is
predicted; the score is its share of the probabilities that the sums stand for, per ``SOFTNESS``
words, so that long texts do not all score 1.

The model is counted by Spark jobs on a sample of the labelled rows, bounded by ``max_rows``, and
keeps the ``MAX_WORDS`` most frequent words and ``MAX_GRAMS`` most frequent n-grams; this bounded table
goes to the driver and travels with the tasks. Prediction is one pass over the table without a
shuffle, whole texts, batch by batch; the memory of unseen words is emptied when it gets large.

Cases: null texts and texts without a letter are ``und`` with score 0; rows with a null language or
key are not learned from (a null key counts as not held out); equal sums go to the alphabetically
first language; with nothing to learn from everything is ``und``; repeated rows are predicted alike;
extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import read, written

MAX_ROWS, MAX_WORDS, MAX_GRAMS = 20_000, 100_000, 100_000
LONGEST, MIN_COUNT = 4, 3
SOFTNESS = 20.0
UNSEEN_KEPT = 200_000
LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return [] if text is None else LETTERS.findall(text.lower())


@dataclass
class Frequencies:
    """Log frequencies per language of words and n-grams; ``floor`` is that of a single letter that
    was never seen."""

    languages: list[str]
    words: dict[str, tuple[float, ...]]
    grams: list[dict[str, tuple[float, ...]]]  # by length - 1
    floor: tuple[float, ...]
    unseen: dict[str, tuple[float, ...]] = field(default_factory=dict)

    def of(self, word: str) -> tuple[float, ...]:
        known = self.words.get(word) or self.unseen.get(word)
        if known is None:
            if len(self.unseen) >= UNSEEN_KEPT:
                self.unseen.clear()
            known = self.unseen[word] = self.backed_off(word)
        return known

    def backed_off(self, word: str) -> tuple[float, ...]:
        for n in range(min(LONGEST, len(word)), 0, -1):
            table = self.grams[n - 1]
            found = [g for i in range(len(word) - n + 1) if (g := table.get(word[i : i + n]))]
            if found:
                return tuple(sum(column) / len(found) for column in zip(*found))
        return self.floor

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(letters(text))
        if not counts or not self.languages:
            return "und", 0.0
        table = np.array(list(map(self.of, counts)))
        sums = np.fromiter(counts.values(), np.float64) @ table
        best = int(np.argmax(sums))
        weights = np.exp((sums - sums[best]) / max(1.0, counts.total() / SOFTNESS))
        return self.languages[best], float(1.0 / weights.sum())


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words by language, summed within each batch."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(lang, Counter()).update(letters(text))
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
        yield pd.DataFrame(rows, columns=["lang", "word", "n"])


def learn(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_rows: int = MAX_ROWS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
    min_count: int = MIN_COUNT,
) -> Frequencies:
    """Count words and n-grams of rows with a language that are not held out, of about ``max_rows`` at most. The model, which goes
    to every task, keeps the ``max_words`` and ``max_grams`` most frequent that occur ``min_count`` times."""
    named = F.col(f"`{key}`")
    rows = docs.where(
        named.isNotNull() & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull() & ~held_out(named)
    )
    n = rows.count()
    if n > max_rows:
        share = F.pmod(F.xxhash64(named), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(share < max_rows / n)
    words = written(
        rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
        .mapInPandas(_words_of_batches, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.char_length("word"))))
    grams = (
        words.withColumn("size", sizes)
        .withColumn("at", F.explode(F.expr("sequence(1, char_length(word) - size + 1)")))
        .groupBy("lang", "size", F.expr("substring(word, at, size)").alias("gram"))
        .agg(F.sum("n").alias("n"))
    )

    def most(table: DataFrame, by: list[str], limit: int) -> list:
        """The most frequent entries over all languages, with their counts by language."""
        return (
            table.groupBy(*by)
            .agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts"))
            .where(F.col("total") >= min_count)
            .orderBy(F.desc("total"), *by)
            .limit(limit)
            .collect()
        )

    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)

    def logs(counts: dict, all_of: dict, entries: int) -> tuple[float, ...]:
        """Smoothed by a tenth of an occurrence for each entry of the table."""
        return tuple(
            float(np.log((counts.get(x, 0) + 0.1) / (all_of[x] + 0.1 * entries + 0.1)))
            for x in languages
        )

    known = most(words, ["word"], max_words)
    kept_words = {r.word: logs(r.counts, totals, len(known)) for r in known}
    kept_grams: list[dict] = [{} for _ in range(LONGEST)]
    per_size = {
        (r.lang, r["size"]): r.n
        for r in grams.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    }
    known = most(grams, ["size", "gram"], max_grams)
    entries = Counter(r["size"] for r in known)
    for r in known:
        all_of = {x: per_size.get((x, r["size"]), 0) for x in languages}
        kept_grams[r["size"] - 1][r.gram] = logs(r.counts, all_of, entries[r["size"]])
    floor = logs({}, {x: per_size.get((x, 1), 0) for x in languages}, entries[1])
    return Frequencies(languages, kept_words, kept_grams, floor)


def identify(
    docs: DataFrame, model: Frequencies, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: key, held_out, predicted language, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [shared.value.predict(t) for t in texts], columns=["lang_pred", "score"]
        )

    return docs.select(
        F.col(f"`{key}`").alias(key),
        held_out(F.col(f"`{key}`")).alias("held_out"),
        predict(F.col(f"`{text}`")).alias("_found"),
    ).select(key, "held_out", "_found.lang_pred", "_found.score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))
