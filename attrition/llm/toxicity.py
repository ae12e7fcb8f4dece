"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed words. Besides a weight, each term has a vector; the product of
two vectors is the weight of the pair, so an insult next to a group's name can count for more than
both alone. With s the sum of a document's vectors, all pairs cost no more than one pass:
``(|s|^2 - sum |v|^2) / 2``.

The model is fitted on a sample of the labelled rows, bounded by ``max_rows`` documents and ``max_terms`` of their
distinct terms together: of each key one text is taken, terms are hashed on
the cluster, and index arrays come to the driver, where minibatches with adaptive steps run. Terms
that occur fewer than ``MIN_DOCS`` times, or on which the label does not depend, neither alone nor together with
another one, have no weight. Five
machines, each fitted without a fifth of the sample, calibrate the scores to probabilities. Every
document of the table is scored whole, batch by batch, in one pass without a shuffle; the model has
a fixed size (about 10 MB) and travels with the tasks.

Cases: null and empty texts have no terms and get the model's base score; a null key is no row of
the sample and counts as not held out; of documents that share a key, the text with the smallest hash is
learnt from and all are scored; rows repeated in the labels are one label, contradicting ones count as toxic; without labelled rows every score is 0; extra columns are ignored by the report and
kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import fresh, give_back, read, without, words_of, written

SLOTS, FACTORS, MIN_DOCS, LEAST_RATIO = 1 << 18, 8, 3, 12.0
PAIR_SCALE, STEPS, FOLDS = 1.0, 2000, 5
#: Documents of a sample that the driver lays out as tables at once.
AT_ONCE = 512
#: Pairs are looked for among so many terms, those most frequent in toxic rows of the sample; a pair counts if it occurs in so
#: many of them and its likelihood ratio is so much above those of its terms. There are some 130,000 pairs to try.
PAIR_TERMS, PAIR_DOCS, PAIR_RATIO = 512, 8, 40.0
THRESHOLD = 0.7
MAX_ROWS, MAX_TERMS = 20_000, 40_000_000


def terms(text: str | None) -> np.ndarray:
    """Slots of a text's distinct words, ascending."""
    return np.unique(np.fromiter(map(crc32, set(words_of(text))), np.int64) & (SLOTS - 1)).astype(
        np.int32
    )


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # float32, by slot
    factors: np.ndarray  # float32, slot by factor
    values: np.ndarray  # float32, 1 for the terms that tell something, else 0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Margins of documents whose slots stand one after another."""
        x = self.values[slots]
        v = self.factors[slots] * (x * self.scale(slots, lengths))[:, None]
        table = np.concatenate([(self.weights[slots] * x)[:, None], v, (v * v).sum(1)[:, None]], 1)
        sums = _by_document(table, lengths)
        return self.bias + sums[:, 0] + 0.5 * ((sums[:, 1:-1] ** 2).sum(1) - sums[:, -1])

    def scale(self, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For the pairs, a document's values are divided by the root of their number, so that long
        texts, which have many pairs, do not outweigh the words."""
        known = _by_document((self.values[slots] > 0)[:, None], lengths)[:, 0]
        return np.repeat(PAIR_SCALE / np.sqrt(np.maximum(known, 1)), lengths)

    def scores(self, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(slots, lengths) + self.shift)


def _by_document(table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lengths), table.shape[1]), np.float64)
    full = lengths > 0
    if full.any():
        starts = (np.cumsum(lengths) - lengths)[full]
        out[full] = np.add.reduceat(table.astype(np.float64), starts, axis=0)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _platt(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with smoothed targets so that they stay finite."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([raw, np.ones_like(raw)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    return float(max(theta[0], 1e-3)), float(theta[1])


def _ratios(n: np.ndarray, toxic: np.ndarray, all_n: float, all_toxic: float) -> np.ndarray:
    """Likelihood ratio of the label with an event that ``n`` documents have, ``toxic`` of them toxic."""

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12)), 0)

    share = all_toxic / max(all_n, 1)
    without_n, without_toxic = all_n - n, all_toxic - toxic
    return 2 * (
        part(toxic, n * share) + part(n - toxic, n * (1 - share))
        + part(without_toxic, without_n * share) + part(without_n - without_toxic, without_n * (1 - share))
    )


def informative(documents: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Values of terms: 1 where the label depends on the term (likelihood ratio above ``LEAST_RATIO``) or on a pair with
    it, else 0. A text has hundreds of words and a rare one seldom tells anything; with all of them, a
    machine learns documents by heart."""
    n, toxic = np.zeros(SLOTS), np.zeros(SLOTS)
    for i in range(0, len(documents), AT_ONCE):
        slots, lengths = _flat(documents[i : i + AT_ONCE])
        n += np.bincount(slots, minlength=SLOTS)
        toxic += np.bincount(slots, np.repeat(labels[i : i + AT_ONCE], lengths), SLOTS)
    ratio = _ratios(n, toxic, float(len(labels)), float(labels.sum()))
    values = ((n >= MIN_DOCS) & (ratio >= LEAST_RATIO)).astype(np.float32)
    values[telling_together(documents, labels, toxic, ratio)] = 1
    return values


def telling_together(documents: list[np.ndarray], labels: np.ndarray, toxic: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Slots of the pairs that go with toxic rows more than their terms do alone, such as two words that are harmless each."""
    terms = np.flatnonzero(toxic >= PAIR_DOCS)
    terms = np.sort(terms[np.argsort(-toxic[terms], kind="stable")[:PAIR_TERMS]])
    if len(terms) < 2:
        return terms[:0]
    place = np.full(SLOTS, -1)
    place[terms] = np.arange(len(terms))
    both = np.zeros((2, len(terms), len(terms)))
    for label in (0, 1):
        own = [d for d, y in zip(documents, labels) if int(y) == label]
        for i in range(0, len(own), AT_ONCE):
            rows = [place[d] for d in own[i : i + AT_ONCE]]
            table = np.zeros((len(rows), len(terms)), np.float32)
            at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            column = np.concatenate(rows)
            table[at[column >= 0], column[column >= 0]] = 1
            both[label] += table.T @ table
    pair = _ratios(both.sum(0), both[1], float(len(labels)), float(labels.sum()))
    more = both[1] * len(labels) > both.sum(0) * labels.sum()
    own = ratio[terms]
    good = (both[1] >= PAIR_DOCS) & more & (pair >= PAIR_RATIO + own[:, None] + own[None, :])
    np.fill_diagonal(good, False)
    return terms[good.any(1)]


def fit_machine(
    documents: list[np.ndarray], labels: np.ndarray, epochs: int | None = None, seed: int = 7
) -> Machine:
    """Fit on all documents. Each fifth of them is also scored by a machine fitted on the others;
    these scores, which no document had a part in, calibrate."""
    labels = labels.astype(np.float64)
    fold = np.random.default_rng(seed).permutation(len(documents)) % FOLDS
    raw = np.zeros(len(documents))
    for f in range(FOLDS):
        own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        if len(own) and len(rest):
            part = _fit([documents[i] for i in rest], labels[rest], epochs, seed)
            for i in range(0, len(own), AT_ONCE):
                some = own[i : i + AT_ONCE]
                raw[some] = part.raw(*_flat([documents[j] for j in some]))
    model = _fit(documents, labels, epochs, seed)
    model.slope, model.shift = _platt(raw, labels)
    return model


def _flat(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    slots = np.concatenate([*documents, np.zeros(0, np.int32)]).astype(np.int64)
    return slots, np.array([len(d) for d in documents], np.int64)


def _fit(
    documents: list[np.ndarray], labels: np.ndarray, epochs: int | None, seed: int
) -> Machine:
    """Adaptive minibatch steps on the logistic loss, without calibration."""
    rng, train = np.random.default_rng(seed), len(documents)
    values = informative(documents, labels)
    documents = [d[values[d] > 0] for d in documents]
    batches = max(1, train // 128)
    epochs = epochs or max(8, STEPS // batches)
    rate = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    model = Machine(
        float(np.log(rate / (1 - rate))),
        np.zeros(SLOTS, np.float32),
        rng.normal(0, 0.01, (SLOTS, FACTORS)).astype(np.float32),
        values,
    )
    squares, pairs = np.full(SLOTS, 1e-6), np.full((SLOTS, FACTORS), 1e-6)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), batches):
            lengths = np.array([len(documents[i]) for i in part])
            slots = np.concatenate([documents[i] for i in part]).astype(np.int64)
            if not len(slots):
                continue
            error = _sigmoid(model.raw(slots, lengths)) - labels[part]
            model.bias -= 0.05 * float(error.mean())
            each = np.repeat(error, lengths)
            x = model.values[slots].astype(np.float64)
            px = x * model.scale(slots, lengths)
            v = model.factors[slots] * px[:, None]
            total = np.repeat(_by_document(v, lengths), lengths, axis=0)
            used, place = np.unique(slots, return_inverse=True)
            gw = np.bincount(place, each * x, len(used)) + 1e-3 * model.weights[used]
            gv = np.stack(
                [np.bincount(place, each * px * (total[:, k] - v[:, k]), len(used)) for k in range(FACTORS)], 1
            ) + 1e-2 * model.factors[used]
            squares[used] += gw**2
            pairs[used] += gv**2
            model.weights[used] -= (0.2 * gw / np.sqrt(squares[used])).astype(np.float32)
            model.factors[used] -= (0.02 * gv / np.sqrt(pairs[used])).astype(np.float32)
    return model


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _term_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "_id": batch["_id"].astype(str),
                "toxic": batch["toxic"],
                "slots": [terms(t).tobytes() for t in batch["text"]],
            }
        )


def train_machine(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
    max_terms: int = MAX_TERMS,
) -> Machine | None:
    """Fit on the labelled rows that are not held out, on about ``max_rows`` of them at most, which have about ``max_terms``
    distinct terms at most, chosen by a hash of the key. None without such rows."""
    named = F.col(f"`{key}`")
    marks = (
        labels.where(named.isNotNull() & F.col(label).isNotNull() & ~held_out(named))
        .groupBy(named.alias("_key"))
        .agg(F.max(F.col(label).cast("int")).alias("toxic"))
    )
    n = marks.count()
    if n > max_rows:
        share = F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) / float(1 << 30)
        marks = marks.where(share < max_rows / n)
    body = F.col(f"`{text}`")
    # One text for each key; the others shrink away before the shuffle.
    texts = (
        docs.select(named.alias("_id"), body.alias("text"))
        .join(marks, F.col("_id") == F.col("_key"))
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_one"))
        .select("_id", "toxic", "_one.text")
    )
    rows = written(texts.mapInPandas(_term_frames, "_id string, toxic int, slots binary"), "toxicity-sample")
    held = (rows.agg(F.sum(F.octet_length("slots"))).first()[0] or 0) / 4
    if held > max_terms:
        share = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(share < max_terms / held)
    sample = rows.toPandas().sort_values(["_id", "slots"])
    if not len(sample):
        return None
    documents, marks = [np.frombuffer(b, np.int32) for b in sample["slots"]], sample["toxic"].to_numpy()
    del sample
    give_back()
    return fit_machine(documents, marks)


def _scored(machine: Machine, found: list[np.ndarray]) -> np.ndarray:
    lengths = np.array([len(f) for f in found], np.int64)
    return machine.scores(np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int64), lengths)


def toxicity_score(spark: SparkSession, machine: Machine | None, text: Column) -> Column:
    """The score of a text column as a column."""
    if machine is None:
        return F.lit(0.0)
    model = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            scores: list[np.ndarray] = []
            found: list[np.ndarray] = []
            held = 0
            for text in batch:
                found.append(terms(text))
                held += len(found[-1])
                if held > 200_000:
                    scores.append(_scored(model.value, found))
                    found, held = [], 0
            yield pd.Series(np.concatenate([*scores, _scored(model.value, found)]))
        give_back()

    return score(text)


def toxicity_report(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row for each document: key, held_out, score, predicted."""
    machine = train_machine(docs, labels, key, text, **options)
    score = toxicity_score(docs.sparkSession, machine, F.col(f"`{text}`"))
    return docs.select(
        F.col(f"`{key}`").alias(key), held_out(F.col(f"`{key}`")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def not_toxic(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    machine = train_machine(docs, labels, key, text, **options)
    score = toxicity_score(docs.sparkSession, machine, F.col(f"`{text}`"))
    own = fresh(docs, "_score")
    return docs.withColumn(own, score).where(F.col(own) < THRESHOLD).select(*without(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_report(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
