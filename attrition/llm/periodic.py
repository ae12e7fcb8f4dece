"""Periodic runs of words, by maximal pairs.

A run is a stretch of words with smallest period q and at least ``max(LEAST, 2 q)`` words that no
neighbouring word extends. Two places of a text with the same next l words, but other words before
them and behind those, are a maximal pair. If their distance q is l or less, the stretch from the first
place to the end of the second one's words has period q, and as the pair is maximal nothing extends
it: such pairs are exactly the runs, and nothing is left to extend. Pairs at a multiple of the smallest
period give the same stretch, of which the smallest distance counts.

Maximal pairs are met bottom-up in the tree of LCP intervals over the sorted suffixes of a text. Each
interval keeps its places in one sorted list for each word that stands before them (left-word class); where
intervals meet at depth l, the places of the smaller ones look up the places of other classes at
most l away. Suffixes are sorted by doubling, and common prefixes are read off the ranks of all steps, for all texts of
some megabytes at once. Before that, three exact filters thin out: a text without a repeated gram of
six words has no run; a place takes part only if a place less than 2h away shares its next h words, for a
power h of two, and if the places that are so chained have more than one class. So the interior of a
run, all of one class, is not looked at, and a run costs about one lookup for each multiple of its period.

The work is one pass over the rows without a shuffle: each text is judged alone, no key and no source
can be a hot spot, and a lost task is done again from its input.

Cases: null and empty texts, and white space alone, have no words and no runs; texts are judged whole,
however long; repeated rows and null keys stay; an empty table gives an empty result; further
columns are left out of ``periodic_runs`` and kept by ``collapsed``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import fresh, give_back, read, without

#: The fewest words of a run, and the fewest that the two places of its pair can share.
LEAST = 12
GRAM = LEAST // 2
#: Characters that are judged together; a longer text is a part of its own.
TOGETHER = 4_000_000
SLOTS = 1 << 22
RUN = "struct<start: int, length: int, period: int>"
Run = tuple[int, int, int]


def _gram_mixes(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each gram and its text; grams that reach beyond the text are none."""
    out = owner[: max(len(words) - GRAM + 1, 0)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(GRAM):
        out = (out ^ words[k : k + len(out)].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    return out


def repeating(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The texts (by number) that may hold a gram twice. Words of text after text, ``owner`` their texts."""
    mixes = _gram_mixes(words, owner)
    at = np.flatnonzero(owner[: len(mixes)] == owner[GRAM - 1 : GRAM - 1 + len(mixes)])
    mixes = mixes[at]
    slot = (mixes >> np.uint64(42)).astype(np.intp)
    twice = np.bincount(slot, minlength=SLOTS)[slot] > 1
    at, mixes = at[twice], mixes[twice]
    order = np.argsort(mixes)
    same = np.flatnonzero(mixes[order][1:] == mixes[order][:-1])
    return np.unique(owner[at[order[same]]])


def suffix_ranks(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Ranks of the suffixes of all texts by their first h words, for h = 1, 2, 4, ... The ranks of the last h are
    all different. Suffixes end with their text and are ordered by text first."""
    n = len(words)
    end = np.searchsorted(owner, owner, side="right")
    key = owner.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int32)
    new = np.r_[True, np.diff(key[order]) != 0]
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
    shared = np.bincount(rank, minlength=n + 2)
    active = np.flatnonzero(shared[rank] > 1)
    h, levels = 1, [(1, rank)]
    while len(active):
        rank = rank.copy()
        there = active + h
        second = np.where(there < end[active], rank[np.minimum(there, n - 1)], 0)
        first = rank[active]
        order = np.argsort(first.astype(np.int64) * (n + 2) + second, kind="stable")
        active, first, second = active[order], first[order], second[order]
        at = np.arange(len(active))
        fresh_first = np.r_[True, np.diff(first) != 0]
        fresh_any = fresh_first | np.r_[True, np.diff(second) != 0]
        begin = np.maximum.accumulate(np.where(fresh_any, at, 0))
        rank[active] = first + begin - np.maximum.accumulate(np.where(fresh_first, at, 0))
        sizes = np.diff(np.r_[np.flatnonzero(fresh_any), len(active)])
        active = np.sort(active[np.repeat(sizes > 1, sizes)])
        h *= 2
        levels.append((h, rank))
    return levels


def left_words(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The class of each place: the word before it; the first place of a text has a class of its own."""
    left = np.r_[-1, words[:-1]].astype(np.int64)
    left[np.r_[True, np.diff(owner) != 0]] = -1
    return left


def taking_part(levels: list[tuple[int, np.ndarray]], left: np.ndarray) -> np.ndarray:
    """The places of all pairs at a distance that a run allows, and few others."""
    part = np.zeros(len(left), bool)
    for h, rank in levels:
        if 2 * h <= GRAM:
            continue
        some = np.flatnonzero(np.bincount(rank, minlength=len(left) + 2)[rank] > 1)
        if not len(some):
            break
        some = some[np.argsort(rank[some], kind="stable")]
        near = (np.diff(rank[some]) == 0) & (np.diff(some) < 2 * h)
        group = np.r_[0, np.cumsum(~near)]
        mixed = np.bincount(group[1:], near & (np.diff(left[some]) != 0), minlength=group[-1] + 1) > 0
        part[some[mixed[group]]] = True
    return np.flatnonzero(part)


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` have in common; ``end`` is where a place's text ends."""
    n, out = len(end), np.zeros(len(a), np.int64)
    for h, rank in reversed(levels):
        i, j = a + out, b + out
        inside = (i < end[a]) & (j < end[b])
        out += h * (inside & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)]))
    return out


class Places:
    """The places of an LCP interval: all of them, and those of each left-word class, ascending."""

    __slots__ = ("every", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.every = [place]
        self.classes = {left: [place]}

    def others(self, place: int, left: int, reach: int, left_of: dict[int, int]) -> Iterator[int]:
        """Places of other classes at most ``reach`` away."""
        low, high = place - reach, place + reach
        i, j = bisect_left(self.every, low), bisect_right(self.every, high)
        if j - i <= len(self.classes):
            yield from (x for x in self.every[i:j] if left_of[x] != left)
            return
        for kind, held in self.classes.items():
            if kind != left:
                yield from held[bisect_left(held, low) : bisect_right(held, high)]

    def take(self, other: Places) -> None:
        for kind, held in other.classes.items():
            own = self.classes.setdefault(kind, [])
            for place in held:
                insort(own, place)
        for place in other.every:
            insort(self.every, place)


def runs_of_places(places: list[int], shared: list[int], left: list[int]) -> list[Run]:
    """The runs of one text: start, length, period, by start and period. ``places`` in the order of their suffixes,
    ``shared`` the common words of each with the one before it, ``left`` their classes."""
    left_of = dict(zip(places, left))
    found: dict[tuple[int, int], int] = {}
    stack: list[Places] = []
    depths: list[int] = []

    def close(depth: int) -> None:
        """Join the intervals that are deeper than ``depth``."""
        while depths and depths[-1] > depth:
            reach = depths.pop()
            small, large = sorted((stack.pop(), stack.pop()), key=lambda p: len(p.every))
            if len(large.classes) > 1 or len(small.classes) > 1 or large.classes.keys() != small.classes.keys():
                for kind, held in small.classes.items():
                    for place in held:
                        for other in large.others(place, kind, reach, left_of):
                            period = abs(place - other)
                            if period + reach >= LEAST:
                                stretch = (min(place, other), period + reach)
                                found[stretch] = min(period, found.get(stretch, period))
            large.take(small)
            stack.append(large)

    for place, common in zip(places, shared):
        close(max(common, GRAM - 1))
        if stack and common >= GRAM:
            depths.append(common)
        else:
            stack.clear()
        stack.append(Places(place, left_of[place]))
    close(GRAM - 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of_texts(words: np.ndarray, owner: np.ndarray) -> dict[int, list[Run]]:
    """The runs of each text that has any; words of text after text, as numbers, and the ascending numbers of their texts."""
    kept = np.isin(owner, repeating(words, owner))
    words, owner = words[kept], owner[kept]
    if not len(words):
        return {}
    levels = suffix_ranks(words, owner)
    left = left_words(words, owner)
    part = taking_part(levels, left)
    part = part[np.argsort(levels[-1][1][part], kind="stable")]
    if not len(part):
        return {}
    end = np.searchsorted(owner, owner, side="right")
    shared = np.r_[0, common_prefixes(levels, part[:-1], part[1:], end)]
    first = np.searchsorted(owner, owner, side="left")
    cuts = np.flatnonzero(np.diff(owner[part])) + 1
    out = {}
    for some, common in zip(np.split(part, cuts), np.split(shared, cuts)):
        text = int(owner[some[0]])
        places = (some - first[some]).tolist()
        runs = runs_of_places(places, [0, *common[1:].tolist()], left[some].tolist())
        if runs:
            out[text] = runs
    return out


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def judged(texts: list[str | None]) -> Iterator[tuple[int, list[Run], str]]:
    """Number of words, runs, and what is kept, of each text."""
    lists = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    counts = np.array([len(w) for w in lists], np.int64)
    coded = pa.array(chain.from_iterable(lists), pa.large_binary()).dictionary_encode()
    found = runs_of_texts(coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), counts))
    for i, own in enumerate(lists):
        runs = found.get(i, [])
        yield len(own), runs, b" ".join(kept_words(own, runs) if runs else own).decode("utf-8", "surrogatepass")


def parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Successive texts of about ``TOGETHER`` characters."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text or "")
        if n >= TOGETHER:
            yield held
            held, n = [], 0
    if held:
        yield held


def judged_column(text: Column) -> Column:
    """A struct for each text: ``n_words``, ``runs`` (by start and period) and ``kept``, the kept words
    joined by one space."""

    @F.pandas_udf(f"n_words long, runs array<{RUN}>, kept string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for some in parts(batch.tolist()):
                for n, runs, kept in judged(some):
                    rows.append((n, [{"start": s, "length": m, "period": q} for s, m, q in runs], kept))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "kept"])
        give_back()

    return judge(text)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, ``n_words``, ``runs``, ``kept``."""
    found = docs.select(F.col(f"`{key}`").alias("_key"), judged_column(F.col(f"`{text}`")).alias("_judged"))
    return found.select(F.col("_key").alias(key), "_judged.n_words", "_judged.runs", "_judged.kept")


def collapsed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each text reduced to the words that no run repeats; texts without runs stay as they are."""
    own = fresh(docs, "_judged")
    made = docs.withColumn(own, judged_column(F.col(f"`{text}`")))
    body = F.when(F.size(f"{own}.runs") > 0, F.col(f"{own}.kept")).otherwise(F.col(f"`{text}`"))
    return made.select(*(body.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns))


def with_planted_runs(text: Column, key: Column) -> Column:
    """The query's texts: in a tenth of the documents, chosen by a hash of the key, the words from a place on repeat."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.select("doc_id", with_planted_runs(F.col("text"), F.col("doc_id")).alias("text")))
    # The greatest length first, then the smallest start, then the smallest period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q")))
    )
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    top = found.select("doc_id", "runs", "kept", best.alias("best"), F.array_join(line, "").alias("lines"))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).cast("long").alias("start"),
        F.col("best.length").cast("long").alias("length"),
        (-F.col("best.q")).cast("long").alias("period"),
        F.expr("cast(1000 * cast(best.length as bigint) div -best.q as bigint)").alias("exponent_milli"),
        F.sha2(F.encode("lines", "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("kept", "utf-8"), 256).alias("collapsed_sha256"),
    )
