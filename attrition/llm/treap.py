"""Ranked lexical search with K2-treaps.

Documents form shards. The grid of a shard has a row for each term, frequent terms first, and a column
for each document, in ascending order of keys; a cell holds the impact of the term in the document. The
grid is cut into four again and again. Only cells that hold anything are stored, each with the greatest
impact in it; a cell with a single posting is not cut further but holds its row and column. Cells stand
level by level, with four bits for the children that each has, so a child is found by counting bits.

An item descends along the paths of all its terms' rows jointly. A range of documents is bounded by the
sum of weight times greatest impact of the cells on the paths; the ranges with the highest bounds are
halved first, ``WIDTH`` at a time, and what cannot reach the k-th best document found so far is given up. Where
only single postings are left, the range's documents are scored exactly. So the best k are exact, ties included.

Weights need the number of documents that hold a term. It is summed over the shards' own term lists,
for the items' terms only. Items are searched in blocks of about ``BLOCK`` terms, which travel to the
tasks; each shard returns at most k documents for an item, and of these the best k are kept.

The index covers all documents and all terms. Shards hold about ``SHARD_POSTINGS`` postings; a document is never
split. Building takes one pass without a shuffle, after one that counts terms, so no key, source or group of
copies is a hot spot; the index is a Parquet table with one row for each shard, in the shared folder.

Cases: null and empty texts hold no terms and are found by no item; an item without terms, or whose
terms no document holds, has no rows; documents repeated in key are ranked one by one; documents
without a key come last among equal scores; items repeated in their key have rows of their own each;
an empty table gives an empty result; only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.common import WORD, WORD_BYTES, give_back, read, words, words_of, written
from attrition.sources.scratch import shared_dir

TOP = 20
SHARD_POSTINGS = 1_000_000
#: Characters that are counted together; a longer text is a part of its own.
TOGETHER = 1_000_000
#: Terms of all items that are searched for together.
BLOCK = 200_000
WIDTH = 256
INDEX = (
    "part int, number int, documents int, keys array<long>, terms array<string>, holders array<int>, bits int, "
    "children binary, greatest binary, rows binary, columns binary"
)
_COUNT = np.array([bin(m).count("1") for m in range(16)], np.int32)
#: By children and quadrant: how many children stand before that quadrant.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int32)
_IN_WORD = np.frombuffer(WORD_BYTES, np.uint8) != ord(" ")


# --- the grid of one shard


def spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits, each followed by a zero."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """The cells of a grid, level by level. ``children`` has four bits a cell, none for a single posting."""

    def __init__(self, bits: int, children: np.ndarray, greatest: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        self.bits, self.children, self.greatest, self.rows, self.columns = bits, children, greatest, rows, columns
        n = _COUNT[children]
        single = children == 0
        #: The first child of a cell, or the number of its posting.
        self.link = np.where(single, np.cumsum(single) - 1, 1 + np.cumsum(n) - n).astype(np.int32)

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
        """The treap of postings; no two have the same row and column."""
        most = max(int(rows.max()), int(columns.max())) if len(rows) else 0
        bits = max(1, most.bit_length())
        code = spread(rows) << np.uint64(1) | spread(columns)
        order = np.argsort(code)
        code, impacts = code[order], impacts[order].astype(np.int32)
        place = np.arange(len(code), dtype=np.int32)
        children, greatest, postings = [], [], []
        owner = np.zeros(len(code), np.int32)  # the cell of the level above, among those that are cut
        for level in range(bits + 1):
            if not len(place):
                break
            cell = code[place] >> np.uint64(2 * (bits - level))
            new = np.r_[True, cell[1:] != cell[:-1]]
            starts = np.flatnonzero(new)
            sizes = np.diff(np.r_[starts, len(place)])
            greatest.append(np.maximum.reduceat(impacts[place], starts))
            if level:
                quadrant = (cell[starts] & np.uint64(3)).astype(np.int64)
                cut = children[-1]
                cut[np.flatnonzero(cut)] = np.bincount(owner[starts], 1 << quadrant, int(owner[-1]) + 1).astype(np.uint8)
            postings.append(place[starts[sizes == 1]])
            # A mark for now; the children come with the next level.
            children.append((sizes > 1).astype(np.uint8))
            inner = np.repeat(sizes > 1, sizes)
            owner = (np.cumsum(new & inner, dtype=np.int32) - 1)[inner]
            place = place[inner]
        at = order[np.concatenate([*postings, np.zeros(0, np.int64)])]
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        return Treap(bits, join(children, np.uint8), join(greatest, np.int32), rows[at].astype(np.int32), columns[at].astype(np.int32))

    def search(self, rows: np.ndarray, weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` columns with the highest sums of weight times impact above 0, and these sums, highest first,
        equal ones by column. A range of columns has a first column, a level, a bound, and a stretch of
        ``cell`` and ``term``: the cells on the paths of those terms that the range holds."""
        found, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.children) or not len(rows):
            return found, sums
        term = np.arange(len(rows)) if self.children[0] else np.flatnonzero(rows == self.rows[0])
        cell = np.zeros(len(term), np.int32)
        size, start, level = np.array([len(term)]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = self._bounds(cell, term, size, weights)
        while (able := self._able(bound, start, found, sums, top)).any():
            first = np.flatnonzero(able)
            first = first[np.lexsort((start[first], -bound[first]))]
            now, later = first[:WIDTH], np.sort(first[WIDTH:])
            own, rest = _stretches(size, now), _stretches(size, later)
            state = cell[rest], term[rest], size[later], start[later], level[later], bound[later]
            cell, term, size, start, level = cell[own], term[own], size[now], start[now], level[now]
            owner = np.repeat(np.arange(len(size)), size)
            more = np.bincount(owner, self.children[cell] > 0, len(size)) > 0
            if not more.all():
                found, sums = self._scored(cell[~more[owner]], term[~more[owner]], weights, found, sums, top)
                cell, term = cell[more[owner]], term[more[owner]]
                size, start, level = size[more], start[more], level[more]
            halves = [state]
            for side, (child, held, n) in enumerate(self._halves(cell, term, size, level, rows)):
                there = n > 0
                halves.append((
                    child, held, n[there], (start + side * (np.int64(1) << (self.bits - 1 - level)))[there],
                    level[there] + 1, self._bounds(child, held, n[there], weights),
                ))
            cell, term, size, start, level, bound = map(np.concatenate, zip(*halves))
        return found, sums

    def _bounds(self, cell: np.ndarray, term: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sum for each stretch, none of which is empty."""
        each = self.greatest[cell] * weights[term]
        return np.add.reduceat(each, np.cumsum(size) - size) if len(each) else np.zeros(len(size), np.int64)

    @staticmethod
    def _able(bound: np.ndarray, start: np.ndarray, found: np.ndarray, sums: np.ndarray, top: int) -> np.ndarray:
        """Which ranges may hold one of the best."""
        if len(found) < top:
            return bound > 0
        return (bound > sums[-1]) | (bound == sums[-1]) & (start < found[-1])

    def _halves(
        self, cell: np.ndarray, term: np.ndarray, size: np.ndarray, level: np.ndarray, rows: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each half of the columns: the cells on the paths, their terms, and how many each range has."""
        owner = np.repeat(np.arange(len(size)), size)
        shift = (self.bits - 1 - level)[owner]
        children, link, row = self.children[cell], self.link[cell], rows[term]
        single = children == 0
        left = (row >> shift & 1) * 2
        child = np.where(single, cell, link + _BEFORE[children, left])
        right_column = single & (self.columns[np.where(single, link, 0)] >> shift & 1 > 0)
        in_left = np.where(single, ~right_column, children >> left & 1 > 0)
        in_right = np.where(single, right_column, children >> left & 2 > 0)
        for there, own in ((in_left, child), (in_right, child + (in_left & ~single))):
            own, held, of, wanted = own[there], term[there], owner[there], row[there]
            # A single posting belongs to the path if it is in the row.
            at = np.flatnonzero(self.children[own] == 0)
            stray = at[self.rows[self.link[own[at]]] != wanted[at]]
            if len(stray):
                own, held, of = (np.delete(x, stray) for x in (own, held, of))
            yield own, held, np.bincount(of, minlength=len(size))

    def _scored(
        self, cell: np.ndarray, term: np.ndarray, weights: np.ndarray, found: np.ndarray, sums: np.ndarray, top: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The best of those found and of the documents in ranges where only single postings are left."""
        column, place = np.unique(self.columns[self.link[cell]], return_inverse=True)
        score = np.zeros(len(column), np.int64)
        np.add.at(score, place, self.greatest[cell] * weights[term])
        found, sums = np.concatenate([found, column.astype(np.int64)]), np.concatenate([sums, score])
        best = np.lexsort((found, -sums))[:top]
        best = best[sums[best] > 0]
        return found[best], sums[best]


def _stretches(size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Where the members of the chosen stretches stand."""
    n = size[chosen]
    begin = (np.cumsum(size) - size)[chosen]
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


# --- the index


@F.pandas_udf(T.LongType())
def term_counts(text: pd.Series) -> pd.Series:
    """How many terms each text has."""

    def count(text: str | None) -> int:
        if not text:
            return 0
        inside = _IN_WORD[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
        return int(inside[0]) + int(np.count_nonzero(inside[1:] & ~inside[:-1]))

    return pd.Series([count(t) for t in text], dtype="int64")


def impact(tf: np.ndarray, n: np.ndarray, documents: int, every: int) -> np.ndarray:
    """What an occurrence counts, in integers: more for frequent terms, less in long documents."""
    m = 100 - 25 + (25 * n * documents) // max(every, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class _Shard:
    """Postings of documents, part by part."""

    def __init__(self) -> None:
        self.keys: list[int | None] = []
        self.terms: list[pa.Array] = []
        self.codes: list[np.ndarray] = []  # term in its part, document, occurrences
        self.lengths: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: list, texts: list[str | None]) -> None:
        lists = [words_of(t) for t in texts]
        counts = np.array([len(w) for w in lists], np.int64)
        coded = pa.array(chain.from_iterable(lists), pa.large_binary()).dictionary_encode()
        document = np.repeat(np.arange(len(lists)), counts)
        both = document * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
        pairs, tf = np.unique(both, return_counts=True)
        document, term = np.divmod(pairs, max(len(coded.dictionary), 1))
        self.codes.append(np.stack([term, document + len(self.keys), tf]).astype(np.int32))
        self.terms.append(coded.dictionary)
        self.lengths.append(counts)
        self.keys += keys
        self.size += len(pairs)

    def row(self, part: int, number: int, documents: int, every: int) -> tuple:
        merged = pa.chunked_array(self.terms, pa.large_binary()).combine_chunks()
        coded = (merged if isinstance(merged, pa.Array) else merged.chunk(0)).dictionary_encode()
        offsets = np.cumsum([0, *map(len, self.terms)])
        codes = coded.indices.to_numpy()
        term = np.concatenate([codes[o + c[0]] for o, c in zip(offsets, self.codes)])
        document = np.concatenate([c[1] for c in self.codes])
        tf = np.concatenate([c[2] for c in self.codes])
        self.codes.clear()
        # Columns ascend by key, documents without one come last; rows go from the most frequent term to the rarest.
        order = sorted(range(len(self.keys)), key=lambda i: (self.keys[i] is None, self.keys[i] or 0))
        column = np.empty(len(order), np.int32)
        column[order] = np.arange(len(order))
        holders = np.bincount(term, minlength=len(coded.dictionary))
        by = np.argsort(-holders, kind="stable")
        row = np.empty(len(by), np.int32)
        row[by] = np.arange(len(by))
        lengths = np.concatenate(self.lengths)
        impacts = impact(tf.astype(np.int64), lengths[document], documents, every).astype(np.int32)
        del tf
        grid = Treap.of(row[term], column[document], impacts)
        return (
            part, number, int((lengths > 0).sum()), [self.keys[i] for i in order],
            [t.decode("utf-8", "surrogatepass") for t in coded.dictionary.take(pa.array(by)).to_pylist()], holders[by].tolist(),
            grid.bits, grid.children.tobytes(), grid.greatest.astype("<i4").tobytes(),
            grid.rows.astype("<i4").tobytes(), grid.columns.astype("<i4").tobytes(),
        )


def _indexed(documents: int, every: int, shard_postings: int):
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            keys = [None if null else int(k) for k, null in zip(batch["_key"], batch["_null"])]
            texts, first, held = batch["_text"].tolist(), 0, 0
            for i, text in enumerate(texts):
                held += len(text or "")
                if held < TOGETHER and i + 1 < len(texts):
                    continue
                shard.add(keys[first : i + 1], texts[first : i + 1])
                first, held = i + 1, 0
                if shard.size >= shard_postings:
                    yield pd.DataFrame([shard.row(part, number, documents, every)], columns=names)
                    number, shard = number + 1, _Shard()
        if shard.size:
            yield pd.DataFrame([shard.row(part, number, documents, every)], columns=names)
        give_back()

    return run


def build_index(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shard_postings: int = SHARD_POSTINGS, path: str | None = None
) -> DataFrame:
    """Write the index of all documents to the shared folder, or to ``path``, and return the table read from it."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    n = docs.select(term_counts(body).alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    name = F.col(f"`{key}`").cast("long")
    rows = docs.select(F.coalesce(name, F.lit(0)).alias("_key"), name.isNull().alias("_null"), body.alias("_text"))
    path = path or shared_dir(spark, "search-index")
    made = rows.mapInPandas(_indexed(int(n[0]), int(n[1] or 0), shard_postings), INDEX)
    # A file for each shard, so that a task reads few of them at a time.
    made.write.option("maxRecordsPerFile", 1).parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def term_weights(index: DataFrame, terms: DataFrame, documents: int) -> DataFrame:
    """``_term`` and ``_weight`` of those ``terms`` that any document holds."""
    lists = index.select(F.explode(F.arrays_zip("terms", "holders")).alias("_t"))
    held = lists.select(F.col("_t.terms").alias("_term"), F.col("_t.holders").alias("_n"))
    counts = held.join(terms, "_term", "left_semi").groupBy("_term").agg(F.sum("_n").alias("_df"))
    ratio = F.lit(2.0 * documents + 2) / (2 * F.col("_df") + 1)
    return counts.select("_term", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("_weight"))


def _searched(wanted, top: int):
    """``wanted`` has the terms of a block, and for each item the places of its terms and their weights."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, items = wanted.value
        for batch in batches:
            for shard in batch.itertuples(index=False):
                place = pc.index_in(pa.array(terms, pa.string()), value_set=pa.array(shard.terms, pa.string()))
                place = place.fill_null(-1).to_numpy()
                grid = Treap(
                    shard.bits, np.frombuffer(shard.children, np.uint8), np.frombuffer(shard.greatest, "<i4"),
                    np.frombuffer(shard.rows, "<i4"), np.frombuffer(shard.columns, "<i4"),
                )
                out: list[tuple] = []
                for item, own, weights in items:
                    rows = place[own]
                    columns, sums = grid.search(rows[rows >= 0].astype(np.int64), weights[rows >= 0], top)
                    out += ((item, shard.keys[c], s) for c, s in zip(columns.tolist(), sums.tolist()))
                frame = pd.DataFrame(out, columns=["_item", "_key", "score"])
                missing = frame["_key"].isna()
                frame["_key"] = pd.array([None if m else int(k) for k, m in zip(frame["_key"], missing)], dtype="Int64")
                yield frame
        give_back()

    return run


def search(
    index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", top: int = TOP, found: str = "doc_id"
) -> DataFrame:
    """The best ``top`` documents of each item: key, rank, ``found`` (the document's key), score."""
    spark = index.sparkSession
    listed = items.select(
        F.monotonically_increasing_id().alias("_item"), F.col(f"`{key}`").alias("_name"), words(F.col(f"`{text}`")).alias("_words")
    )
    listed = written(listed, "search-items")
    terms = listed.select("_item", F.explode("_words").alias("_term")).groupBy("_item", "_term").agg(F.count("*").alias("_times"))
    n = index.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    weights = term_weights(index, terms.select("_term").distinct(), n)
    wanted = written(
        terms.join(weights, "_term").select("_item", "_term", (F.col("_weight") * F.col("_times")).alias("_factor")), "search-terms"
    )
    blocks = -(-wanted.count() // BLOCK)
    best = spark.createDataFrame([], "_item long, _key long, score long")
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(_grouped(own.toPandas()))
        best = best.unionByName(index.mapInPandas(_searched(sent, top), "_item long, _key long, score long"))
    order = W.partitionBy("_item").orderBy(F.desc("score"), F.col("_key").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(listed.select("_item", "_name"), "_item").select(
        F.col("_name").alias(key), "rank", F.col("_key").alias(found), "score"
    )


def _grouped(table: pd.DataFrame) -> tuple[list[str], list[tuple[int, np.ndarray, np.ndarray]]]:
    terms, place = np.unique(table["_term"].to_numpy(object), return_inverse=True)
    table = table.assign(_place=place).sort_values(["_item", "_place"])
    items = [
        (int(item), rows["_place"].to_numpy(np.int64), rows["_factor"].to_numpy(np.int64))
        for item, rows in table.groupby("_item", sort=True)
    ]
    return terms.tolist(), items


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return search(index, read(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
q AS MATERIALIZED (SELECT item_id, term, count(*)::BIGINT AS times FROM
  (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')) AS term FROM benchmark) GROUP BY ALL),
t AS MATERIALIZED (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
s AS MATERIALIZED (SELECT count_if(len(w) > 0)::BIGINT AS n, coalesce(sum(len(w)), 0)::BIGINT AS l FROM d),
f AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM t, s GROUP BY term, n),
m AS (SELECT r, doc_id, (100 - 25 + (25 * len(w)::BIGINT * n) // greatest(l, 1)) AS m FROM d, s),
x AS (SELECT item_id, doc_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY item_id, doc_id, r),
y AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM y WHERE rank <= {TOP}
"""
