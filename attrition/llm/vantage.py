"""Approximate nearest neighbours by vantage-point trees, one for each shard.

A node of a tree has a vantage point and the median distance to it; the nearer half of the vectors
lies in one subtree, the rest in the other. A search goes to the side where the query lies and then,
by the triangle inequality, to the other one only if it may hold something nearer than what was
found. ``factor`` relaxes this: the other side is visited if its bound is at most ``factor`` times the
distance found. Factor one is exact; smaller ones visit less.

Rows are reduced to distinct vectors with the few smallest ids of each, which is exact, so copies of
one vector are no hot spot. Distinct vectors are dealt to shards of about ``shard_rows`` by a hash; a
tree is built in its shard's task. Queries are packed in blocks of ``block`` and every block meets
every shard, in groups of at most ``blocks_together`` blocks in one task, so a task holds one shard
and a bounded number of queries. Each task returns the nearest few distinct vectors of a query, and
the best of these are kept over all shards.

Cases: vectors that are null, zero, or hold a null or non-finite component are neither queries nor
candidates; null ids take no part; rows repeated in id and vector count once; an id with several
vectors is several candidates, and as a query is answered for each vector; ties go to the smaller
id; vectors are compared with those of their own length only; an empty table gives an empty result;
only id and vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import read, written

NEIGHBOURS, EVERY = 10, 100
SHARD_ROWS, BLOCK, BLOCKS_TOGETHER, LEAF = 4096, 1024, 16, 128


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite, not zero, nothing missing."""
    finite = F.forall(
        vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class VantageTree:
    """Rows of a matrix, in halves by their distance to vantage points."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, seed: int = 1) -> None:
        self.vectors, self.leaf = vectors, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        tried = self.rng.choice(rows, min(5, len(rows)), replace=False)
        seen = self.rng.choice(rows, min(64, len(rows)), replace=False)
        spread = [distances(self.vectors[[t]], self.vectors[seen]).std() for t in tried]
        vantage = tried[int(np.argmax(spread))]
        rest = rows[rows != vantage]
        away = distances(self.vectors[[vantage]], self.vectors[rest])[0]
        middle = float(np.median(away))
        inner, outer = rest[away <= middle], rest[away > middle]
        return vantage, middle, self._build(inner), self._build(outer)

    def nearest(self, queries: np.ndarray, k: int, factor: float = 1.0):
        """Distances and rows of the k nearest of each query, nearest first, rows ascending among
        equals; missing ones have row -1 and an infinite distance."""
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), -1)
        self.queries, self.factor = queries, factor
        self.sizes, self.squares = (queries**2).sum(1), (self.vectors**2).sum(1)
        self.visited = 0
        if len(self.vectors):
            self._visit(self.root, np.arange(len(queries)))
        return self.best, self.found

    def _offer(self, asked: np.ndarray, rows: np.ndarray) -> None:
        """Compare queries with rows. A matrix product tells which pairs can be near enough, with
        room for its rounding; only these are measured and merged."""
        self.visited += len(asked) * len(rows)
        rough = self.sizes[asked][:, None] + self.squares[rows] - 2 * (self.queries[asked] @ self.vectors[rows].T)
        room = 1e-9 * (self.sizes[asked][:, None] + self.squares[rows])
        q, r = np.nonzero(rough - room <= self.best[asked, -1][:, None] ** 2)
        if not len(q):
            return
        away = np.full(rough.shape, np.inf)
        away[q, r] = pair_distances(self.queries[asked[q]], self.vectors[rows[r]])
        some = np.unique(q)
        asked, away = asked[some], away[some]
        d = np.concatenate([self.best[asked], away], axis=1)
        r = np.concatenate([self.found[asked], np.where(away < np.inf, rows, -1)], axis=1)
        order = np.lexsort((r, d), axis=-1)[:, : self.best.shape[1]]
        self.best[asked] = np.take_along_axis(d, order, 1)
        self.found[asked] = np.take_along_axis(r, order, 1)

    def _visit(self, node, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._offer(asked, node)
            return
        vantage, middle, inner, outer = node
        self._offer(asked, np.array([vantage]))
        away = pair_distances(self.queries[asked], self.vectors[vantage])
        inside = away <= middle
        self._visit(inner, asked[inside])
        self._visit(outer, asked[~inside])
        # The slack covers rounding: a bound must never be too large.
        bound = np.abs(away - middle) * (1 - 1e-12) - 1e-12
        near = bound <= self.best[asked, -1] * self.factor
        self._visit(outer, asked[inside & near])
        self._visit(inner, asked[~inside & near])


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of ``a`` to the same rows of ``b``, from differences in double.
    Squares are added in the order of the components, so other engines get the same number."""
    return np.sqrt(np.add.accumulate((a - b) ** 2, axis=-1)[..., -1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b``."""
    return np.stack([pair_distances(x, b) for x in a]) if len(a) else np.zeros((0, len(b)))


def _matrix(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, np.float64).reshape(-1, width)


def _search(k: int, factor: float):
    def run(key: tuple, shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(asked):
            width = int(key[0])
            shard = shard.sort_values("_least", kind="stable").reset_index(drop=True)
            vectors = np.array(shard["_vector"].tolist(), np.float64).reshape(-1, width)
            tree = VantageTree(vectors)
            for numbers, packed in zip(asked["_numbers"], asked["_queries"]):
                best, found = tree.nearest(_matrix(packed, width), k, factor)
                q, r = np.nonzero(found >= 0)
                rows = found[q, r]
                out.append(
                    pd.DataFrame(
                        {
                            "_number": np.frombuffer(numbers, np.int64)[q],
                            "_ids": shard["_ids"].to_numpy()[rows],
                            "score": best[q, r],
                        }
                    )
                )
        if out:
            return pd.concat(out)
        return pd.DataFrame(
            {"_number": np.zeros(0, np.int64), "_ids": np.zeros(0, object), "score": np.zeros(0)}
        )

    return run


def _packed(block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for width, part in batch.groupby("_width", sort=True):
                for i in range(0, len(part), block):
                    some = part.iloc[i : i + block]
                    rows.append(
                        (
                            width,
                            some["_number"].to_numpy(np.int64).tobytes(),
                            np.array(some["_vector"].tolist(), np.float64).tobytes(),
                        )
                    )
            yield pd.DataFrame(rows, columns=["_width", "_numbers", "_queries"])

    return run


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block: int = BLOCK,
    blocks_together: int = BLOCKS_TOGETHER,
) -> DataFrame:
    """The k nearest rows of each row that ``is_query`` (a condition on the columns ``_id`` and ``_vector``):
    query_id, rank, vec_id, score."""
    rows = (
        vectors.select(
            F.col(f"`{key}`").cast("long").alias("_id"),
            F.col(f"`{vector}`").cast("array<double>").alias("_vector"),
        )
        .where(F.col("_id").isNotNull() & usable(F.col("_vector")))
    )
    # A query's own id may be among those of a vector, so one more is kept.
    smallest = F.row_number().over(W.partitionBy("_vector").orderBy("_id"))
    corpus = written(
        rows.distinct()
        .withColumn("_n", smallest)
        .where(F.col("_n") <= k + 1)
        .groupBy("_vector")
        .agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
        .withColumns({"_width": F.size("_vector"), "_least": F.col("_ids")[0]}),
        "distinct-vectors",
    )
    shards = max(1, -(-corpus.count() // shard_rows))
    # A number stands for a query: its id and vector.
    queries = written(
        rows.where(is_query)
        .distinct()
        .select(F.xxhash64("_id", "_vector").alias("_number"), "_id", F.size("_vector").alias("_width"), "_vector"),
        "queries",
    )
    together = blocks_together
    blocks = (
        queries.select("_width", "_number", "_vector")
        .mapInPandas(_packed(block), "_width int, _numbers binary, _queries binary")
    )
    groups = max(1, -(-queries.count() // (block * together)))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = corpus.withColumn("_shard", F.pmod(F.xxhash64("_vector"), F.lit(shards)).cast("int")).withColumn("_group", group)
    asked = blocks.withColumn("_group", F.pmod(F.xxhash64("_numbers"), F.lit(groups)).cast("int")).withColumn("_shard", every)
    found = (
        dealt.groupBy("_width", "_shard", "_group")
        .cogroup(asked.groupBy("_width", "_shard", "_group"))
        .applyInPandas(_search(k + 1, factor), "_number long, _ids array<long>, score double")
    )
    best = W.partitionBy("_number").orderBy("score", "vec_id")
    return (
        found.withColumn("vec_id", F.explode("_ids"))
        .drop("_ids")
        .join(queries.select("_number", F.col("_id").alias("query_id")), "_number")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("_id") % EVERY == 0)


ORACLE = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_sum(list_transform(range(1, len(q.e) + 1),
    lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])))) AS score
  FROM v AS q JOIN v ON q.vec_id % {EVERY} = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""
