"""Approximate nearest neighbours by hash tables of random projections.

A table cuts ``depth`` random directions into intervals of one width; rows in the same intervals share a
bucket. A query looks into its own bucket of each table and into the buckets most likely to hold its
neighbours beyond the nearest borders (multi-probe), so few tables are needed.

Depth, width, number of tables and of probes are chosen from the data: for a sample of at most
``SAMPLE_QUERIES`` queries the true neighbours in the whole corpus are found, and of all settings that would have
found ``aim`` of them the one with the least work is taken. What the result holds is measured the same way
by its users: :func:`recall`.

Buckets meet their queries by a shuffle on the bucket. Which buckets a row needs is settled with row numbers alone; then its
vector goes once to each of them, in the type it was given in. A bucket with more rows than a block or more queries than a
chunk is dealt to several tasks, each with one bounded part of both, so a bucket with a third of all rows is no hot
spot. A task passes through sorted rows and holds one block at a time. Distances are computed on the
original vectors. A query that meets fewer than ``k`` rows is answered by the exact search.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.operators.neighbors import (
    BLOCK_ROWS,
    CHUNK_ROWS,
    _distances,
    _drop_far_copies,
    _matrix,
    _top_k,
    knn,
)
from attrition.sources.scratch import cut_lineage

SAMPLE_QUERIES, SAMPLE_ROWS = 128, 2048
DEPTHS, WIDTHS = (1, 2, 3, 4, 6, 8, 12), (0.5, 1.0, 2.0, 4.0)
MOST_TABLES, MOST_PROBES = 16, 32
#: What a bucket that a query looks into costs, in rows compared.
PROBE_COST = 20.0


def probe_sets(depth: int, most: int) -> list[tuple[int, ...]]:
    """Which of the ``2 * depth`` interval borders, ranked by their distance from the query, to cross: the ``most``
    sets with the least expected sum of squared distances, the empty one first. Ranks r and
    ``2 * depth - 1 - r`` are the two borders of one interval and are never crossed together."""
    n = 2 * depth
    expected = [
        (j * (j + 1)) / (4 * (depth + 1) * (depth + 2))
        if j <= depth
        else 1 - (n + 1 - j) / (depth + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (depth + 1) * (depth + 2))
        for j in range(1, n + 1)
    ]
    sets: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(sets) < most:
        _, ranks = heapq.heappop(heap)
        if all(n - 1 - r not in ranks for r in ranks):
            sets.append(ranks)
        last = ranks[-1] + 1
        if last < n:
            for following in ((*ranks[:-1], last), (*ranks, last)):
                heapq.heappush(heap, (sum(expected[r] for r in following), following))
    return sets


@dataclass
class HashTables:
    """Directions by table, depth and dimension, offsets in widths, and one factor for each interval number."""

    directions: np.ndarray
    offsets: np.ndarray
    factors: np.ndarray
    width: float
    probes: int

    @staticmethod
    def drawn(tables: int, depth: int, dimensions: int, width: float, probes: int, seed: int) -> HashTables:
        rng = np.random.default_rng((seed, depth))
        directions = rng.normal(size=(MOST_TABLES, depth, dimensions))[:tables]
        offsets = rng.random((MOST_TABLES, depth))[:tables]
        factors = rng.integers(1, 2**63, (MOST_TABLES, depth), dtype=np.uint64)[:tables] | np.uint64(1)
        return HashTables(directions, offsets, factors, width, probes)

    def _intervals(self, vectors: np.ndarray) -> np.ndarray:
        return np.einsum("nd,tmd->ntm", vectors, self.directions) / self.width + self.offsets

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        numbers = np.floor(self._intervals(vectors)).astype(np.int64).view(np.uint64)
        return (numbers * self.factors).sum(axis=2, dtype=np.uint64).view(np.int64)

    def probed(self, vectors: np.ndarray) -> np.ndarray:
        """The buckets that each row looks into: by row, table and probe."""
        place = self._intervals(vectors)
        own = np.floor(place)
        depth = own.shape[2]
        below = place - own
        border = np.concatenate([below, 1 - below], axis=2)
        order = np.argsort(border, axis=2, kind="stable")
        factors = np.broadcast_to(self.factors, own.shape)
        # Crossing the lower border takes one interval away, the upper one adds one.
        step = np.concatenate([np.uint64(0) - factors, factors], axis=2)
        ranked = np.take_along_axis(step, order, axis=2)
        home = (own.astype(np.int64).view(np.uint64) * self.factors).sum(axis=2, dtype=np.uint64)
        sets = probe_sets(depth, self.probes)
        out = np.empty((*home.shape, len(sets)), np.uint64)
        for i, ranks in enumerate(sets):
            out[:, :, i] = home + ranked[:, :, list(ranks)].sum(axis=2, dtype=np.uint64)
        return out.view(np.int64)


def choose_tables(
    queries: np.ndarray, neighbours: list[np.ndarray], others: np.ndarray, n: int, aim: float, seed: int
) -> HashTables:
    """The setting with the least work among those that find ``aim`` of the sample's ``neighbours``; ``others`` are rows
    of the corpus, to see how many a bucket holds. If none does, the one that finds most of them."""
    pairs = np.repeat(np.arange(len(queries)), [len(x) for x in neighbours])
    near = np.concatenate(neighbours)
    scale = float(np.median(_distances(queries, others).min(axis=1))) or 1.0
    few, some = queries[:16], others[:512]
    best = None
    for depth in DEPTHS:
        for factor in WIDTHS:
            tables = HashTables.drawn(MOST_TABLES, depth, queries.shape[1], factor * scale, MOST_PROBES, seed)
            looked = tables.probed(queries)
            hit = (looked[pairs] == tables.buckets(near)[:, :, None]).cumsum(axis=2) > 0
            met = (looked[: len(few), None] == tables.buckets(some)[None, :, :, None]).cumsum(axis=3).mean(axis=(0, 1))
            for t in (1, 2, 4, 8, MOST_TABLES):
                for p in (1, 2, 4, 8, 16, MOST_PROBES):
                    p = min(p, looked.shape[2])
                    share = hit[:, :t, p - 1].any(axis=1).mean()
                    work = n * met[:t, p - 1].sum() + PROBE_COST * t * p
                    rank = (share < aim, work if share >= aim else -share, work)
                    if best is None or rank < best[0]:
                        best = (rank, t, depth, factor * scale, p)
    _, t, depth, width, p = best
    return HashTables.drawn(t, depth, queries.shape[1], width, p, seed)


def _sampled(df: DataFrame, most: int) -> DataFrame:
    """The rows with the smallest hashes, at most ``most``."""
    return df.select("id", "vec", F.xxhash64("id", F.lit(7)).alias("h")).orderBy("h").limit(most).select("id", "vec")


def knn_approximate(
    query: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = False,
    carry: Sequence[str] = (),
    aim: float = 0.97,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    tables: HashTables | None = None,
) -> DataFrame:
    """About ``aim`` of the ``k`` nearest corpus rows of each query row: (src, dst, dist, rank, *carry).

    Every query gets ``k`` rows if the corpus has them, with exact distances; equal ones rank by smaller id.
    ``tables`` replaces the choice from the data. Rows without vector are left out."""
    spark = query.sparkSession
    # Single precision is kept: it has half the bytes, and tasks compute in double precision.
    kind = lambda df: "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    same = "array<float>" if kind(query) == kind(corpus) == "array<float>" else "array<double>"
    vectors = [F.col(id_col).alias("id"), F.col(vector_col).cast(same).alias("vec")]
    queries = query.select(*vectors).filter(F.col("vec").isNotNull())
    rows = corpus.select(*vectors, *carry).filter(F.col("vec").isNotNull())
    n = rows.count()
    if tables is None:
        sample = cut_lineage(_sampled(queries, SAMPLE_QUERIES))
        found = knn(
            sample, rows.select("id", "vec", F.col("vec").alias("near")), k, "id", "vec", exclude_self,
            carry=["near"], block_rows=block_rows, chunk_rows=chunk_rows,
        ).toPandas()
        wanted = sample.toPandas()
        if found.empty:
            return knn(query, corpus, k, id_col, vector_col, exclude_self, carry, None, block_rows, chunk_rows)
        near = {src: _matrix(part["near"]) for src, part in found.groupby("src")}
        wanted = wanted[wanted["id"].isin(near)]
        tables = choose_tables(
            _matrix(wanted["vec"]), [near[i] for i in wanted["id"]], _matrix(_sampled(rows, SAMPLE_ROWS).toPandas()["vec"]), n, aim, seed
        )
    shared = spark.sparkContext.broadcast(tables)
    rows = _drop_far_copies(rows, k + 1 if exclude_self else k)

    def hashed(probe: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    matrix = _matrix(batch["vec"])
                    found = shared.value.probed(matrix) if probe else shared.value.buckets(matrix)
                    yield pd.DataFrame({"row": batch["row"], "buckets": [np.unique(b) for b in found.reshape(len(batch), -1)]})

        return run

    def numbered(df: DataFrame) -> DataFrame:
        return cut_lineage(df.withColumn("row", F.monotonically_increasing_id()))

    def with_buckets(df: DataFrame, probe: bool) -> DataFrame:
        made = df.select("row", "vec").mapInPandas(hashed(probe), "row bigint, buckets array<bigint>")
        return cut_lineage(made.select("row", F.explode("buckets").alias("bucket")))

    # Ids may repeat or be missing; rows are told apart by a number of their own, written with them.
    asked, known = numbered(queries), numbered(rows.select("id", "vec"))
    queries = asked.select("id", "vec")
    left, right = with_buckets(asked, True), with_buckets(known, False)
    # Buckets without either side go here, before any vector is shuffled.
    sizes = (
        left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_queries"))
        .join(right.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows")), "bucket")
        .select(
            "bucket",
            F.ceil(F.col("n_queries") / chunk_rows).cast("int").alias("pieces"),
            F.ceil(F.col("n_rows") / block_rows).cast("int").alias("parts"),
        )
    )
    cell = F.xxhash64("bucket", "part", "piece").alias("cell")
    left = left.join(sizes, "bucket").join(asked, "row").select(
        "*", F.pmod(F.xxhash64("id", F.lit(1)), "pieces").cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    ).select(cell, F.lit(1).alias("side"), "id", "vec")
    right = right.join(sizes, "bucket").join(known, "row").select(
        "*", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
    ).select(cell, F.lit(0).alias("side"), "id", "vec")
    kind_q, kind_c = (df.schema[id_col].dataType.simpleString() for df in (query, corpus))
    met = (
        left.unionByName(right)
        .repartition("cell")
        .sortWithinPartitions("cell", "side")
        .mapInPandas(_compared(k, exclude_self), f"src {kind_q}, dst {kind_c}, dist double")
    )
    order = W.partitionBy("src").orderBy("dist", "dst")
    # A pair that met in several buckets has one rank.
    best = met.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
    best = cut_lineage(best.dropDuplicates(["src", "dst"]))
    # Queries that met too few rows; the exact search has no such case.
    enough = best.groupBy("src").count().filter(F.col("count") >= k)
    short = queries.join(enough, F.col("id") == F.col("src"), "left_anti")
    if short.isEmpty():
        found = best
    else:
        rest = knn(short, known.select("id", "vec"), k, "id", "vec", exclude_self, block_rows=block_rows, chunk_rows=chunk_rows)
        found = best.join(enough, "src", "left_semi").unionByName(rest)
    if carry:
        names = rows.select(F.col("id").alias("dst"), *carry)
        found = found.join(names, "dst")
    return found.select("src", "dst", "dist", "rank", *carry)


def _compared(k: int, exclude_self: bool):
    """Rows come ordered by cell, the corpus rows of a cell first; a cell may span batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []

        def against(part: pd.DataFrame) -> pd.DataFrame:
            own = pd.concat(held, ignore_index=True)
            q_ids, c_ids = part["id"].to_numpy(), own["id"].to_numpy()
            a, b, dist = _top_k(q_ids, _matrix(part["vec"]), c_ids, _matrix(own["vec"]), k, exclude_self, None)
            return pd.DataFrame({"src": q_ids[a], "dst": c_ids[b], "dist": dist})

        for batch in batches:
            out = []
            for (key, side), part in batch.groupby(["cell", "side"], sort=True):
                if key != cell:
                    cell, held = key, []
                if side == 0:
                    held.append(part)
                elif held:
                    out.append(against(part))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours wanted, how many of them were found, and their share. What is found counts by distance,
    so that another row at the same distance is no miss."""
    # Written once: two joins read it, and the exact search is behind it.
    furthest = cut_lineage(exact.groupBy("src").agg(F.max("dist").alias("far"), F.count(F.lit(1)).alias("n")))
    hits = found.join(furthest, "src").filter(F.col("dist") <= F.col("far") * (1 + 1e-9)).groupBy("src")
    hits = hits.agg(F.count(F.lit(1)).alias("hits"))
    each = furthest.join(hits, "src", "left")
    return each.agg(
        F.sum("n").alias("n_wanted"), F.coalesce(F.sum(F.least("hits", "n")), F.lit(0)).alias("n_found")
    ).withColumn("recall", F.try_divide("n_found", "n_wanted"))
