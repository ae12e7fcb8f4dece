"""Exact nearest neighbours by Euclidean distance, without comparing every pair of blocks.

The corpus is cut into cells around pivot vectors, and cells that are larger than a block into cells around
pivots of their own. The upper pivots are few and travel with the tasks; the lower ones, whose number
grows with the corpus, meet their cell's rows and queries by a shuffle. What is still larger than a
block, such as a clump of rows, is dealt by hash. A query first searches the block at its nearest pivots; the k-th
distance found there bounds the answer. The triangle inequality then tells, on both levels, which other blocks can
hold anything nearer, and only those are searched. Each task compares one bounded block with one bounded chunk of queries and
returns at most k rows per query, so neither a block, nor a popular cell, nor a popular vector
has to fit anywhere as a whole.

Where the cells rule out little, a query would be sent to most blocks, and what is shuffled would grow with the square of the
rows. Then the corpus goes to the queries instead: in rounds of one bounded slab, which travels with the tasks, while each
task passes through its own queries. A slab is cut into small tiles of rows that lie together, so that a query
meets only the tiles within its reach; single precision rules out most pairs there, with a margin for its error, and the others are
measured in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.sources.scratch import cut_lineage

BLOCK_ROWS = 16_384
CHUNK_ROWS = 16_384
MAX_PIVOTS = 1024
#: Pivots of one cell, and rows of it that one task compares with them.
LOWER_PIVOTS, LOWER_ROWS = 512, 65_536
PIVOT_BYTES = 32 * 2**20
SLICE_CELLS = 1_000_000
ROUTED_ROWS = 50_000
#: Blocks that a query may be sent to on average, before slabs are sent to the queries instead; and what a round of these costs a
#: query, in rows of blocks compared.
MOST_BLOCKS, ROUND_COST = 4, 1000
#: Bytes of a slab's vectors, rows of a tile, queries that are compared with it at a time, and pairs that a task holds before it
#: measures them.
SLAB_BYTES, TILE_ROWS, QUERIES, HELD_PAIRS = 32 * 2**20, 512, 2048, 200_000


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.to_list(), dtype=np.float64)


def _norms(differences: np.ndarray, groups: int) -> np.ndarray:
    """Length along the last axis: Euclidean, or of the sums of absolute values of each ``groups`` entries."""
    if groups > 1:
        differences = np.abs(differences).reshape(*differences.shape[:-1], -1, groups).sum(axis=-1)
    return np.sqrt((differences**2).sum(axis=-1))


def _distances(a: np.ndarray, b: np.ndarray, groups: int = 1) -> np.ndarray:
    """Distances by differences (no cancellation), in slices of bounded size."""
    out = np.empty((len(a), len(b)))
    step = max(1, SLICE_CELLS // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = _norms(a[i : i + step, None, :] - b[None, :, :], groups)
    return out


class _Cells:
    """Pivots with what is known of their cells; small enough to travel with each task."""

    def __init__(self, pivots: np.ndarray, stats: pd.DataFrame, groups: int = 1):
        self.pivots, self.groups = pivots, groups
        self.counts = np.zeros(len(pivots), dtype=np.int64)
        self.near = np.full(len(pivots), np.inf)
        self.far = np.full(len(pivots), -np.inf)
        at = stats["cell"].to_numpy()
        self.counts[at] = stats["n"].to_numpy()
        self.near[at] = stats["near"].to_numpy()
        self.far[at] = stats["far"].to_numpy()
        self.between = _distances(pivots, pivots, groups)

    def home(self, to_pivot: np.ndarray, k: int) -> np.ndarray:
        """Mask of cells searched first: the nearest ones until k rows are expected."""
        order = np.argsort(to_pivot, axis=1, kind="stable")
        expected = self.counts[order]
        taken = (np.cumsum(expected, axis=1) - expected < k) & (expected > 0)
        mask = np.zeros_like(taken)
        np.put_along_axis(mask, order, taken, axis=1)
        return mask

    def within(self, to_pivot: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Mask of cells that may hold a row within reach."""
        return (self.lower_bound(to_pivot) <= reach[:, None]) & (self.counts > 0)

    def lower_bound(self, to_pivot: np.ndarray) -> np.ndarray:
        """Least possible distance of a query to any row of each cell."""
        ring = np.maximum(to_pivot - self.far, self.near - to_pivot)
        if self.groups > 1:  # the rest holds for Euclidean distances
            return np.maximum(ring, 0.0)
        nearest = to_pivot.argmin(axis=1)
        apart = self.between[nearest]
        base = np.take_along_axis(to_pivot, nearest[:, None], axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 0, (to_pivot**2 - base**2) / (2 * apart), 0.0)
        return np.maximum(np.maximum(ring, plane), 0.0)


def _least_share(q: np.ndarray, c: np.ndarray, groups: int) -> float:
    """The squared distance by groups is at least so many squared Euclidean ones: a sum of absolute values is no less than the
    root of the sum of squares, and no less than the root of twice that where the differences cancel out, as those of shares do."""
    sums = np.concatenate([v.reshape(len(v), -1, groups).sum(axis=-1) for v in (q, c)])
    return 2.0 if len(sums) and np.ptp(sums, axis=0).max() <= 1e-12 else 1.0


def _top_k(q_ids, q, c_ids, c, k: int, exclude_self: bool, digits: int | None, groups: int = 1):
    """(query position, corpus position, distance) of the k nearest, ties to the smaller id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    c_norm = (c**2).sum(axis=1)
    step = max(1, SLICE_CELLS // max(1, len(c)))
    least = _least_share(q, c, groups) if groups > 1 else 1.0
    found = []
    for i in range(0, len(q), step):
        part = q[i : i + step]
        q_norm = (part**2).sum(axis=1)
        squared = part @ c.T
        squared *= -2
        squared += q_norm[:, None]
        squared += c_norm[None, :]
        np.maximum(squared, 0.0, out=squared)
        if exclude_self:
            squared[q_ids[i : i + step, None] == c_ids[None, :]] = np.inf
        if squared.shape[1] <= k:
            kth = np.full(len(part), np.finfo(float).max)
        elif groups == 1:
            kth = np.partition(squared, k - 1, axis=1)[:, k - 1]
        else:
            # No k-th neighbour is farther than the farthest of k rows, such as those nearest by Euclidean distance.
            some = np.argpartition(squared, k - 1, axis=1)[:, :k]
            kth = np.concatenate(
                [_norms(part[j : j + 256, None, :] - c[some[j : j + 256]], groups).max(axis=1) for j in range(0, len(part), 256)]
            ) ** 2
            kth[np.isinf(np.take_along_axis(squared, some, axis=1)).any(axis=1)] = np.finfo(float).max
            squared *= least
        # The product form is inexact: keep a margin, then measure the few survivors by differences.
        margin = 1e-9 * (q_norm + c_norm.max())
        if digits is not None:
            margin = margin + (np.sqrt(np.minimum(kth, 1e300)) + 10.0**-digits) * 4 * 10.0**-digits
        limit = np.where(kth >= np.finfo(float).max, kth, kth + margin)
        rows, cols = np.nonzero(squared <= limit[:, None])
        dist = np.empty(len(rows))
        pairs = max(1, SLICE_CELLS // q.shape[1])
        for j in range(0, len(rows), pairs):
            r, s = rows[j : j + pairs], cols[j : j + pairs]
            dist[j : j + pairs] = _norms(part[r] - c[s], groups)
        if digits is not None:
            dist = np.round(dist, digits)
        by = np.lexsort((c_ids[cols], dist, rows))
        rows, cols, dist = rows[by], cols[by], dist[by]
        starts = np.searchsorted(rows, rows, side="left")
        keep = np.arange(len(rows)) - starts < k
        found.append((rows[keep] + i, order[cols[keep]], dist[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _slices(batches: Iterator[pd.DataFrame], targets: int) -> Iterator[pd.DataFrame]:
    """Queries in pieces so small that they make at most ``ROUTED_ROWS`` rows, even if each is sent
    to all ``targets``."""
    step = max(1, ROUTED_ROWS // max(1, targets))
    for batch in batches:
        for i in range(0, len(batch), step):
            yield batch.iloc[i : i + step].reset_index(drop=True)


def _drop_far_copies(corpus: DataFrame, k: int) -> DataFrame:
    """Of equal vectors only the k smallest ids can be among the k nearest of anything. The row
    limit is applied before the shuffle too, so a vector with very many copies stays cheap."""
    rank = F.row_number().over(W.partitionBy("vec").orderBy("id"))
    return corpus.withColumn("copy", rank).filter(F.col("copy") <= k).drop("copy")


def knn(
    query: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = False,
    carry: Sequence[str] = (),
    digits: int | None = None,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    work: list[int] | None = None,
    pivots: int = MAX_PIVOTS,
    groups: int = 1,
) -> DataFrame:
    """``k`` nearest corpus rows of each query row: (src, dst, dist, rank, *carry).

    Equal distances rank by smaller id; with ``digits``, distances are rounded before ranking.
    ``carry`` names corpus columns to return with each neighbour. Rows without vector are left out.
    Ids of query rows must be unique: rows that share one share an answer. ``work``, if given, is
    told how many pairs the first and the second search compare. ``pivots`` bounds those of the upper level.
    With ``groups``, each so many entries of a vector are one coordinate, in which two rows differ by the sum
    of their absolute differences; the distance is the root of the sum of squares of that.
    """
    spark = query.sparkSession
    keep = k + 1 if exclude_self else k
    queries = query.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec")).filter(
        F.col("vec").isNotNull()
    )
    rows = corpus.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), *carry
    ).filter(F.col("vec").isNotNull())
    size = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct(F.xxhash64("vec")).alias("distinct"),
        F.max(F.size("vec")).alias("width"),
    ).first()
    n, width = size["n"], size["width"] or 1
    if size["distinct"] < 0.8 * n:
        rows = _drop_far_copies(rows, keep)

    found_ddl = f"src {query.schema[id_col].dataType.simpleString()}, dst {corpus.schema[id_col].dataType.simpleString()}, dist double"
    n_queries = queries.count()

    # Written rows are told apart by a number of their own; what is carried joins the nearest ones by it.
    taken = ["_row"]

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ["src", "dst", "dist", *taken]}, dtype=object)
        q_ids, c_ids = left["id"].to_numpy(), right["id"].to_numpy()
        a, b, dist = _top_k(
            q_ids, _matrix(left["vec"]), c_ids, _matrix(right["vec"]), k, exclude_self, digits, groups
        )
        return pd.DataFrame(
            {"src": q_ids[a], "dst": c_ids[b], "dist": dist}
            | {c: right[c].to_numpy()[b] for c in taken}
        )

    def search(routed: DataFrame, blocks: DataFrame) -> DataFrame:
        """Compare the queries sent to each block with its rows, in bounded pieces."""
        # So many pieces of all blocks together that every core has one.
        chunk = min(chunk_rows, max(256, math.ceil(n_queries / spark.sparkContext.defaultParallelism)))
        pieces = routed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("pieces"))
        left = routed.join(pieces, "block").withColumn(
            "piece", F.pmod(F.xxhash64("id", F.lit(1)), F.col("pieces")).cast("int")
        )
        right = blocks.join(pieces, "block").withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
        )
        return (
            left.select("block", "piece", "id", "vec")
            .groupBy("block", "piece")
            .cogroup(right.select("block", "piece", "id", "vec", *taken).groupBy("block", "piece"))
            .applyInPandas(compare, found_ddl + "".join(f", `{c}` {blocks.schema[c].dataType.simpleString()}" for c in taken))
        )

    def ranked(results: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("src").orderBy("dist", "dst"))
        return results.withColumn("rank", rank).filter(F.col("rank") <= k)

    if n <= block_rows:
        if work is not None:
            work.append(n * n_queries)
        taken = list(carry)
        nearest = search(queries.withColumn("block", F.lit(0).cast("bigint")), rows.withColumn("block", F.lit(0).cast("bigint")))
        return ranked(nearest).select("src", "dst", "dist", "rank", *carry)

    n_pivots = min(
        pivots, max(2, PIVOT_BYTES // (8 * width)), math.ceil(2 * n / block_rows)
    )
    # The rows with the smallest hashes; all but about eight times that many are left out before
    # the sort, so that the tasks do not each return a full set of candidates.
    border = min(2**63 - 1, int(-(2**63) + 2**64 * (8 * n_pivots + 64) / n))
    sample = (
        rows.select("vec", F.xxhash64("id").alias("h"))
        .filter(F.col("h") <= border)
        .orderBy("h")
        .limit(n_pivots)
    )
    centres = np.unique(_matrix(sample.select("vec").toPandas()["vec"]), axis=0)
    shared_centres = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, apart = _nearest(_matrix(batch["vec"]), shared_centres.value, groups)
            yield batch.assign(cell=cell, apart=apart)

    corpus_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    # Written once: the counts and both searches read it.
    assigned = rows.mapInPandas(assign, f"{corpus_ddl}, cell int, apart double")
    written = cut_lineage(assigned.withColumn("_row", F.monotonically_increasing_id()))
    assigned = written.drop(*carry)
    corpus_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in assigned.schema if f.name not in ("cell", "apart"))
    stats = assigned.groupBy("cell").agg(*_extent()).toPandas()
    cells = _Cells(centres, stats, groups)
    shared = spark.sparkContext.broadcast(cells)
    large = [int(c) for c in np.flatnonzero(cells.counts > block_rows)]
    in_large = F.col("cell").isin(large)
    blocks = assigned.filter(~in_large).withColumn("block", _block(F.col("cell")))
    lower = None
    if large:
        sizes = spark.createDataFrame([(c, int(cells.counts[c])) for c in large], "cell int, n long")
        blocks, lower = _lower_level(blocks, assigned.filter(in_large), sizes, block_rows, corpus_ddl, groups)
    blocks = blocks.drop("cell", "apart")
    query_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema)
    slack = 1e-9 if digits is None else 1e-9 + 10.0**-digits

    def upper(first: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = shared.value
            for batch in _slices(batches, len(known.counts)):
                to_pivot = _distances(_matrix(batch["vec"]), known.pivots, groups)
                home = known.home(to_pivot, keep)
                reach = batch["reach"].fillna(np.inf).to_numpy() * (1 + 1e-9) + slack
                q, cell = np.nonzero(home if first else known.within(to_pivot, reach))
                yield pd.DataFrame(
                    {
                        "id": batch["id"].to_numpy()[q], "vec": batch["vec"].to_numpy()[q],
                        "cell": cell.astype(np.int32), "reach": reach[q], "home": home[q, cell],
                    }
                )

        return run

    def routed(bounded: DataFrame, first: bool) -> DataFrame:
        """The queries with the blocks to search: the first ones, or all others within reach."""
        sent = bounded.mapInPandas(upper(first), f"{query_ddl}, cell int, reach double, home boolean")
        # A small cell is one block; the first search has seen the home cells.
        whole = sent.filter(~in_large if first else ~in_large & ~F.col("home"))
        whole = whole.select("id", "vec", _block(F.col("cell")).alias("block"))
        if lower is None:
            return whole
        below = cut_lineage(sent.filter(in_large))
        return whole.unionByName(_lower_routes(below, lower, first, keep, chunk_rows, query_ddl, groups))

    def searched(bounded: DataFrame, first: bool) -> DataFrame:
        sent = routed(bounded, first)
        if work is not None:
            sent = cut_lineage(sent)
            sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
            met = sent.groupBy("block").agg(F.count(F.lit(1)).alias("q")).join(sizes, "block")
            work.append(met.agg(F.sum(F.col("n") * F.col("q"))).first()[0] or 0)
        return search(sent, blocks)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks beside the first ones that the queries would be sent to."""
        blocks_of = np.ceil(shared.value.counts / block_rows)
        for batch in batches:
            n_blocks = 0.0
            for part in _slices(iter([batch]), len(blocks_of)):
                to_pivot = _distances(_matrix(part["vec"]), shared.value.pivots, groups)
                reach = part["reach"].fillna(np.inf).to_numpy() * (1 + 1e-9) + slack
                fresh = shared.value.within(to_pivot, reach) & ~shared.value.home(to_pivot, keep)
                n_blocks += float((fresh * blocks_of).sum())
            yield pd.DataFrame({"n": [n_blocks]})

    # Both later steps need the first answers, so they are written once.
    none = F.lit(None).cast("double").alias("reach")
    home = cut_lineage(ranked(searched(queries.select("*", none), True)))
    reach = home.filter(F.col("rank") == k).select(
        F.col("src").alias("id"), F.col("dist").alias("reach")
    )
    tasks = min(4 * spark.sparkContext.defaultParallelism, math.ceil(n_queries / 1024) or 1)
    bounded = cut_lineage(queries.join(reach, "id", "left").repartition(tasks))
    to_meet = (bounded.mapInPandas(spread, "n double").agg(F.sum("n")).first()[0] or 0) / max(1, n_queries)
    plan = _slab_plan(cells.counts, max(1, SLAB_BYTES // ((4 if dict(rows.dtypes)["vec"] == "array<float>" else 8) * width)))
    if to_meet <= MOST_BLOCKS and to_meet * block_rows <= ROUND_COST * len(plan):
        nearest = ranked(home.drop("rank").unionByName(searched(bounded, False)))
    else:
        parts, met = [], 0
        for picked in plan:
            found, n_met = _slab_round(
                assigned.filter(picked), bounded, k, exclude_self, digits, groups, found_ddl, max(1, min(TILE_ROWS, block_rows))
            )
            parts.append(found)
            met += n_met
        if work is not None:
            work.append(met)
        nearest = ranked(reduce(DataFrame.unionByName, parts))
    if carry:
        nearest = nearest.join(written.select("_row", *carry), "_row")
    return nearest.select("src", "dst", "dist", "rank", *carry)


def _slab_plan(counts: np.ndarray, slab_rows: int) -> list[Column]:
    """Conditions on ``cell`` and ``_row``, each of which holds for at most about ``slab_rows`` rows, and one for each row."""
    plan, own, held = [], [], 0
    for cell in np.flatnonzero(counts):
        n, cell = int(counts[cell]), int(cell)
        if n > slab_rows:
            pieces = math.ceil(n / slab_rows)
            piece = F.pmod(F.xxhash64("_row"), F.lit(pieces))
            plan += [(F.col("cell") == cell) & (piece == i) for i in range(pieces)]
            continue
        if own and held + n > slab_rows:
            plan.append(F.col("cell").isin(own))
            own, held = [], 0
        own.append(cell)
        held += n
    return plan + ([F.col("cell").isin(own)] if own else [])


def _flat(vectors: pa.Array) -> np.ndarray:
    """The lists of one length as a matrix, in their own precision."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _tiles(vectors: np.ndarray, tile_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """An order in which rows that lie together follow each other, and the borders of tiles of at most ``tile_rows`` in it. Parts
    are halved along the line between two far rows of them."""
    done, parts = [], [np.arange(len(vectors))]
    while parts:
        own = parts.pop()
        if len(own) <= tile_rows:
            done.append(own)
            continue
        part = vectors[own]
        far = part[((part - part[0]) ** 2).sum(axis=1).argmax()]
        other = part[((part - far) ** 2).sum(axis=1).argmax()]
        half = len(own) // 2
        order = np.argpartition(part @ (far - other), half)
        parts += [own[order[half:]], own[order[:half]]]
    return np.concatenate(done), np.cumsum([0] + [len(d) for d in done])


class _Slab:
    """Corpus rows of one round. What can be computed from them is, once in each process that they have come to."""

    def __init__(self, table: pa.Table, tile_rows: int):
        table = table.combine_chunks()
        vectors = _flat(table["vec"].combine_chunks())
        finite = np.flatnonzero(np.isfinite(vectors).all(axis=1))
        order, self.borders = _tiles(vectors[finite], tile_rows) if len(finite) else (np.arange(0), np.zeros(1, int))
        order = finite[order]
        self.vectors = vectors[order]
        self.ids = table["id"].combine_chunks().take(pa.array(order))
        self.rows = table["_row"].to_numpy()[order]
        self.lifted = {}

    def prepare(self) -> None:
        """Rows are moved to their middle and scaled to lengths about 1, so that the error of single precision is small."""
        if self.lifted:
            return
        by_id = pc.sort_indices(self.ids, sort_keys=[("", "ascending")], null_placement="at_start").to_numpy()
        self.rank = np.empty(len(by_id), np.int64)
        self.rank[by_id] = np.arange(len(by_id))
        self.middle = self.vectors.mean(axis=0, dtype=np.float64)
        pairs = list(zip(self.borders, self.borders[1:]))
        longest = math.sqrt(max(((self.vectors[a:b] - self.middle) ** 2).sum(axis=1).max() for a, b in pairs))
        self.scale = 2.0 ** -math.floor(math.log2(longest)) if longest > 0 else 1.0
        self.longest = longest * self.scale
        self.centres, self.radius = np.empty((len(pairs), self.vectors.shape[1])), np.empty(len(pairs))
        for i, (a, b) in enumerate(pairs):
            moved = (self.vectors[a:b] - self.middle) * self.scale
            self.centres[i] = moved.mean(axis=0)
            self.radius[i] = math.sqrt(((moved - self.centres[i]) ** 2).sum(axis=1).max()) * (1 + 1e-9)
        self.of(np.float32)

    def of(self, kind) -> np.ndarray:
        """The rows with half their squared length as a further coordinate, so that a product tells a distance."""
        if kind not in self.lifted:
            made = np.empty((len(self.vectors), self.vectors.shape[1] + 1), kind)
            for a, b in zip(self.borders, self.borders[1:]):
                moved = (self.vectors[a:b] - self.middle) * self.scale
                made[a:b, :-1], made[a:b, -1] = moved, -0.5 * (moved**2).sum(axis=1)
            self.lifted[kind] = made
        return self.lifted[kind]

    def nearest(self, q: np.ndarray, q_ids: pa.Array, reach: np.ndarray, k: int, exclude_self: bool, digits: int | None, groups: int):
        """(query position, position here, distance) of the k nearest within reach, ties to the smaller id, and how many pairs were
        compared. Single precision leaves out only what is farther than its error allows."""
        self.prepare()
        q = q.astype(np.float64)
        x = (q - self.middle) * self.scale
        norm = (x**2).sum(axis=1)
        kind = np.float32 if len(q) and norm.max() < 1e16 else np.float64
        left, right = np.column_stack([x, np.ones(len(x))]).astype(kind), self.of(kind)
        least = _least_share(q, self.vectors, groups) if groups > 1 else 1.0
        error = (x.shape[1] + 8) * np.finfo(kind).eps * (np.sqrt(norm) * self.longest + self.longest**2)
        squared = norm[:, None] + (self.centres**2).sum(axis=1)
        to_centre = squared - 2 * (x @ self.centres.T) - 1e-12 * squared
        # Least possible length, in the scale of the slab, of the way to each tile's rows.
        way = np.sqrt(np.maximum(to_centre, 0)) - self.radius
        reach = reach.copy()

        def limits() -> tuple[np.ndarray, np.ndarray]:
            far = (reach * (1 + 1e-9) + (0 if digits is None else 10.0**-digits)) * self.scale / math.sqrt(least)
            return far, ((norm - far**2) / 2 - error - 1e-15 * (norm + far**2)).astype(kind)[:, None]

        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        held, n_held, n_met = [], 0, 0

        def settle() -> None:
            """Measures what is held and keeps the best, beyond which nothing is looked for any more."""
            r, c = (np.concatenate(parts) for parts in zip(*held))
            if exclude_self:
                own = pc.fill_null(pc.equal(q_ids.take(pa.array(r)), self.ids.take(pa.array(c))), False).to_numpy(zero_copy_only=False)
                r, c = r[~own], c[~own]
            dist, step = np.empty(len(r)), max(1, SLICE_CELLS // q.shape[1])
            for i in range(0, len(r), step):
                dist[i : i + step] = _norms(q[r[i : i + step]] - self.vectors[c[i : i + step]], groups)
            if digits is not None:
                dist = np.round(dist, digits)
            r, c, dist = (np.concatenate(pair) for pair in zip(best, (r, c, dist)))
            order = np.lexsort((self.rank[c], dist, r))
            r, c, dist = r[order], c[order], dist[order]
            place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
            best[:] = r[place < k], c[place < k], dist[place < k]
            full = place == k - 1
            reach[r[full]] = np.minimum(reach[r[full]], dist[full])
            held.clear()

        far, bound = limits()
        # Tiles that are near to most queries come first, as they may shorten their reach.
        for tile in np.argsort((way <= far[:, None]).sum(axis=0), kind="stable")[::-1]:
            a, b = self.borders[tile], self.borders[tile + 1]
            some = np.flatnonzero(way[:, tile] <= far)
            n_met += len(some) * int(b - a)
            for i in range(0, len(some), 1024):
                part = some[i : i + 1024]
                r, c = np.nonzero(left[part] @ right[a:b].T >= bound[part])
                held.append((part[r], c + a))
                n_held += len(r)
                if n_held > HELD_PAIRS:
                    settle()
                    n_held = 0
                    far, bound = limits()
        if held:
            settle()
        return *best, n_met


def _slab_round(
    corpus: DataFrame, bounded: DataFrame, k: int, exclude_self: bool, digits: int | None, groups: int, found_ddl: str, tile_rows: int
) -> tuple[DataFrame, int]:
    """The nearest within reach of each query among ``corpus``, which goes to all tasks, and how many pairs were compared."""
    spark = bounded.sparkSession
    table = corpus.select("id", "vec", "_row").toArrow()
    shared = spark.sparkContext.broadcast(_Slab(table, tile_rows))
    del table
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, none = shared.value, [pa.array([-1], pa.int64())]
        for batch in (b.slice(i, QUERIES) for b in batches for i in range(0, len(b), QUERIES)):
            batch = batch.filter(pc.is_valid(batch["vec"]))
            n_met, r = 0, []
            if len(batch) and len(slab.vectors):
                q, reach = _flat(batch["vec"]), pc.fill_null(batch["reach"], math.inf).to_numpy(zero_copy_only=False)
                r, c, dist, n_met = slab.nearest(q, batch["id"], reach, k, exclude_self, digits, groups)
            if len(r):
                columns = [batch["id"].take(pa.array(r)), slab.ids.take(pa.array(c)), pa.array(dist), pa.array(slab.rows[c])]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(r), pa.int64())], names)
            # A row that is none of the found ones tells the number of pairs.
            empty = [pa.nulls(1, batch["id"].type), pa.nulls(1, slab.ids.type), pa.nulls(1, pa.float64())]
            yield pa.RecordBatch.from_arrays([*empty, *none, pa.array([n_met], pa.int64())], names)

    names = ["src", "dst", "dist", "_row", "n_met"]
    made = cut_lineage(bounded.select("id", "vec", "reach").mapInArrow(run, f"{found_ddl}, `_row` bigint, n_met bigint"))
    n_met = made.agg(F.sum("n_met")).first()[0] or 0
    shared.destroy()
    return made.filter(F.col("_row") >= 0).drop("n_met"), n_met


def _extent() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min("apart").alias("near"), F.max("apart").alias("far")]


def _block(cell: Column, lower: Column | int = 0, part: Column | int = 0) -> Column:
    """One number for a cell, a cell below it and a part of that."""
    number = cell.cast("bigint") * F.lit(1 << 40)
    for value, unit in ((lower, 1 << 20), (part, 1)):
        number = number + (F.lit(value) if isinstance(value, int) else value.cast("bigint")) * F.lit(unit)
    return number


def _nearest(vectors: np.ndarray, pivots: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    to_pivot = _distances(vectors, pivots, groups)
    cell = to_pivot.argmin(axis=1)
    return cell.astype(np.int32), np.take_along_axis(to_pivot, cell[:, None], axis=1)[:, 0]


def _lower_level(
    blocks: DataFrame, rows: DataFrame, sizes: DataFrame, block_rows: int, corpus_ddl: str, groups: int
) -> tuple[DataFrame, DataFrame]:
    """Cuts the large cells around pivots of their own. Returns all blocks, and of each lower cell its pivot, extent and
    number of parts."""
    wanted = F.least(F.lit(LOWER_PIVOTS), F.ceil(2 * F.col("n") / block_rows)).cast("int")
    # As above: the rows with the smallest hashes, most others left out before they are ordered.
    border = F.lit(-(2.0**63)) + F.lit(2.0**64) * (8 * wanted + 64) / F.col("n")
    hashed = rows.select("cell", "vec", F.xxhash64("id", F.lit(3)).alias("h")).join(F.broadcast(sizes), "cell")
    order = W.partitionBy("cell").orderBy("h")
    pivots = cut_lineage(
        hashed.filter(F.col("h").cast("double") <= border)
        .withColumn("lower", F.row_number().over(order) - 1)
        .filter(F.col("lower") < wanted)
        .select("cell", "lower", F.col("vec").alias("pivot"))
    )
    pieces = sizes.select("cell", F.ceil(F.col("n") / LOWER_ROWS).cast("int").alias("pieces"))
    dealt = rows.drop("apart").join(F.broadcast(pieces), "cell")
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("id", F.lit(5)), "pieces").cast("int")).drop("pieces")
    near = pivots.join(F.broadcast(pieces), "cell")
    near = near.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")

    def assign(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return left.assign(lower=[], apart=[]).astype(object)
        right = right.sort_values("lower")
        lower, apart = _nearest(_matrix(left["vec"]), _matrix(right["pivot"]), groups)
        return left.assign(lower=right["lower"].to_numpy()[lower], apart=apart)

    names = [f.name for f in rows.schema if f.name not in ("cell", "apart")]
    assigned = cut_lineage(
        dealt.select(*[f"`{c}`" for c in names], "cell", "piece").groupBy("cell", "piece")
        .cogroup(near.toDF(*near.columns).groupBy("cell", "piece"))
        .applyInPandas(assign, f"{corpus_ddl}, cell int, piece int, lower int, apart double")
    )
    extent = assigned.groupBy("cell", "lower").agg(*_extent())
    known = pivots.join(extent, ["cell", "lower"]).withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
    known = cut_lineage(known)
    parted = assigned.join(known.select("cell", "lower", "parts"), ["cell", "lower"])
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    made = parted.withColumn("block", _block(F.col("cell"), F.col("lower"), part))
    return blocks.unionByName(made.drop("piece", "lower", "parts")), known


def _lower_routes(
    sent: DataFrame, lower: DataFrame, first: bool, keep: int, chunk_rows: int, query_ddl: str, groups: int
) -> DataFrame:
    """Sends queries on from a large cell to the blocks below it."""
    pieces = sent.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("pieces"))
    left = sent.join(F.broadcast(pieces), "cell")
    left = left.withColumn("piece", F.pmod(F.xxhash64("id", F.lit(1)), "pieces").cast("int")).drop("pieces")
    right = lower.join(F.broadcast(pieces), "cell")
    right = right.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")

    def route(key, queries: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or cells.empty:
            return pd.DataFrame({"id": [], "vec": [], "block": []}, dtype=object)
        cells = cells.sort_values("lower").reset_index(drop=True)
        known = _Cells(_matrix(cells["pivot"]), cells.assign(cell=cells.index), groups)
        parts = cells["parts"].to_numpy().astype(np.int64)
        to_pivot = _distances(_matrix(queries["vec"]), known.pivots, groups)
        home = known.home(to_pivot, keep)
        own = pd.util.hash_array(queries["id"].to_numpy())
        if first:
            q, cell = np.nonzero(home)
            part = (own[q] % parts[cell].astype(np.uint64)).astype(np.int64)
        else:
            q, cell = np.nonzero(known.within(to_pivot, queries["reach"].to_numpy()))
            times = parts[cell]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            q, cell = np.repeat(q, times), np.repeat(cell, times)
            # The part that the first search has seen.
            seen = (own[q] % parts[cell].astype(np.uint64)).astype(np.int64) == part
            fresh = ~(queries["home"].to_numpy()[q] & home[q, cell] & seen)
            q, cell, part = q[fresh], cell[fresh], part[fresh]
        block = (int(key[0]) << 40) + (cells["lower"].to_numpy()[cell].astype(np.int64) << 20) + part
        return pd.DataFrame({"id": queries["id"].to_numpy()[q], "vec": queries["vec"].to_numpy()[q], "block": block})

    right = right.toDF(*right.columns)
    return (
        left.groupBy("cell", "piece")
        .cogroup(right.groupBy("cell", "piece"))
        .applyInPandas(route, f"{query_ddl}, block bigint")
    )


def knn_classify(
    query: DataFrame,
    train: DataFrame,
    k: int = 9,
    label: str = "label",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = False,
    **limits,
) -> DataFrame:
    """Class of the k nearest training rows, each voting with 1/distance. Neighbours at distance
    zero decide alone; equal votes go to the smaller class."""
    votes = (
        knn(query, train, k, id_col, vector_col, exclude_self, carry=[label], **limits)
        .groupBy("src", F.col(label).alias("cls"))
        .agg(
            F.count(F.when(F.col("dist") == 0, 1)).alias("copies"),
            F.coalesce(F.sum(F.when(F.col("dist") > 0, 1 / F.col("dist"))), F.lit(0.0)).alias("w"),
        )
    )
    strength = F.struct(
        F.col("copies"), F.when(F.col("copies") > 0, 0.0).otherwise(F.col("w")), -F.col("cls")
    )
    return votes.groupBy(F.col("src").alias(id_col)).agg(F.max_by("cls", strength).alias("prediction"))


def knn_edges(
    df: DataFrame,
    k: int = 9,
    include_self: bool = False,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    **limits,
) -> DataFrame:
    """Directed graph that joins each row with its k nearest rows."""
    return knn(df, df, k, id_col, vector_col, exclude_self=not include_self, **limits)
