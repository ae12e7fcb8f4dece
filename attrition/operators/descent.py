"""Neighbour graphs by descent: a neighbour's neighbour is likely to be a neighbour.

The first graph comes from a few orderings along a curve through the cells of several random projections: rows that follow
each other are compared. Then each round joins the graph with its own reverse. Every row sees the rows it names and those that name
it, and these are compared with each other; a pair counts for both of its rows. Pairs of two old entries were
compared before, so only pairs with an entry that is new since the last round are looked at. It ends when fewer than
``least_change`` of the entries change.

What a row sees is bounded: at most ``sample`` new and ``sample`` old entries in each direction, by a hash that
changes with the round, so a row that very many others name is no hot spot, and entries that had no turn stay new.
Vectors go to the rows that see them, unless a row sees nothing new; what comes back are only pairs that are nearer than the
row's k-th neighbour so far, of each task the best ones of each row. Rounds are written, so a lost executor costs one round at most.

The graph is approximate: :func:`attrition.operators.approximate.recall` measures it. ``work`` of the result tells
how many distances each round took.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.operators.neighbors import _distances, _drop_far_copies, _matrix, knn
from attrition.sources.scratch import cut_lineage

ORDERINGS, WINDOW, MOST_ROUNDS = 3, 64, 20
#: Projections of one ordering, and rows from which their spread is taken.
PROJECTIONS, SPREAD_ROWS = 6, 2048
#: Pairs that a task holds before it leaves out all but the best.
HELD_PAIRS = 500_000


@dataclass
class NeighbourGraph:
    """``edges``: src, dst, dist, rank. ``work``: distances taken at the start and in each round, and entries changed."""

    edges: DataFrame
    n: int
    work: list[tuple[int, int]] = field(default_factory=list)

    @property
    def share(self) -> float:
        """Distances taken, as a share of all pairs of two rows."""
        return sum(w for w, _ in self.work) / max(1.0, self.n * (self.n - 1) / 2)


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each row, each once; an old entry goes before the same one made anew. One shuffle serves both steps."""
    order = W.partitionBy("src").orderBy("dist", "dst")
    one = edges.repartition("src").groupBy("src", "dst").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _entries(edges: DataFrame, k: int, sample: int, turn: int) -> DataFrame:
    """The graph after a round: ``fresh`` entries are those made in it, of which ``new`` is 2; ``seen`` tells which ones the row
    sees in the next round, at most ``sample`` new and ``sample`` old ones, by hash."""
    best = _best(edges, k).withColumn("fresh", F.col("new") == 2).withColumn("new", F.least("new", F.lit(1)))
    order = W.partitionBy("src", "new").orderBy(F.xxhash64("src", "dst", F.lit(turn)))
    return best.withColumn("seen", F.row_number().over(order) <= sample)


def _curve(sample: np.ndarray, seed: tuple[int, int]) -> Callable[[np.ndarray], np.ndarray]:
    """A place on a curve for each vector: the bits of its place among the ``sample`` in several random projections, by turns."""
    dims = sample.shape[1]
    m = min(dims, PROJECTIONS)
    directions = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, m)))[0]
    bits = min(30, 60 // m)
    known = [np.unique(column) for column in (sample @ directions).T]

    def place(vectors: np.ndarray) -> np.ndarray:
        shares = [np.interp(p, x, np.linspace(0, 1, len(x))) for p, x in zip((vectors @ directions).T, known)]
        cells = [(np.nan_to_num(share) * (2**bits - 1)).astype(np.int64) for share in shares]
        out = np.zeros(len(vectors), np.int64)
        for bit in range(bits - 1, -1, -1):
            for cell in cells:
                out = out << 1 | cell >> bit & 1
        return out

    return place


def _along_curves(rows: DataFrame, k: int, seed: int, width: int) -> DataFrame:
    """Rows compared with those of their window in some orderings, ``k`` entries each at most. Windows overlap, and a row
    is answered in the one in whose middle it is."""
    step, start = width // 2, width // 4

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, begin = None, 0
        for batch in batches:
            both = batch if held is None else pd.concat([held, batch], ignore_index=True)
            done, out = 0, []
            while len(both) - done >= width:
                out.append(_within(both.iloc[done : done + width], k, begin, start + step))
                done, begin = done + step, start
            if out:
                yield pd.concat(out, ignore_index=True)
            held = both.iloc[done:]
        if held is not None and len(held) > 1:
            yield _within(held, k, begin, len(held))

    few = rows.select("vec", F.xxhash64("id").alias("h")).orderBy("h").limit(SPREAD_ROWS).toPandas()
    kind = rows.schema["id"].dataType.simpleString()
    found = None
    for i in range(ORDERINGS):
        place = _curve(_matrix(few["vec"]), (seed, i))

        def placed(batches: Iterator[pd.DataFrame], place=place) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(place=place(_matrix(batch["vec"])))

        ordered = rows.mapInPandas(placed, f"id {kind}, vec array<double>, place bigint").repartitionByRange("place")
        some = ordered.sortWithinPartitions("place", "id").select("id", "vec")
        some = some.mapInPandas(compare, f"src {kind}, dst {kind}, dist double")
        found = some if found is None else found.unionByName(some)
    return found


def _within(part: pd.DataFrame, k: int, begin: int, end: int) -> pd.DataFrame:
    """The nearest of the part for its rows from ``begin`` to ``end``."""
    ids, vectors = part["id"].to_numpy(), _matrix(part["vec"])
    apart = _distances(vectors[begin:end], vectors)
    apart[np.arange(len(apart)), begin + np.arange(len(apart))] = np.inf
    near = np.argsort(apart, axis=1, kind="stable")[:, : min(k, len(ids) - 1)]
    src = np.repeat(np.arange(len(apart)), near.shape[1])
    return pd.DataFrame({"src": ids[begin + src], "dst": ids[near.ravel()], "dist": apart[src, near.ravel()]})


def _nearest_pairs(pairs: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest pairs of each row, each once."""
    pairs = pairs.sort_values(["src", "dist", "dst"], ignore_index=True).drop_duplicates(["src", "dst"])
    return pairs[pairs.groupby("src", sort=False).cumcount() < k]


def _chosen(entries: DataFrame, sample: int, mix: Column) -> DataFrame:
    """At most ``sample`` new and old entries of each row, by hash. The limit is applied before the shuffle too."""
    order = W.partitionBy("at", "new").orderBy(mix)
    return entries.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= sample).drop("turn")


def _local_joins(k: int):
    """Rows come ordered by the row that sees them; each is compared with the others of its group. Of the pairs of a task
    only those go on that can be among the nearest."""

    def join(part: pd.DataFrame) -> pd.DataFrame | None:
        new = part["new"].to_numpy()
        if not new.any() or len(part) < 2:
            return None
        ids, far, vectors = part["id"].to_numpy(), part["far"].to_numpy(), _matrix(part["vec"])
        apart = _distances(vectors, vectors)
        i, j = np.nonzero(np.triu(np.ones(apart.shape, bool), 1) & (new[:, None] | new[None, :]))
        dist = apart[i, j]
        a, b = dist < far[i], dist < far[j]
        return pd.DataFrame(
            {
                "src": np.concatenate([ids[i[a]], ids[j[b]]]),
                "dst": np.concatenate([ids[j[a]], ids[i[b]]]),
                "dist": np.concatenate([dist[a], dist[b]]),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        out: list[pd.DataFrame] = []
        for batch in batches:
            both = batch if held is None else pd.concat([held, batch], ignore_index=True)
            # The last group may go on in the next batch.
            last = both["at"].to_numpy() == both["at"].iloc[-1] if len(both) else np.zeros(0, bool)
            held, whole = both[last], both[~last]
            out += [f for _, part in whole.groupby("at", sort=False) if (f := join(part)) is not None]
            if sum(map(len, out)) >= HELD_PAIRS:
                yield _nearest_pairs(pd.concat(out, ignore_index=True), k)
                out = []
        if held is not None and len(held) and (f := join(held)) is not None:
            out.append(f)
        if out:
            yield _nearest_pairs(pd.concat(out, ignore_index=True), k)

    return run


def neighbour_graph(
    df: DataFrame,
    k: int = 9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int | None = None,
    least_change: float = 0.002,
    seed: int = 42,
    exact_below: int = 256,
    window: int = WINDOW,
) -> NeighbourGraph:
    """Directed graph that joins each row with about its ``k`` nearest other rows. Ids must be unique. Rows without vector
    are left out; fewer than ``exact_below`` rows are compared with each other."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec")).filter(F.col("vec").isNotNull())
    rows = cut_lineage(rows)
    n = rows.count()
    if n < max(exact_below, 2 * k + 2):
        return NeighbourGraph(knn(rows, rows, k, "id", "vec", exclude_self=True), n, [(n * (n - 1) // 2, n * k)])
    sample = sample or k
    # Of equal vectors the smallest ids stand for all; the others are given their neighbours at the end.
    same = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > k + 1)
    many = not same.isEmpty()
    active = cut_lineage(_drop_far_copies(rows, k + 1)) if many else rows
    n_active = active.count() if many else n

    first = _along_curves(active, k, seed, window).withColumn("new", F.lit(1))
    graph = cut_lineage(_entries(first, k, sample, 0))
    work = [(ORDERINGS * n_active * window, n_active * k)]
    for turn in range(MOST_ROUNDS):
        far = graph.groupBy("src").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("far")
        )
        forward = graph.filter("seen").select(F.col("src").alias("at"), F.col("dst").alias("id"), "new")
        backward = graph.select(F.col("dst").alias("at"), F.col("src").alias("id"), "new")
        backward = _chosen(backward, sample, F.xxhash64("at", "id", F.lit(turn)))
        # One shuffle by the row that sees; rows that see nothing new are left out.
        group = forward.unionByName(backward).repartition("at").groupBy("at", "id").agg(F.max("new").alias("new"))
        all_of = W.partitionBy("at")
        group = group.withColumns({"n_new": F.sum("new").over(all_of), "n_old": F.sum(1 - F.col("new")).over(all_of)})
        group = cut_lineage(group.filter("n_new > 0"))
        (taken,) = group.filter("new = 1").agg(F.sum(F.expr("n_new - 1 + 2 * n_old")).alias("twice")).first()
        known = active.join(far, F.col("id") == F.col("src"), "left").select("id", "vec", F.coalesce("far", F.lit(float("inf"))).alias("far"))
        kind = rows.schema["id"].dataType.simpleString()
        pairs = (
            group.select("at", "id", "new").join(known, "id")
            .repartition("at")
            .sortWithinPartitions("at", "id")
            .select("at", "id", "vec", "far", "new")
            .mapInPandas(_local_joins(k), f"src {kind}, dst {kind}, dist double")
        )
        # New entries that had their turn are old from now on.
        kept = graph.select("src", "dst", "dist", F.when(F.col("seen"), 0).otherwise(F.col("new")).alias("new"))
        graph = cut_lineage(_entries(kept.unionByName(pairs.withColumn("new", F.lit(2))), k, sample, turn + 1))
        changed = graph.filter("fresh").count()
        work.append((int(taken or 0) // 2, changed))
        if changed <= least_change * n_active * k:
            break
    edges = graph.select("src", "dst", "dist", "rank")
    if many:
        rest = rows.join(active, "id", "left_anti")
        edges = edges.unionByName(knn(rest, active, k, "id", "vec", exclude_self=True))
    return NeighbourGraph(edges, n, work)
