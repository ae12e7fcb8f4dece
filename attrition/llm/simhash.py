"""SimHash near-duplicates with BK-trees.

A fingerprint has a bit for each bit position that is set in over half of a text's shingle hashes.
Fingerprints at ``radius`` or fewer differing bits are linked, and linked documents form groups.

Equal fingerprints are one node from the start. The 64 bits are cut into ``radius + 3`` blocks; two
linked fingerprints agree in at least three of them, so each fingerprint goes to one shard for every
choice of three blocks and their values, and every link lies inside a shard. A shard's BK-tree keeps
the children of a node by their distance to it; a search follows only the edges whose distance
differs by at most the radius. A shard larger than ``chunk`` is dealt to cells, one for every pair
of its chunks, so no task gets more than two chunks. Each cell returns one row for each fingerprint
at most, its link to the cell's smallest connected one, never all pairs. Trees are built where they
are searched and not broadcast, since their number grows with the corpus.

Groups are the connected components of these links, found on the cluster by alternating star steps;
each step is written to the shared folder.

Cases: null and empty texts have no words and fingerprint zero, and are linked like any other; fewer
words than a shingle make one shingle; a null key joins its group and is never its smallest id, a
group of null keys alone has a null id; repeated rows stay; an empty table gives an empty result;
only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.common import fresh, give_back, partitions, read, without, written

SHINGLE, RADIUS, CHUNK = 3, 2, 4096
SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    hashes = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    table = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(table[:, j], minlength=256) @ _BITS for j in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > len(table)).tobytes(), "big", signed=True)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf(T.LongType())
    def of_each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
        give_back()

    return of_each(text)


class BKTree:
    """Distinct fingerprints; the children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        node, new = 0, len(self.values) - 1
        while node != new:
            node = self.children[node].setdefault((self.values[node] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                yield self.values[node]
            children = self.children[node]
            if len(children) > 2 * radius + 1:
                for d in range(distance - radius, distance + radius + 1):
                    if d in children:
                        stack.append(children[d])
            else:
                stack.extend(c for d, c in children.items() if abs(d - distance) <= radius)


def linked(tree_of: list[int], searched: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what is within the radius: of the first list's members among themselves
    if the second is empty, else across. One for each fingerprint at most, to the smallest."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    def join(a: int, b: int) -> None:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)

    tree = BKTree()
    for value in tree_of:
        if not searched:
            for other in tree.within(value, radius):
                join(value, other)
        tree.add(value)
    for value in searched:
        for other in tree.within(value, radius):
            join(value, other)
    return [(x, r) for x in root if (r := find(x)) != x]


def _links(radius: int):
    mask = (1 << 64) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come ordered by cell; a cell may span batches."""
        cell, first, second = None, [], []
        out: list[tuple[int, int]] = []

        def close() -> None:
            if len(first) + len(second) > 1:
                out.extend(linked(first, second, radius))

        def frame() -> pd.DataFrame:
            table = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            return pd.DataFrame({"_a": table[:, 0], "_b": table[:, 1]})

        for batch in batches:
            for key, side, value in zip(batch["_cell"], batch["_side"], batch["_print"]):
                if key != cell:
                    close()
                    cell, first, second = key, [], []
                (second if side else first).append(value & mask)
            yield frame()
        close()
        yield frame()

    return run


def cells(members: DataFrame, chunk: int) -> DataFrame:
    """Deals ``_print`` in shards ``_shard`` of ``count`` members (null if small) to cells."""
    dealt = members.withColumn(
        "_chunks", F.coalesce(F.ceil(F.col("count") / chunk), F.lit(1)).cast("int")
    )
    own = F.pmod(F.xxhash64("_print"), F.col("_chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    return (
        dealt.withColumn("_own", own)
        .withColumn("_other", other)
        .select(
            F.xxhash64("_shard", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_cell"),
            (F.col("_own") > F.col("_other")).cast("int").alias("_side"),
            "_print",
        )
    )


def print_links(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links ``_a``, ``_b`` that connect the fingerprints in column ``_print``, all distinct."""
    blocks, agree = radius + 3, 3
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]

    def mask(choice) -> int:
        bits = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in choice)
        return bits - (1 << 64) if bits >= 1 << 63 else bits

    shards = [
        F.struct(
            F.lit(i).alias("choice"), F.col("_print").bitwiseAND(F.lit(mask(c))).alias("value")
        )
        for i, c in enumerate(combinations(range(blocks), agree))
    ]
    members = prints.select("_print", F.explode(F.array(*shards)).alias("_shard")).select(
        "_print", F.xxhash64("_shard.choice", "_shard.value").alias("_shard")
    )
    large = members.groupBy("_shard").count().where(F.col("count") > chunk)
    dealt = cells(members.join(large, "_shard", "left"), chunk)
    n = partitions(prints.sparkSession)
    return (
        dealt.repartition(n, "_cell")
        .sortWithinPartitions("_cell", "_side", "_print")
        .mapInPandas(_links(radius), "_a long, _b long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components by alternating large and small stars: ``_node`` and ``_root``, the
    smallest node of its component, for every node that is not a root itself."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        near = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))) if large else edges
        least = written(
            near.groupBy("_a").agg(F.least(F.min("_b"), F.col("_a")).alias("_least")), "star-least"
        )
        joined = near.join(least, "_a")
        if large:
            moved = joined.where("_b > _a").select(F.col("_b").alias("_a"), F.col("_least").alias("_b"))
        else:
            moved = joined.select(F.col("_b").alias("_a"), F.col("_least").alias("_b")).unionByName(
                least.select("_a", F.col("_least").alias("_b"))
            )
        return moved.where("_a <> _b").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(
            edges.agg(
                F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(20,0)"))
            ).first()
        )

    edges = written(
        links.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")), "links"
    )
    seen = state(edges)
    while seen[0]:
        edges = written(star(edges, large=True), "large-star")
        edges = written(star(edges, large=False), "small-star")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def grouped(marked: DataFrame, links: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """``marked`` has key and ``_print``; ``links`` finds the links among the distinct ``_print``.
    Adds ``_root``, the group's smallest fingerprint, and ``component_id``, its smallest key."""
    prints = written(
        marked.groupBy("_print").agg(F.min(key).alias("_least")), "distinct-fingerprints"
    )
    roots = components(links(prints.select("_print")))
    rooted = prints.join(roots, F.col("_print") == F.col("_node"), "left").select(
        "_print", "_least", F.coalesce("_root", "_print").alias("_root")
    )
    groups = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_print = written(rooted.join(groups, "_root").select("_print", "_root", "component_id"), "groups")
    return marked.select(key, "_print").join(by_print, "_print")


def near_duplicates(
    docs: DataFrame,
    radius: int = RADIUS,
    chunk: int = CHUNK,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row for each document: key, fingerprint, and the smallest key of its group."""
    mark = fingerprints(F.col(f"`{text}`"), shingle)
    marked = written(docs.select(F.col(f"`{key}`").alias(key), mark.alias("_print")), "fingerprints")
    return grouped(marked, lambda prints: print_links(prints, radius, chunk), key).select(
        key, hex16(F.col("_print")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, groups: DataFrame, mark: Column, key: str) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest key, of several
    with that key the one with the smallest fingerprint. A document without a key stays only if
    nothing in its group has one, and then once for each fingerprint. ``mark`` is a document's
    fingerprint; a key may repeat in other groups or with other texts."""
    rows = written(groups.groupBy("_root", key, "_print").agg(F.count("*").alias("_n")), "group-rows")
    named = rows.where(F.col(key).isNotNull())
    best = named.groupBy("_root").agg(F.min(F.struct(key, "_print", "_n")).alias("_best"))
    nameless = rows.join(named.select("_root").distinct(), "_root", "left_anti")
    kept = best.select(f"_best.{key}", "_best._print", "_best._n").unionByName(
        nameless.select(key, "_print", "_n")
    )
    kept = written(kept, "kept")
    own = fresh(docs, "_kept")
    name, its = fresh(docs, "_name"), fresh(docs, "_its")
    chosen = docs.withColumn(own, mark).join(
        kept.select(F.col(key).alias(name), F.col("_print").alias(its)),
        F.col(f"`{key}`").eqNullSafe(F.col(name)) & (F.col(own) == F.col(its)),
        "left_semi",
    )
    if not kept.where("_n > 1").isEmpty():
        chosen = chosen.dropDuplicates([key, own])
    return chosen.select(*without(docs))


def one_of_each_group(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    chunk: int = CHUNK,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One document of each group, see ``representatives``. The documents are written with their fingerprints, which are
    computed once."""
    own = fresh(docs, "_mark")
    marked = written(docs.withColumn(own, fingerprints(F.col(f"`{text}`"), shingle)), "marked-documents")
    prints = marked.select(F.col(f"`{key}`").alias(key), F.col(own).alias("_print"))
    groups = grouped(prints, lambda prints: print_links(prints, radius, chunk), key)
    return representatives(marked, groups, F.col(own), key).drop(own)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
