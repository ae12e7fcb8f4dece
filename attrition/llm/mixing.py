"""Mixing sources to target weights by Poisson replication.

A source with n documents and the target share w of a mix of T documents is repeated at the mean
rate w T / n. Each document gets a number of copies by inverting the Poisson distribution of that
mean at a number in [0, 1) taken from the MD5 of the seed and the document's key and text: the same copies on
any partitioning and after any retry, and no state between documents. The copies are exploded and
shuffled globally by a hash of key, text and copy, and of where the document was read, so a source, a key
(or a missing one) or a text with any share of the rows is spread over all tasks.

Rates above ``PART`` are drawn as a sum of several draws of equal mean, so no power of e underflows.

Cases: a null source is a source of its own, with weight under the key None; sources without a
target weight get none (rate 0) when weights are given; a null key or text is hashed as empty text; rows
equal in key, source and text get the same number of copies, others draw apart even if their keys are equal; an empty table gives an empty mix; a null or
empty text is a document like any other; a column named as the copy number is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import fresh, partitions, read, without, written

PART = 16.0
#: Upper end of the inversion for one draw of mean PART; the chance to exceed it is below 1e-18.
MOST = 80
#: Sources are broadcast up to this number.
BROADCAST_ROWS = 100_000


def uniform(key: Column, seed: int, part: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), part.cast("string"), F.lit(":"), key)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def poisson(rate: Column, key: Column, seed: int) -> Column:
    """Number of copies: the draw of mean ``rate`` that belongs to ``key``."""
    parts = F.ceil(rate / PART).cast("int")
    mean = rate / parts

    def draw(part: Column) -> Column:
        u = uniform(key, seed, part)
        start = F.struct(
            F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.lit(0).alias("n")
        )

        def step(acc: Column, k: Column) -> Column:
            term = acc["term"] * mean / k
            return F.struct(
                term.alias("term"),
                (acc["total"] + term).alias("total"),
                (acc["n"] + F.when(u >= acc["total"], 1).otherwise(0)).alias("n"),
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step, lambda acc: acc["n"])

    total = F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0), lambda acc, part: acc + draw(part)
    )
    return F.when(rate > 0, total).otherwise(0)


def source_rates(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    epochs: float = 1.0,
    source: str = "source",
) -> DataFrame:
    """One row for each source: its documents and its mean repetition rate.

    Without ``weights``, a source's weight is its number of documents to the power ``temperature``;
    the mix has ``epochs`` times as many documents as the input, on average."""
    counts = docs.groupBy(F.col(f"`{source}`").alias("_source")).agg(F.count("*").alias("_docs"))
    if weights is None:
        weighted = counts.withColumn("_weight", F.pow("_docs", F.lit(temperature)))
    else:
        table = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "_name string, _weight double"
        )
        weighted = counts.join(
            table, F.col("_source").eqNullSafe(F.col("_name")), "left"
        ).select("_source", "_docs", F.coalesce("_weight", F.lit(0.0)).alias("_weight"))
    weighted = written(weighted, "source-weights")
    every, weight = weighted.agg(F.sum("_docs"), F.sum("_weight")).first()
    share = F.col("_weight") / F.lit(float(weight or 1)) * F.lit(float(every or 0) * epochs)
    rate = F.when(F.col("_weight") > 0, share / F.col("_docs")).otherwise(F.lit(0.0))
    return weighted.select("_source", "_docs", rate.alias("_rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    copy: str | None = None,
    text: str = "text",
) -> DataFrame:
    """The mix, in random order; ``copy`` names a column for the number of each copy, from 1."""
    spark = docs.sparkSession
    rates = source_rates(docs, weights, temperature, epochs, source).drop("_docs")
    if rates.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rates = F.broadcast(rates)
    own, rate, n, number, order, hashed, place = (
        fresh(docs, c) for c in ("_source", "_rate", "_n", "_copy", "_order", "_name", "_place")
    )
    rates = rates.withColumnsRenamed({"_source": own, "_rate": rate})
    own_text = F.md5(F.encode(F.col(f"`{text}`"), "utf-8")) if text in docs.columns else F.lit("")
    name = F.concat_ws(":", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(own_text, F.lit("")))
    kept = without(docs, copy) if copy else without(docs)
    copies = (
        docs.join(rates, F.col(f"`{source}`").eqNullSafe(F.col(own)))
        # Exploded, so that it is computed once; a projected one would be put into each step of the draw.
        .withColumn(hashed, F.explode(F.array(name)))
        .withColumn(n, poisson(F.col(rate), F.col(hashed), seed))
        .where(F.col(n) > 0)
        .withColumn(number, F.explode(F.sequence(F.lit(1), F.col(n))))
        .withColumn(order, F.md5(F.concat(F.lit(f"{seed}:order:"), F.col(hashed), F.lit(":"), F.col(number))))
        # Rows that are equal in all respects would follow each other into one task.
        .withColumn(place, F.monotonically_increasing_id() % 8191)
        .select(*kept, number, order, place)
    )
    return (
        copies.repartition(partitions(spark), order, place)
        .sortWithinPartitions(order)
        .select(*kept, *([F.col(number).alias(copy)] if copy else []))
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, copy="copy").select(
        "doc_id", "source", "copy", F.md5(F.encode("text", "utf-8")).alias("text_md5")
    )


ORACLE = f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS docs, sqrt(count(*)) AS weight FROM documents GROUP BY source),
r AS (SELECT source, weight / (SELECT sum(weight) FROM s) * (SELECT sum(docs) FROM s) / docs AS rate FROM s),
c(source, rate, k, term, total) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM r
  UNION ALL SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
  FROM c WHERE k < {MOST - 1}),
u AS (SELECT doc_id, source, md5(text) AS text_md5,
  ('0x' || substr(md5('0:1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 13))::BIGINT
    / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.source, u.text_md5, u.u, count(*) AS n FROM u
  JOIN c ON u.source IS NOT DISTINCT FROM c.source AND u.u >= c.total GROUP BY ALL)
SELECT doc_id, source, unnest(range(1, n + 1))::INTEGER AS copy, text_md5 FROM n
"""
