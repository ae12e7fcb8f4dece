"""URL filters by a sort-merge range join over reversed-host keys.

A rule is a host and the start of a path; it fits the host and its subdomains where the URL's path
starts so. With the labels of a host reversed, everything that one rule covers at one depth of the
host is a range of keys, and any two ranges are nested or apart. Rules and URLs are sorted together
by key. The sweep carries the stack of the rules that are open at a place: the last rule before a
URL and the rules around it. Those of the stack that the URL's key starts with are active there, and
the longest of them decides.

The sort is a range partitioning on (key, hash of the URL), so a host or a URL with any share of the
rows is spread over tasks; every range starts with the stack that the ranges before it leave open.
URLs are reduced to distinct (host, path) pairs before the sweep.

Cases: a null URL or one without ``://`` has an empty host and path and no rule; rules given twice
count once, and of contradicting ones the alphabetically later verdict (block) holds; an empty table
or an empty rule list gives the default verdict for all rows; repeated rows are judged alike; input
columns named host, path, rule or verdict are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import fresh, lower_ascii, partitions, read, without, written

#: Host, start of path, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
OUTPUT = ("host", "path", "rule", "verdict")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _key(labels: Column, depth: Column, path: Column) -> Column:
    """Depth and reversed host, each label closed by a dot, then the path."""
    host = F.array_join(F.slice(labels, 1, depth), ".")
    return F.concat(F.lpad(depth.cast("string"), 5, "0"), F.lit(":"), host, F.lit("."), path)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the stack of the rules open there: itself and all that enclose it.
    A stack is at most as long as the rule's path."""
    keyed = (
        rules.select(lower_ascii(F.col("host")).alias("_host"), "path", "verdict")
        .withColumn("_labels", _labels(F.col("_host")))
        .withColumn("_depth", F.size("_labels"))
        .select(
            _key(F.col("_labels"), F.col("_depth"), F.col("path")).alias("_key"),
            F.concat("_host", "path").alias("_rule"),
            (F.length("_host") + 7).alias("_least"),
            "_depth",
            "verdict",
        )
        .groupBy("_key", "_rule", "_least", "_depth")
        .agg(F.max("verdict").alias("_verdict"))
    )
    around = keyed.select(
        F.col("_key").alias("_inner"),
        "_depth",
        F.explode(F.sequence("_least", F.length("_key"))).alias("_n"),
    ).select("_inner", "_depth", F.expr("substring(_inner, 1, _n)").alias("_key"))
    return (
        around.join(keyed.drop("_depth"), "_key")
        .groupBy(F.col("_inner").alias("_key"), "_depth")
        .agg(F.collect_list(F.struct("_key", "_rule", "_verdict")).alias("_stack"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, the longest fitting rule (host and path as one text, or null) and
    the verdict. ``rules`` has the columns host, path and verdict."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(f"`{url}`"))
    rows = pages.select(*without(pages, *OUTPUT), host.alias("host"), path.alias("path"))

    stacks = rule_stacks(rules)
    depths = sorted(r[0] for r in stacks.select("_depth").distinct().collect())  # of host names
    if not depths:
        none = F.lit(None).cast("string")
        return rows.withColumns({"rule": none, "verdict": F.lit(default)})

    at = F.array(*[F.lit(d) for d in depths])
    urls = (
        rows.select("host", "path")
        .distinct()
        .withColumn("_labels", _labels(F.col("host")))
        .select(
            "host", "path", "_labels",
            F.explode(F.filter(at, lambda d: d <= F.size("_labels"))).alias("_depth"),
        )
        .select("host", "path", _key(F.col("_labels"), F.col("_depth"), F.col("path")).alias("_key"))
        .withColumns({"_tie": F.xxhash64("host", "path"), "_is_url": F.lit(1)})
    )
    events = urls.unionByName(
        stacks.drop("_depth").withColumns({"_tie": F.lit(-(2**63)), "_is_url": F.lit(0)}),
        allowMissingColumns=True,
    )
    ordered = written(
        events.repartitionByRange(partitions(spark), "_key", "_is_url", "_tie").withColumn(
            "_part", F.spark_partition_id()
        ),
        "url-sweep",
    )
    # What the ranges before leave open; one row for each range.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        ordered.groupBy("_part")
        .agg(F.max_by("_stack", F.when(F.col("_is_url") == 0, F.col("_key"))).alias("_last"))
        .select("_part", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    )
    sweep = W.partitionBy("_part").orderBy("_key", "_is_url").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    open_rules = F.coalesce(F.last("_stack", ignorenulls=True).over(sweep), F.col("_carried"))
    active = F.filter("_open", lambda r: F.startswith(F.col("_key"), r["_key"]))
    longest = F.transform(
        active, lambda r: F.struct(F.length(r["_rule"]), r["_rule"], r["_verdict"])
    )
    decided = (
        ordered.join(carried, "_part")
        .withColumn("_open", open_rules)
        .where("_is_url = 1")
        .select("host", "path", F.array_max(longest).alias("_best"))
        .groupBy("host", "path")
        .agg(F.max("_best").alias("_best"))
        .where("_best IS NOT NULL")
    )
    best = fresh(rows, "_best")
    return rows.join(decided.withColumnRenamed("_best", best), ["host", "path"], "left").select(
        *without(rows, *OUTPUT),
        "host",
        "path",
        F.col(best)["_rule"].alias("rule"),
        F.coalesce(F.col(best)["_verdict"], F.lit(default)).alias("verdict"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", *OUTPUT)


ORACLE = """
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages),
q AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
j AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
      THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
      THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM q)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
