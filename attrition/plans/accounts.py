"""Customer accounts derived from the customer and order tables.

``orders`` is reduced to one row per customer before the join, with map-side partial sums, so a
customer with a third of all orders costs one partial row per task. A customer without orders is an
account with tenure and salary 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def flag(condition):
        return F.max(F.when(condition, 1).otherwise(0))

    orders = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max("o_totalprice").alias("top_price"),
            flag(F.col("o_orderstatus") == "P").alias("has_p"),
            flag(F.col("o_orderdate") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")).alias(
                "recent"
            ),
        )
    )
    key, n = F.col("c_custkey"), F.col("n_orders")
    base = (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .fillna({"n_orders": 0, "top_price": 0.0, "has_p": 0, "recent": 0})
        .select(
            key.alias("CustomerId"),
            F.col("c_name").alias("Surname"),
            (300 + (key * 37) % 551).cast("int").alias("CreditScore"),
            F.when(F.col("c_nationkey") % 3 == 0, "France")
            .when(F.col("c_nationkey") % 3 == 1, "Germany")
            .otherwise("Spain")
            .alias("Geography"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("Gender"),
            (18 + (key * 7919) % 65).cast("int").alias("Age"),
            (n % 11).cast("int").alias("Tenure"),
            F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(0.0).alias("Balance"),
            (1 + (n + key) % 4).cast("int").alias("NumOfProducts"),
            F.col("has_p").cast("int").alias("HasCrCard"),
            F.col("recent").cast("int").alias("IsActiveMember"),
            F.col("top_price").alias("EstimatedSalary"),
        )
    )
    leaving = ((F.col("Age") >= 50) & (F.col("IsActiveMember") == 0)) | (
        (F.col("Balance") > 8000) & (F.col("NumOfProducts") >= 3)
    )
    return base.withColumn("Exited", F.when(leaving, 1).otherwise(0))
