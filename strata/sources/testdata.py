"""The star-schema test tables mapped onto the sales / customers domain.

``orders`` plays the sales landing batch and ``customer`` the customers
landing batch. Each mapping is a plain projection, so every query built
on them scans the whole table and grows with it; Catalyst prunes the
unused columns at the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where the smallest test tables lie.
SF_SMALL = "/root/testdata/sf0.001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales landing columns: id, customer_id, product, price, date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("date"),
    )


def landing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landing columns: id, name, email, city, state."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.lower("c_mktsegment").alias("state"),
    )


def every(key: Column | str, n: int) -> Column:
    """True on every ``n``-th key (``key % n = 0``): the fault-injection rule."""
    k = F.col(key) if isinstance(key, str) else key
    return (k % F.lit(n)) == F.lit(0)
