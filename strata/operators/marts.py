"""Gold mart and the KPI aggregates read from it.

``sales_summary`` is revenue by (region, sale_month) over silver sales left
joined to silver customers. The plan depends on the customers' row count,
measured on the silver table (a metadata count for Parquet), times the width
of a row as it is broadcast; compressed file sizes say nothing about that:

* under the threshold, customers are broadcast: sales are joined where
  they are read and summed straight to (region, month); sales are never
  shuffled, only the partial aggregates of a few groups per task (and the
  small customers side, counted per id and region before broadcasting);
* over it, sales are first summed per (customer_id, sale_month) and only
  those partial sums meet the customers in a shuffle join. The join then
  moves one row per customer and month instead of one per sale, and a hot
  customer (or the NULL key of unmatched sales) collapses to a handful of
  rows in the map-side combine before any shuffle.

Customer rows are first counted per (customer_id, region): a customer id
present k times joins once and scales its sums by k, which is what the
k-fold fan-out of the plain left join adds up to, without emitting the
pairs. Sums and counts are distributive and the average is carried as
(sum, count), so both plans equal join-then-aggregate, including the fan-out
over duplicate customer rows and the NULL region of unmatched sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import mean_ticket, month_start


def _customer_regions(silver_customers: DataFrame) -> DataFrame:
    return silver_customers.select(
        F.col("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("uf").alias("region"),
    )


# Salt range for sales whose customer_id is NULL (see ``enrich_sales``).
NULL_KEY_SPREAD = 1024


def _zero_of(key: str) -> Column:
    """0 for a known key, computed from the key so that the optimizer keeps
    it a join key (a literal 0 would be folded into a post-join filter)."""
    return F.col(key).cast(T.LongType()) * F.lit(0)


def enrich_sales(silver_sales: DataFrame, silver_customers: DataFrame) -> DataFrame:
    """Row-level enriched sales: each sale with its customer's name and region.

    Unmatched sales (no customer, or NULL ``customer_id``) keep NULL name
    and region; a customer id present twice yields the sale twice.

    The join key is (customer_id, salt): salt is 0 on both sides for known
    ids and a spread value for sales with a NULL id. NULL never equals
    anything, so the result is unchanged, but those sales no longer hash
    to one shuffle partition when the join is not broadcast — the NULL key
    may carry a large share of all sales.
    """
    sales = silver_sales.select(
        F.col("id"),
        F.col("price").alias("sale_value"),
        F.col("sale_date"),
        F.col("customer_id"),
        F.when(F.col("customer_id").isNull(), F.pmod(F.xxhash64("id", "sale_date", "price"), F.lit(NULL_KEY_SPREAD)))
        .otherwise(_zero_of("customer_id"))
        .alias("_salt"),
    )
    customers = _customer_regions(silver_customers).withColumn("_salt", _zero_of("customer_id"))
    joined = sales.join(customers, on=["customer_id", "_salt"], how="left")
    return joined.select(
        "id",
        "sale_value",
        "sale_date",
        "customer_name",
        "region",
        month_start("sale_date").alias("sale_month"),
    )


# Bytes of a broadcast customer row: id, region text, count and row header.
BROADCAST_ROW_BYTES = 96
MAX_BROADCAST_BYTES = 10 << 20


def fits_broadcast(silver_customers: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the customers' measured row count bounds the broadcast side."""
    return silver_customers.count() * BROADCAST_ROW_BYTES <= max_bytes


def _summary(grouped: DataFrame, ordered: bool = True) -> DataFrame:
    out = grouped.select(
        F.col("region"),
        F.col("sale_month"),
        F.col("total_revenue"),
        F.col("total_orders").cast(T.LongType()).alias("total_orders"),
        mean_ticket("total_revenue", "priced").alias("avg_ticket"),
    )
    return out.orderBy(F.desc_nulls_last("total_revenue")) if ordered else out


def sales_summary(
    silver_sales: DataFrame, silver_customers: DataFrame, strategy: str = "auto", ordered: bool = True
) -> DataFrame:
    """Gold ``sales_summary``: region, sale_month, total_revenue,
    total_orders (non-NULL ids), avg_ticket (mean price, rounded to cents),
    ordered by total_revenue descending.

    ``strategy``: ``auto`` (by the size check), ``broadcast`` or
    ``pre_aggregate``. ``ordered=False`` leaves out the final sort, for
    consumers that aggregate the mart again (the KPIs): Spark keeps a sort
    under a double sum, which would cost a range shuffle for nothing. ``avg_ticket`` is the mean of the
    unrounded prices, carried as (sum, count) and rounded at the end.
    """
    copies = region_copies(silver_customers)
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(silver_customers) else "pre_aggregate"
    # unmatched sales (no customer row) count once, in the NULL region
    m = F.coalesce(F.col("copies"), F.lit(1).cast(T.LongType()))
    if strategy == "broadcast":
        sales = silver_sales.select(
            "customer_id", "id", "price", month_start("sale_date").alias("sale_month")
        )
        joined = sales.join(F.broadcast(copies), on="customer_id", how="left")
        grouped = joined.groupBy("region", "sale_month").agg(
            F.sum(F.col("price") * m).alias("total_revenue"),
            F.sum(F.when(F.col("id").isNotNull(), m).otherwise(F.lit(0))).alias("total_orders"),
            F.sum(F.when(F.col("price").isNotNull(), m).otherwise(F.lit(0))).alias("priced"),
        )
        return _summary(grouped, ordered)
    if strategy != "pre_aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")
    per_customer_month = silver_sales.groupBy(
        F.col("customer_id"), month_start("sale_date").alias("sale_month")
    ).agg(
        F.sum("price").alias("revenue"),
        F.count("id").alias("orders"),
        F.count("price").alias("priced"),
    )
    joined = per_customer_month.join(copies.hint("merge"), on="customer_id", how="left")
    grouped = joined.groupBy("region", "sale_month").agg(
        F.sum(F.col("revenue") * m).alias("total_revenue"),
        F.sum(F.col("orders") * m).alias("total_orders"),
        F.sum(F.col("priced") * m).alias("priced"),
    )
    return _summary(grouped, ordered)


def region_copies(silver_customers: DataFrame) -> DataFrame:
    """(customer_id, region, copies): how many customer rows carry each id
    and region. A left join emits one row per copy; the mart only sums, so
    it joins these counts once and scales each sum by ``copies`` instead of
    emitting every (sale, copy) pair — a customer id repeated a million
    times stays one row here. NULL ids never match and are left out."""
    return (
        silver_customers.where(F.col("customer_id").isNotNull())
        .groupBy(F.col("customer_id"), F.col("uf").alias("region"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def sales_summary_direct(silver_sales: DataFrame, silver_customers: DataFrame) -> DataFrame:
    """The same mart as the plain join-then-aggregate, kept as a
    brute-force check for the planned variants."""
    enriched = enrich_sales(silver_sales, silver_customers)
    grouped = enriched.groupBy("region", "sale_month").agg(
        F.sum("sale_value").alias("total_revenue"),
        F.count("id").alias("total_orders"),
        F.count("sale_value").alias("priced"),
    )
    return _summary(grouped)


def dashboard_kpis(gold: DataFrame) -> DataFrame:
    """Headline figures: total revenue, total orders and the plain mean of
    the per-group ``avg_ticket`` values (a mean of means, as displayed)."""
    return gold.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").cast(T.LongType()).alias("total_orders"),
        F.avg("avg_ticket").alias("avg_ticket"),
    )


def revenue_by_region(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(F.sum("total_revenue").alias("total_revenue"))


def orders_by_region(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(
        F.sum("total_orders").cast(T.LongType()).alias("total_orders")
    )
