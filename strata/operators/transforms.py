"""Layer transforms, each ``DataFrame -> DataFrame``.

All are narrow (projection / filter): no shuffle, one stage, whole-stage
codegen end to end, and the ``price > 0`` filter reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import discounted


def bronze_sales(source: DataFrame) -> DataFrame:
    """Landing sales -> bronze: pinned column list, strict casts.

    ``price`` to DOUBLE and ``date`` to DATE fail the batch on bad text
    (ANSI casts); ``date`` is renamed ``sale_date``.
    """
    return source.select(
        F.col("id"),
        F.col("customer_id"),
        F.col("product"),
        F.col("price").cast(T.DoubleType()).alias("price"),
        F.col("date").cast(T.DateType()).alias("sale_date"),
    )


def bronze_customers(source: DataFrame) -> DataFrame:
    """Landing customers -> bronze: ``id`` becomes ``customer_id``; extra
    landing columns (``created_at``) are dropped."""
    return source.select(
        F.col("id").alias("customer_id"),
        F.col("name"),
        F.col("email"),
        F.col("city"),
        F.col("state"),
    )


def _processed_at(processed_at: Column | None) -> Column:
    return processed_at if processed_at is not None else F.current_timestamp()


def silver_sales(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Bronze sales -> silver: keep ``price > 0`` (drops NULL, zero and
    negative prices), add the discounted price and the processing time."""
    return bronze.where(F.col("price") > F.lit(0)).withColumns(
        {
            "price_with_discount": discounted("price"),
            "silver_processed_at": _processed_at(processed_at),
        }
    )


def silver_customers(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Bronze customers -> silver: add ``uf`` (upper-cased state) and the
    processing time."""
    return bronze.withColumns(
        {
            "uf": F.upper(F.col("state")),
            "silver_processed_at": _processed_at(processed_at),
        }
    )
