"""Synthetic landing batches and fault injection, as Spark jobs.

Every generator is a projection over a DataFrame of integer keys, so the
rows are produced on the executors in parallel: ``spark.range`` for the
stand-alone batches, or any key column of an existing table. Random
choices are ``xxhash64(seed, salt, key)`` mapped to an index or to
[0, 1), so a batch is reproducible for a seed and independent of how it
is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import fs
from strata.sources.io import write_batch
from strata.sources.paths import Lake

# Generator domains and the first customer id.
CITIES = ["São Paulo", "Rio de Janeiro", "Belo Horizonte", "Curitiba", "Porto Alegre"]
STATES = ["SP", "RJ", "MG", "PR", "RS"]
PRODUCTS = ["Laptop", "Smartphone", "Tablet", "Monitor", "Keyboard"]
FIRST_CUSTOMER_ID = 1001

# Workload sizes and price ranges of the clean and dirty batches.
CLEAN_CUSTOMERS = 100_000
CLEAN_SALES = 1_000_000
CLEAN_PRICE_RANGE = (10.0, 5000.0)
DIRTY_CUSTOMERS = 1_000
DIRTY_SALES = 5_000
DIRTY_PRICE_RANGE = (-500.0, 5000.0)
DIRTY_NULL_CUSTOMER_IDS = 11
DIRTY_NULL_SALE_IDS = 51

_UNIT = 2**53


def _hash(seed: int, salt: str, key: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), key)


def pick(values: list[str], seed: int, salt: str, key: Column) -> Column:
    """Uniform choice from ``values`` keyed by ``key``."""
    idx = F.pmod(_hash(seed, salt, key), F.lit(len(values))) + F.lit(1)
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast(T.IntegerType()))


def unit_uniform(seed: int, salt: str, key: Column) -> Column:
    """Uniform double in [0, 1) keyed by ``key``."""
    return F.pmod(_hash(seed, salt, key), F.lit(_UNIT)).cast(T.DoubleType()) / F.lit(float(_UNIT))


def customers_from_index(index: DataFrame, i: str = "i", seed: int = 42) -> DataFrame:
    """Customers for 1-based indexes: id ``1000+i``, ``Customer_i``,
    ``customer_i@example.com``, random city and state (independent)."""
    k = F.col(i)
    return index.select(
        (k + F.lit(FIRST_CUSTOMER_ID - 1)).alias("id"),
        F.concat(F.lit("Customer_"), k.cast(T.StringType())).alias("name"),
        F.concat(F.lit("customer_"), k.cast(T.StringType()), F.lit("@example.com")).alias("email"),
        pick(CITIES, seed, "city", k).alias("city"),
        pick(STATES, seed, "state", k).alias("state"),
    )


def sales_from_index(
    index: DataFrame,
    n_customers: int,
    amount_range: tuple[float, float],
    sale_date: str,
    customer_id_offset: int = 0,
    i: str = "i",
    seed: int = 42,
) -> DataFrame:
    """Sales for 1-based indexes: id ``i``; customer id uniform in
    [1001, 1001 + n_customers + offset); price uniform in [low, high);
    random product; one date for the batch."""
    low, high = amount_range
    k = F.col(i)
    span = n_customers + customer_id_offset
    return index.select(
        k.alias("id"),
        (F.pmod(_hash(seed, "customer", k), F.lit(span)) + F.lit(FIRST_CUSTOMER_ID)).alias("customer_id"),
        (F.lit(low) + F.lit(high - low) * unit_uniform(seed, "price", k)).alias("price"),
        pick(PRODUCTS, seed, "product", k).alias("product"),
        F.lit(sale_date).alias("date"),
    )


def _index(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(1, n + 1, numPartitions=partitions).withColumnRenamed("id", "i")


def generate_customers(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    return customers_from_index(_index(spark, n, partitions), seed=seed)


def generate_sales(
    spark: SparkSession,
    n: int,
    n_customers: int,
    amount_range: tuple[float, float],
    sale_date: str,
    customer_id_offset: int = 0,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    return sales_from_index(
        _index(spark, n, partitions), n_customers, amount_range, sale_date, customer_id_offset, seed=seed
    )


def _null_first(index: Column, count: int, value: Column) -> Column:
    """NULL for the first ``count`` 1-based indexes, else ``value``."""
    return F.when(index <= F.lit(count), F.lit(None).cast(T.LongType())).otherwise(value)


def dirty_customers_from_index(index: DataFrame, i: str = "i", seed: int = 42) -> DataFrame:
    """Customers whose first 11 ids are NULL."""
    base = customers_from_index(index, i, seed)
    first = F.col("id") - F.lit(FIRST_CUSTOMER_ID - 1)
    return base.withColumn("id", _null_first(first, DIRTY_NULL_CUSTOMER_IDS, F.col("id")))


def dirty_sales_from_index(
    index: DataFrame, n_customers: int, sale_date: str, i: str = "i", seed: int = 42
) -> DataFrame:
    """Sales priced in [-500, 5000) whose first 51 ids are NULL."""
    base = sales_from_index(index, n_customers, DIRTY_PRICE_RANGE, sale_date, i=i, seed=seed)
    return base.withColumn("id", _null_first(F.col("id"), DIRTY_NULL_SALE_IDS, F.col("id")))


def write_landing(lake: Lake, execution_date: str, sales: DataFrame | None, customers: DataFrame | None) -> None:
    """Sales as CSV with a header, customers as newline JSON, under ``dt=``."""
    paths = lake.paths(execution_date)
    if sales is not None:
        write_batch(sales, paths["sales_landing"], "csv")
    if customers is not None:
        write_batch(customers, paths["customers_landing"], "json")


def clean_batch(
    spark: SparkSession,
    lake: Lake,
    execution_date: str,
    n_customers: int = CLEAN_CUSTOMERS,
    n_sales: int = CLEAN_SALES,
    seed: int = 42,
) -> None:
    customers = generate_customers(spark, n_customers, seed).withColumn("created_at", F.lit(execution_date))
    sales = generate_sales(spark, n_sales, n_customers, CLEAN_PRICE_RANGE, execution_date, seed=seed)
    write_landing(lake, execution_date, sales, customers)


def dirty_batch(
    spark: SparkSession,
    lake: Lake,
    execution_date: str,
    n_customers: int = DIRTY_CUSTOMERS,
    n_sales: int = DIRTY_SALES,
    seed: int = 42,
) -> None:
    customers = dirty_customers_from_index(_index(spark, n_customers), seed=seed).withColumn(
        "created_at", F.lit(execution_date)
    )
    sales = dirty_sales_from_index(_index(spark, n_sales), n_customers, execution_date, seed=seed)
    write_landing(lake, execution_date, sales, customers)


# --- Fault injection -------------------------------------------------------
#
# Each corruptor maps a column of integer keys ``n`` to corrupt rows, so it
# runs over ``spark.range`` (the stand-alone batches below) or over the keys
# of any table.

# The corrupt batches, per batch in column order — key range
# (half-open), every-n-th-key rules, literal values.
LANDING_SALES_KEYS = (1, 101)
LANDING_SALES_NULL_ID_EVERY = 10
LANDING_SALES_NEGATIVE_EVERY = 15
LANDING_SALES_NEGATIVE_PRICE = -100.0
LANDING_SALES_PRICE = 50.0
LANDING_SALES_DATE = "2024-01-01"
LANDING_SALES_CUSTOMER_ID = 1
LANDING_SALES_PRODUCT = "Produto Corrompido"

LANDING_CUSTOMERS_KEYS = (1, 51)
LANDING_CUSTOMERS_EMAIL_PREFIX = "invalid-email-"
LANDING_CUSTOMERS_NAME_PREFIX = "User "
LANDING_CUSTOMERS_CITY = "São Paulo"
LANDING_CUSTOMERS_STATE = "SP"

BRONZE_SALES_KEYS = (1000, 1050)
BRONZE_SALES_CUSTOMER_ID = 101
BRONZE_SALES_NULL_PRODUCT_EVERY = 5
BRONZE_SALES_PRODUCT = "Fake Product"
BRONZE_SALES_PRICE = -10.5
BRONZE_SALES_DATE = "1900-01-01"
BRONZE_SALES_DOMAIN = "sales"
BRONZE_SALES_SOURCE_FILE = "corrupted_ingest.csv"

BRONZE_CUSTOMERS_KEYS = (2000, 2050)
BRONZE_CUSTOMERS_NULL_ID_EVERY = 3
BRONZE_CUSTOMERS_NAME = "Corrupted User"
BRONZE_CUSTOMERS_EMAIL = "corrupted@mail.com"
BRONZE_CUSTOMERS_CITY = "Rio de Janeiro"
BRONZE_CUSTOMERS_STATE = "RJ"
BRONZE_CUSTOMERS_DOMAIN = "customers"
BRONZE_CUSTOMERS_SOURCE_FILE = "corrupted_ingest.json"

SILVER_SALES_KEYS = (5000, 5010)
SILVER_SALES_CUSTOMER_ID = 1
SILVER_SALES_PRODUCT = "Silver Corruption"
SILVER_SALES_PRICE = 999999.99
SILVER_SALES_DATE = "2026-04-20"


def _every(n: Column, k: int) -> Column:
    return (n % F.lit(k)) == F.lit(0)


def _null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def _long(value: int) -> Column:
    return F.lit(value).cast(T.LongType())


def _now(now: Column | None) -> Column:
    return now if now is not None else F.current_timestamp()


def corrupt_landing_sales(keys: DataFrame, n: str = "n") -> DataFrame:
    """NULL id on every 10th key, a negative price on every 15th."""
    k = F.col(n)
    return keys.select(
        F.when(_every(k, LANDING_SALES_NULL_ID_EVERY), _null(T.LongType())).otherwise(k).alias("id"),
        F.when(_every(k, LANDING_SALES_NEGATIVE_EVERY), F.lit(LANDING_SALES_NEGATIVE_PRICE))
        .otherwise(F.lit(LANDING_SALES_PRICE))
        .alias("price"),
        F.lit(LANDING_SALES_DATE).alias("date"),
        _long(LANDING_SALES_CUSTOMER_ID).alias("customer_id"),
        F.lit(LANDING_SALES_PRODUCT).alias("product"),
    )


def corrupt_landing_customers(keys: DataFrame, created_at: str, n: str = "n") -> DataFrame:
    """Every email invalid (no ``@``)."""
    k = F.col(n)
    return keys.select(
        k.alias("id"),
        F.concat(F.lit(LANDING_CUSTOMERS_EMAIL_PREFIX), k.cast(T.StringType())).alias("email"),
        F.concat(F.lit(LANDING_CUSTOMERS_NAME_PREFIX), k.cast(T.StringType())).alias("name"),
        F.lit(LANDING_CUSTOMERS_CITY).alias("city"),
        F.lit(LANDING_CUSTOMERS_STATE).alias("state"),
        F.lit(created_at).alias("created_at"),
    )


def corrupt_bronze_sales(keys: DataFrame, n: str = "n", now: Column | None = None) -> DataFrame:
    """Negative price on every row, NULL product on every 5th key, a date
    long before any sale."""
    k = F.col(n)
    return keys.select(
        k.alias("id"),
        _long(BRONZE_SALES_CUSTOMER_ID).alias("customer_id"),
        F.when(_every(k, BRONZE_SALES_NULL_PRODUCT_EVERY), _null(T.StringType()))
        .otherwise(F.lit(BRONZE_SALES_PRODUCT))
        .alias("product"),
        F.lit(BRONZE_SALES_PRICE).alias("price"),
        F.lit(BRONZE_SALES_DATE).cast(T.DateType()).alias("sale_date"),
        _now(now).alias("_ingested_at"),
        F.lit(BRONZE_SALES_DOMAIN).alias("_domain"),
        F.lit(BRONZE_SALES_SOURCE_FILE).alias("_source_file"),
    )


def corrupt_bronze_customers(keys: DataFrame, n: str = "n", now: Column | None = None) -> DataFrame:
    """NULL customer_id on every 3rd key."""
    k = F.col(n)
    return keys.select(
        F.when(_every(k, BRONZE_CUSTOMERS_NULL_ID_EVERY), _null(T.LongType())).otherwise(k).alias("customer_id"),
        F.lit(BRONZE_CUSTOMERS_NAME).alias("name"),
        F.lit(BRONZE_CUSTOMERS_EMAIL).alias("email"),
        F.lit(BRONZE_CUSTOMERS_CITY).alias("city"),
        F.lit(BRONZE_CUSTOMERS_STATE).alias("state"),
        _now(now).alias("_ingested_at"),
        F.lit(BRONZE_CUSTOMERS_DOMAIN).alias("_domain"),
        F.lit(BRONZE_CUSTOMERS_SOURCE_FILE).alias("_source_file"),
    )


def corrupt_silver_sales(keys: DataFrame, n: str = "n", now: Column | None = None) -> DataFrame:
    """A price far over the silver price bound."""
    k = F.col(n)
    return keys.select(
        k.alias("id"),
        _long(SILVER_SALES_CUSTOMER_ID).alias("customer_id"),
        F.lit(SILVER_SALES_PRODUCT).alias("product"),
        F.lit(SILVER_SALES_PRICE).alias("price"),
        F.lit(SILVER_SALES_DATE).cast(T.DateType()).alias("sale_date"),
        _now(now).alias("_processed_at"),
    )


def _keys(spark: SparkSession, bounds: tuple[int, int]) -> DataFrame:
    return spark.range(bounds[0], bounds[1]).withColumnRenamed("id", "n")


def corrupt_landing(spark: SparkSession, lake: Lake, execution_date: str) -> None:
    """Replace the date's landing batches with the corrupt ones."""
    write_landing(
        lake,
        execution_date,
        corrupt_landing_sales(_keys(spark, LANDING_SALES_KEYS)),
        corrupt_landing_customers(_keys(spark, LANDING_CUSTOMERS_KEYS), execution_date),
    )


def corrupt_bronze(spark: SparkSession, lake: Lake, execution_date: str) -> None:
    """Replace the date's bronze batches with the corrupt ones."""
    paths = lake.paths(execution_date)
    write_batch(corrupt_bronze_sales(_keys(spark, BRONZE_SALES_KEYS)), paths["sales_bronze"], "parquet")
    write_batch(
        corrupt_bronze_customers(_keys(spark, BRONZE_CUSTOMERS_KEYS)), paths["customers_bronze"], "parquet"
    )


def corrupt_silver(spark: SparkSession, lake: Lake, execution_date: str) -> str:
    """Publish a corrupt silver sales version; returns its version id."""
    from strata.sources import snapshot

    path = lake.paths(execution_date)["sales_silver"]
    version = "corrupt"
    target = snapshot.version_path(path, version)
    fs.delete(spark, target)
    write_batch(corrupt_silver_sales(_keys(spark, SILVER_SALES_KEYS)), target, "parquet")
    snapshot.publish(spark, path, version)
    return version
