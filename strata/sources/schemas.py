"""Declared schemas for every layer.

Landing files are read with a declared schema (never inferred: inference
is a second full pass over the batch). Ids are integers on landing; price
and date stay text there and are cast strictly (ANSI) in bronze, so a bad
number or date fails the batch instead of becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


LANDING_SALES = _schema(
    ("id", T.LongType()),
    ("customer_id", T.LongType()),
    ("price", T.StringType()),
    ("product", T.StringType()),
    ("date", T.StringType()),
)

LANDING_CUSTOMERS = _schema(
    ("id", T.LongType()),
    ("name", T.StringType()),
    ("email", T.StringType()),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("created_at", T.StringType()),
)

BRONZE_SALES = _schema(
    ("id", T.LongType()),
    ("customer_id", T.LongType()),
    ("product", T.StringType()),
    ("price", T.DoubleType()),
    ("sale_date", T.DateType()),
)

BRONZE_CUSTOMERS = _schema(
    ("customer_id", T.LongType()),
    ("name", T.StringType()),
    ("email", T.StringType()),
    ("city", T.StringType()),
    ("state", T.StringType()),
)

SILVER_SALES = T.StructType(
    BRONZE_SALES.fields
    + [
        T.StructField("price_with_discount", T.DoubleType(), True),
        T.StructField("silver_processed_at", T.TimestampType(), True),
    ]
)

SILVER_CUSTOMERS = T.StructType(
    BRONZE_CUSTOMERS.fields
    + [
        T.StructField("uf", T.StringType(), True),
        T.StructField("silver_processed_at", T.TimestampType(), True),
    ]
)

SALES_SUMMARY = _schema(
    ("region", T.StringType()),
    ("sale_month", T.DateType()),
    ("total_revenue", T.DoubleType()),
    ("total_orders", T.LongType()),
    ("avg_ticket", T.DoubleType()),
)

RUN_LOG = _schema(
    ("run_id", T.StringType()),
    ("step", T.StringType()),
    ("execution_date", T.StringType()),
    ("status", T.StringType()),
    ("rows_in", T.LongType()),
    ("rows_out", T.LongType()),
    ("target_path", T.StringType()),
    ("target_format", T.StringType()),
    ("quarantine_path", T.StringType()),
    ("error", T.StringType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
)

GATE_RESULTS = _schema(
    ("run_id", T.StringType()),
    ("step", T.StringType()),
    ("execution_date", T.StringType()),
    ("suite", T.StringType()),
    ("expectation", T.StringType()),
    ("column_name", T.StringType()),
    ("element_count", T.LongType()),
    ("missing_count", T.LongType()),
    ("unexpected_count", T.LongType()),
    ("unexpected_percent", T.DoubleType()),
    ("success", T.BooleanType()),
    ("observed_values", T.ArrayType(T.DoubleType())),
)
