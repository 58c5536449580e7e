"""Registered queries over the test tables (their SQL oracles are in
``strata.plans.oracles``).

Every query scans whole tables: ``orders`` plays the sales landing batch,
``customer`` the customers landing batch (``strata.sources.testdata``).
Faults are injected by the reference's own key rules (every n-th key), so
gates and the left join's unmatched path see real data. Each key has an
equivalent SQL text that DuckDB runs over the same Parquet files.

Volatile columns (processing and ingestion times) are left out of the
compared output. Money sums are rounded to cents in both the query and
its oracle, since the order of floating additions differs between
engines and runs.

Queries that exercise sinks (round trips, publish, quarantine, run log)
write under the session's shared scratch folder (``spark.checkpoint.dir``)
and return a DataFrame that reads the written data back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import round_half_away
from strata.functions.expectations import (
    Expectation,
    Suite,
    between,
    match_regex,
    not_null,
    row_count_between,
)
from strata.operators import generate, marts, transforms
from strata.operators.gates import evaluate_suite
from strata.operators.ingest import with_lineage
from strata.plans import gate_queries, medallion
from strata.plans.steps import (
    Endpoint,
    GateFailed,
    Step,
    apply_transform,
    load_sql,
    publish_batch,
    read_run_log,
    run_step,
)
from strata.session import scratch_path
from strata.sources import fs, snapshot
from strata.sources.catalog import SourceCatalog
from strata.sources.io import read_batch, read_table, write_batch  # noqa: F401 (read_batch re-used by tools)
from strata.sources.paths import Lake, partition_dir
from strata.sources.sniff import read_sniffed
from strata.sources.schemas import BRONZE_CUSTOMERS, BRONZE_SALES
from strata.sources.testdata import every, landing_customers, landing_sales, table

QueryFn = Callable[[SparkSession, str], DataFrame]

# Batch dates used by the sink queries.
BATCH_DATE = "2026-04-19"
OTHER_DATES = ("2026-04-17", "2026-04-18")
# Order keys of one file of the raw landing batch (each file has its header).
RAW_KEYS_PER_PART = 10_000
# Fixed value: every 3rd order of the faulty batch carries an invalid email.
INVALID_EMAIL_EVERY = 3

_NULL_ID = generate.LANDING_SALES_NULL_ID_EVERY
_NEGATIVE = generate.LANDING_SALES_NEGATIVE_EVERY
_ORPHAN = generate.BRONZE_CUSTOMERS_NULL_ID_EVERY

# --- Spark side -------------------------------------------------------------


def _bronze_sales(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.bronze_sales(landing_sales(spark, sf))


def _bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.bronze_customers(landing_customers(spark, sf))


def _silver_sales(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.silver_sales(_bronze_sales(spark, sf))


def _silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.silver_customers(_bronze_customers(spark, sf))


def _silver_customers_with_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Silver customers with the corrupt-bronze fault: every 3rd key NULL.

    A third of the sales then match no customer and land in the NULL
    region: the unmatched path of the left join, and a hot NULL key.
    """
    df = _silver_customers(spark, sf)
    return df.withColumn(
        "customer_id",
        F.when(every("customer_id", _ORPHAN), F.lit(None).cast(T.LongType())).otherwise(F.col("customer_id")),
    )


def faulty_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales landing with faults: NULL id on every 10th key, negated price
    on every 15th, an invalid email on every 3rd."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(every(k, _NULL_ID), F.lit(None).cast(T.LongType())).otherwise(k).alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.when(every(k, _NEGATIVE), -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("price"),
        F.col("o_orderdate").alias("date"),
        F.when(every(k, INVALID_EMAIL_EVERY), F.concat(F.lit(generate.LANDING_CUSTOMERS_EMAIL_PREFIX), k.cast(T.StringType())))
        .otherwise(F.lit("ok@mail.com"))
        .alias("email"),
    )


def _drop_volatile(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at", "_ingested_at", "_processed_at")


def _cents(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: round_half_away(c, 2) for c in cols})


def q_bronze_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_sales(spark, sf)


def q_bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_customers(spark, sf)


def q_silver_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(_silver_sales(spark, sf))


def q_silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(_silver_customers(spark, sf))


def q_gold_enriched_sales(spark: SparkSession, sf: str) -> DataFrame:
    return marts.enrich_sales(_silver_sales(spark, sf), _silver_customers_with_orphans(spark, sf))


def gold(spark: SparkSession, sf: str, ordered: bool = True) -> DataFrame:
    return marts.sales_summary(
        _silver_sales(spark, sf), _silver_customers_with_orphans(spark, sf), ordered=ordered
    )


def q_gold_sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _cents(gold(spark, sf), "total_revenue")


def q_dashboard_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return _cents(marts.dashboard_kpis(gold(spark, sf, ordered=False)), "total_revenue", "avg_ticket")


def q_revenue_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return _cents(marts.revenue_by_region(gold(spark, sf, ordered=False)), "total_revenue")


def q_orders_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return marts.orders_by_region(gold(spark, sf, ordered=False))


def q_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    """A step without a transform passes its source through unchanged."""
    return apply_transform(spark, None, {"source_data": table(spark, sf, "customer")})


# The bronze sales step as SQL text over the bound source, with a bound parameter.
BRONZE_SALES_SQL = """
    SELECT id, customer_id, product, CAST(price AS DOUBLE) AS price, to_date(date) AS sale_date
    FROM {source_data} WHERE id >= :first_id OR id IS NULL
"""


def q_sql_transform(spark: SparkSession, sf: str) -> DataFrame:
    return apply_transform(spark, BRONZE_SALES_SQL, {"source_data": landing_sales(spark, sf)}, {"first_id": 100})


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv_roundtrip")
    write_batch(_bronze_sales(spark, sf), path, "csv")
    return read_batch(spark, path, "csv", BRONZE_SALES)


def q_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json_roundtrip")
    write_batch(_bronze_customers(spark, sf), path, "json")
    return read_batch(spark, path, "json", BRONZE_CUSTOMERS)


def q_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet_roundtrip")
    write_batch(q_silver_sales(spark, sf), path, "parquet")
    return read_batch(spark, path, "parquet")


def q_snapshot_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions written, the second published: readers see only it."""
    table_path = scratch_path(spark, "snapshot")
    write_batch(_bronze_customers(spark, sf), snapshot.version_path(table_path, "v1"), "parquet")
    snapshot.publish(spark, table_path, "v1")
    write_batch(q_silver_customers(spark, sf), snapshot.version_path(table_path, "v2"), "parquet")
    snapshot.publish(spark, table_path, "v2")
    return read_batch(spark, table_path, "snapshot")


def _publish_batch(spark: SparkSession, df: DataFrame, root: str, date: str) -> None:
    """Replace one ``dt=`` batch whole: staged write, then swap (T11-safe)."""
    publish_batch(spark, df, partition_dir(Lake(root).table("bronze", "sales_erp"), date), "parquet")


def q_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Dates d1, d2 written; d2 rewritten with an empty batch; d3 written
    twice. The table holds d1 and d3 once each, d2 is empty."""
    root = scratch_path(spark, "lake")
    bronze = _bronze_sales(spark, sf)
    d1, d2, d3 = OTHER_DATES[0], OTHER_DATES[1], BATCH_DATE
    _publish_batch(spark, bronze, root, d1)
    _publish_batch(spark, bronze, root, d2)
    _publish_batch(spark, bronze.where(F.col("price") < F.lit(0)), root, d2)
    _publish_batch(spark, bronze, root, d3)
    _publish_batch(spark, bronze, root, d3)
    return read_table(spark, Lake(root).table("bronze", "sales_erp"), "parquet")


def q_partition_prune(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    bronze = _bronze_sales(spark, sf)
    for d in (OTHER_DATES[1], BATCH_DATE):
        write_batch(bronze, partition_dir(Lake(root).table("bronze", "sales_erp"), d), "parquet")
    return read_table(spark, Lake(root).table("bronze", "sales_erp"), "parquet", execution_date=BATCH_DATE)


def q_ingest_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(with_lineage(table(spark, sf, "customer"), "customers"))


GATE_SUITE = Suite(
    "check_faulty_sales",
    (
        row_count_between(1, medallion.MAX_SALES_BATCH_ROWS),
        not_null("customer_id"),
        not_null("id"),
        between("price", *medallion.PRICE_BOUNDS),
        match_regex("email", medallion.EMAIL_PATTERN),
    ),
)


def q_gate_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate_suite(faulty_sales(spark, sf), Suite("check_stg_sales_bronze_target", (not_null("id"),)))


def q_gate_match_regex(spark: SparkSession, sf: str) -> DataFrame:
    suite = Suite("check_stg_customers_bronze_target", (match_regex("email", medallion.EMAIL_PATTERN),))
    return evaluate_suite(faulty_sales(spark, sf), suite)


def q_gate_between(spark: SparkSession, sf: str) -> DataFrame:
    suite = Suite("check_sales_silver_target", (between("price", *medallion.PRICE_BOUNDS),))
    return evaluate_suite(faulty_sales(spark, sf), suite)


def q_gate_row_count(spark: SparkSession, sf: str) -> DataFrame:
    suite = Suite("check_stg_sales_bronze_source", (row_count_between(1, medallion.MAX_SALES_BATCH_ROWS),))
    return evaluate_suite(faulty_sales(spark, sf), suite)


def refund_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Every price negated: silver keeps no row of this batch."""
    return _bronze_sales(spark, sf).withColumn("price", -F.col("price"))


def q_gate_empty(spark: SparkSession, sf: str) -> DataFrame:
    silver = transforms.silver_sales(refund_batch(spark, sf))
    suite = Suite("check_sales_silver_target", (between("price", *medallion.PRICE_BOUNDS), not_null("id")))
    return evaluate_suite(silver, suite)


def q_gate_suite(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate_suite(faulty_sales(spark, sf), GATE_SUITE)


def _faulty_landing_lake(spark: SparkSession, sf: str) -> Lake:
    lake = Lake(scratch_path(spark, "lake"))
    landing = faulty_sales(spark, sf).drop("email")
    write_batch(landing, lake.paths(BATCH_DATE)["sales_landing"], "parquet")
    return lake


def q_quarantine_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The bronze sales step over the faulty batch: its target gate fails
    (NULL ids), the staged batch moves to quarantine, nothing publishes."""
    lake = _faulty_landing_lake(spark, sf)
    step = Step(
        name="stg_sales_bronze",
        group="bronze",
        source=Endpoint("{{ root }}/landing/sales_erp/dt={{ execution_date }}", "parquet"),
        target=Endpoint("{{ root }}/{{ group }}/sales_erp/dt={{ execution_date }}", "parquet"),
        transform=transforms.bronze_sales,
        source_expectations=medallion.SALES_BRONZE.source_expectations,
        target_expectations=medallion.SALES_BRONZE.target_expectations,
    )
    try:
        run_step(spark, step, BATCH_DATE, lake)
    except GateFailed:
        pass
    return read_table(spark, lake.quarantine_root, "parquet", execution_date=BATCH_DATE)


def q_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The silver sales step over the faulty batch: rows in, out, dropped,
    read back from the run log the step appended."""
    lake = _faulty_landing_lake(spark, sf)
    bronze = transforms.bronze_sales(read_batch(spark, lake.paths(BATCH_DATE)["sales_landing"], "parquet"))
    write_batch(bronze, lake.paths(BATCH_DATE)["sales_bronze"], "parquet")
    step = Step(
        name="sales_silver",
        group="silver",
        source=Endpoint("{{ root }}/bronze/sales_erp/dt={{ execution_date }}", "parquet"),
        target=Endpoint("{{ root }}/{{ group }}/sales/dt={{ execution_date }}", "delta"),
        transform=transforms.silver_sales,
        target_expectations=(not_null("id", mostly=0.5),),
    )
    result = run_step(spark, step, BATCH_DATE, lake)
    runs = read_run_log(spark, lake)
    return runs.where(F.col("run_id") == F.lit(result.run_id)).select(
        "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped")
    )


def q_sql_file_transform(spark: SparkSession, sf: str) -> DataFrame:
    """A step's SQL loaded from a file, with a bound parameter and a regular
    expression in braces."""
    path = scratch_path(spark, "sql") + "/names.sql"
    fs.write_text(
        spark,
        path,
        "SELECT c_custkey AS id, c_name AS name FROM {source_data} "
        "WHERE c_custkey >= :first_id AND c_name RLIKE '[0-9]{9}$'",
    )
    frames = {"source_data": table(spark, sf, "customer")}
    return apply_transform(spark, load_sql(spark, path), frames, {"first_id": 100})


def q_gate_saved_suite(spark: SparkSession, sf: str) -> DataFrame:
    """The suite saved as JSON, read back by expectation type, evaluated."""
    path = scratch_path(spark, "suite") + "/check_faulty_sales.json"
    fs.write_text(spark, path, GATE_SUITE.to_json())
    return evaluate_suite(faulty_sales(spark, sf), Suite.from_json(fs.read_text(spark, path)))


def _faulty_copy_step(*target_expectations: Expectation) -> Step:
    return Step(
        name="sales_copy",
        group="bronze",
        source=Endpoint("{{ root }}/landing/sales_erp/dt={{ execution_date }}", "parquet"),
        target=Endpoint("{{ root }}/{{ group }}/sales_erp/dt={{ execution_date }}", "parquet"),
        target_expectations=target_expectations,
    )


def q_gate_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """A step without expectations publishes the whole faulty batch; the run
    log says that its gates were skipped."""
    lake = _faulty_landing_lake(spark, sf)
    run_step(spark, _faulty_copy_step(), BATCH_DATE, lake)
    return read_run_log(spark, lake).select("gate_status", "rows_in", "rows_out")


def q_gate_technical_failure(spark: SparkSession, sf: str) -> DataFrame:
    """A gate that cannot be evaluated (no such column) fails the step: the
    batch is quarantined whole."""
    lake = _faulty_landing_lake(spark, sf)
    try:
        run_step(spark, _faulty_copy_step(not_null("no_such_column")), BATCH_DATE, lake)
    except GateFailed:
        pass
    kept = read_table(spark, lake.quarantine_root, "parquet", execution_date=BATCH_DATE)
    return kept.select("id", "customer_id", "price", "reason")


# Fixed value: order totals lie below one million, the price bound of the
# silver gate when orders play the sales batch.
ORDER_PRICE_BOUNDS = (0, 1_000_000)


def _landing_lake(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> Lake:
    """Landing files derived from the tables: orders as the sales CSV (date
    as text), customers as newline JSON."""
    lake = Lake(scratch_path(spark, "lake"))
    paths = lake.paths(BATCH_DATE)
    sales = landing_sales(spark, sf).withColumn("date", F.col("date").cast(T.DateType()).cast(T.StringType()))
    write_batch(sales, paths["sales_landing"], "csv")
    write_batch(customers if customers is not None else landing_customers(spark, sf), paths["customers_landing"], "json")
    return lake


def q_medallion_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Landing files -> every gated step -> the published gold mart."""
    lake = _landing_lake(spark, sf)
    medallion.run_medallion(spark, lake, BATCH_DATE, medallion.build_steps(price_bounds=ORDER_PRICE_BOUNDS))
    return _cents(medallion.read_gold(spark, lake, BATCH_DATE), "total_revenue")


def q_quarantine_source(spark: SparkSession, sf: str) -> DataFrame:
    """Customers landing with every 3rd id NULL: the bronze source gate
    fails and the raw landing batch (as text) is quarantined."""
    faulty = landing_customers(spark, sf).withColumn(
        "id", F.when(every("id", _ORPHAN), F.lit(None).cast(T.LongType())).otherwise(F.col("id"))
    )
    lake = _landing_lake(spark, sf, customers=faulty)
    try:
        run_step(spark, medallion.CUSTOMERS_BRONZE, BATCH_DATE, lake)
    except GateFailed:
        pass
    kept = read_table(spark, lake.quarantine_root, "parquet", execution_date=BATCH_DATE)
    fields = F.from_json("raw_line", "id string, name string, email string, city string, state string")
    return kept.select(fields.alias("r"), "dt", "reason").select("r.*", "dt", "reason")


def q_quarantine_raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A sales CSV of many files with extra fields and broken lines: every
    line of the batch, the headers included, is in quarantine as it was."""
    key = F.col("o_orderkey")
    row = F.concat(key.cast("string"), F.lit(",1,2.5,x,2024-01-01"))
    line = (
        F.when(key % 7 == 0, F.concat(F.lit('garbage "'), key.cast("string")))
        .when(key % 4 == 0, F.concat(row, F.lit(",extra,fields")))
        .otherwise(row)
    )
    lake = Lake(scratch_path(spark, "lake"))
    part = F.floor(key / RAW_KEYS_PER_PART).alias("part")
    lines = table(spark, sf, "orders").select(part, F.lit(1).alias("place"), line.alias("value"))
    head = lines.select("part").distinct().select(
        "part", F.lit(0).alias("place"), F.lit("id,customer_id,price,product,date").alias("value")
    )
    files = head.union(lines).repartition("part").sortWithinPartitions("part", "place")
    files.select("part", "value").write.partitionBy("part").text(lake.paths(BATCH_DATE)["sales_landing"])
    try:
        run_step(spark, medallion.SALES_BRONZE, BATCH_DATE, lake)
    except GateFailed:
        pass
    return read_table(spark, lake.quarantine_root, "parquet", execution_date=BATCH_DATE).select("raw_line", "reason")


def q_csv_sniffed(spark: SparkSession, sf: str) -> DataFrame:
    """Sales written with semicolons and single quotes, read back with neither
    schema nor dialect declared."""
    path = scratch_path(spark, "sniffed-csv")
    sales = landing_sales(spark, sf).withColumn("product", F.concat(F.lit("a;b "), F.col("product")))
    write_batch(sales.withColumn("date", F.col("date").cast("date")), path, "csv", options={"sep": ";", "quote": "'"})
    return read_sniffed(spark, path)


def q_catalog_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The gold mart over silver tables that only a declaration file names."""
    lake = Lake(scratch_path(spark, "lake"))
    for name, df in (("sales", _silver_sales(spark, sf)), ("customers", _silver_customers_with_orphans(spark, sf))):
        publish_batch(spark, df, partition_dir(lake.table("silver", name), BATCH_DATE), "snapshot")
    declared = {"sources": [{"name": "silver", "schema": "silver", "tables": [
        {"name": "sales_silver", "meta": {"external_location": "{{ root }}/silver/sales/dt={{ var('execution_date') }}"},
         "columns": [{"name": "id", "data_type": "bigint"}, {"name": "price", "data_type": "double"}]},
        {"name": "customers_silver", "meta": {"external_location": "{{ root }}/silver/customers/dt={{ var('execution_date') }}"},
         "columns": [{"name": "customer_id", "data_type": "bigint"}, {"name": "uf", "data_type": "string"}]},
    ]}]}
    path = f"{lake.meta_root}/sources.json"
    fs.write_text(spark, path, json.dumps(declared))
    sources = SourceCatalog.from_file(spark, path, root=lake.root)
    frames = [sources.read(spark, f"silver.{name}", BATCH_DATE) for name in ("sales_silver", "customers_silver")]
    return _cents(marts.sales_summary(*frames), "total_revenue")


def q_json_mixed_layout(spark: SparkSession, sf: str) -> DataFrame:
    """One batch of array files and line files, all rows read."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    path = scratch_path(spark, "mixed-json")
    c.where("id % 2 = 0").write.json(f"{path}/lines")
    text = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("id", "name", "nation"))), ","), F.lit("]"))
    by_file = c.where("id % 2 <> 0").groupBy(F.floor(F.col("id") / 500)).agg(text.alias("value"))
    by_file.select("value").repartition(4).write.option("maxRecordsPerFile", "1").text(f"{path}/arrays")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType())])
    return read_batch(spark, path, "json", schema, {"recursiveFileLookup": "true"})


def q_gold_fractional_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The mart over prices with fractions of a cent."""
    sales = _silver_sales(spark, sf).withColumn("price", F.col("price") * F.lit(0.9) / F.lit(7))
    return _cents(marts.sales_summary(sales, _silver_customers_with_orphans(spark, sf)), "total_revenue")


def _order_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("n"))


def _customer_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("n"))


def q_fault_landing_sales(spark: SparkSession, sf: str) -> DataFrame:
    return generate.corrupt_landing_sales(_order_keys(spark, sf))


def q_fault_landing_customers(spark: SparkSession, sf: str) -> DataFrame:
    return generate.corrupt_landing_customers(_customer_keys(spark, sf), BATCH_DATE)


def q_fault_bronze_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(generate.corrupt_bronze_sales(_order_keys(spark, sf)))


def q_fault_bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(generate.corrupt_bronze_customers(_customer_keys(spark, sf)))


def q_fault_silver_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_volatile(generate.corrupt_silver_sales(_order_keys(spark, sf)))


def _index_from(df: DataFrame, key: str) -> DataFrame:
    return df.select((F.col(key) + F.lit(1)).alias("i"))


def q_gen_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = generate.customers_from_index(_index_from(table(spark, sf, "customer"), "c_custkey"))
    i = (F.col("id") - F.lit(generate.FIRST_CUSTOMER_ID - 1)).cast(T.StringType())
    return c.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.count_if(F.col("name") == F.concat(F.lit("Customer_"), i)).alias("named"),
        F.count_if(F.col("email") == F.concat(F.lit("customer_"), i, F.lit("@example.com"))).alias("emailed"),
        F.count_if(F.col("city").isin(generate.CITIES)).alias("city_ok"),
        F.count_if(F.col("state").isin(generate.STATES)).alias("state_ok"),
    )


def _sales_invariants(s: DataFrame, n_customers: int, low: float, high: float) -> DataFrame:
    lo_c, hi_c = generate.FIRST_CUSTOMER_ID, generate.FIRST_CUSTOMER_ID + n_customers - 1
    return s.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.count_if(F.col("customer_id").between(lo_c, hi_c)).alias("customer_ok"),
        F.count_if((F.col("price") >= F.lit(low)) & (F.col("price") < F.lit(high))).alias("price_ok"),
        F.count_if(F.col("product").isin(generate.PRODUCTS)).alias("product_ok"),
        F.count_if(F.col("date") == F.lit(BATCH_DATE)).alias("date_ok"),
    )


def q_gen_sales(spark: SparkSession, sf: str) -> DataFrame:
    s = generate.sales_from_index(
        _index_from(table(spark, sf, "orders"), "o_orderkey"),
        generate.CLEAN_CUSTOMERS,
        generate.CLEAN_PRICE_RANGE,
        BATCH_DATE,
    )
    return _sales_invariants(s, generate.CLEAN_CUSTOMERS, *generate.CLEAN_PRICE_RANGE)


def q_gen_dirty_sales(spark: SparkSession, sf: str) -> DataFrame:
    s = generate.dirty_sales_from_index(
        _index_from(table(spark, sf, "orders"), "o_orderkey"), generate.DIRTY_CUSTOMERS, BATCH_DATE
    )
    return _sales_invariants(s, generate.DIRTY_CUSTOMERS, *generate.DIRTY_PRICE_RANGE)


def q_gen_dirty_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = generate.dirty_customers_from_index(_index_from(table(spark, sf, "customer"), "c_custkey"))
    return c.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
        F.max("id").alias("max_id"),
    )


QUERIES: dict[str, QueryFn] = {
    "bronze_sales": q_bronze_sales,
    "bronze_customers": q_bronze_customers,
    "silver_sales": q_silver_sales,
    "silver_customers": q_silver_customers,
    "gold_enriched_sales": q_gold_enriched_sales,
    "gold_sales_summary": q_gold_sales_summary,
    "dashboard_kpis": q_dashboard_kpis,
    "revenue_by_region": q_revenue_by_region,
    "orders_by_region": q_orders_by_region,
    "passthrough": q_passthrough,
    "sql_transform": q_sql_transform,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "snapshot_publish": q_snapshot_publish,
    "partition_overwrite": q_partition_overwrite,
    "partition_prune": q_partition_prune,
    "ingest_lineage": q_ingest_lineage,
    "gate_not_null": q_gate_not_null,
    "gate_match_regex": q_gate_match_regex,
    "gate_between": q_gate_between,
    "gate_row_count": q_gate_row_count,
    "gate_empty": q_gate_empty,
    "gate_suite": q_gate_suite,
    "quarantine_batch": q_quarantine_batch,
    "quarantine_source": q_quarantine_source,
    "quarantine_raw_lines": q_quarantine_raw_lines,
    "json_mixed_layout": q_json_mixed_layout,
    "csv_sniffed": q_csv_sniffed,
    "catalog_gold": q_catalog_gold,
    "gold_fractional_prices": q_gold_fractional_prices,
    "medallion_gold": q_medallion_gold,
    "run_metrics": q_run_metrics,
    "sql_file_transform": q_sql_file_transform,
    "gate_saved_suite": q_gate_saved_suite,
    "gate_skipped": q_gate_skipped,
    "gate_technical_failure": q_gate_technical_failure,
    "fault_landing_sales": q_fault_landing_sales,
    "fault_landing_customers": q_fault_landing_customers,
    "fault_bronze_sales": q_fault_bronze_sales,
    "fault_bronze_customers": q_fault_bronze_customers,
    "fault_silver_sales": q_fault_silver_sales,
    "gen_customers": q_gen_customers,
    "gen_sales": q_gen_sales,
    "gen_dirty_sales": q_gen_dirty_sales,
    "gen_dirty_customers": q_gen_dirty_customers,
    **gate_queries.QUERIES,
}
