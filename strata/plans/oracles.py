"""SQL oracles: for each registered query, the same result in DuckDB SQL.

Each text runs over the test tables registered as views (``orders``,
``customer`` ...). The base relations mirror ``strata.sources.testdata``;
faults, dates and gate parameters come from the same fixed values as the
Spark side, so a mismatch points at the Spark logic, not at a constant.
"""

from __future__ import annotations

from strata.operators import generate
from strata.plans import gate_queries, medallion
from strata.plans.queries import (
    _NEGATIVE,
    _NULL_ID,
    _ORPHAN,
    BATCH_DATE,
    INVALID_EMAIL_EVERY,
    OTHER_DATES,
    RAW_KEYS_PER_PART,
)

LS = (
    "SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderpriority AS product, "
    "o_totalprice AS price, o_orderdate AS date FROM orders"
)
LC = (
    "SELECT c_custkey AS id, c_name AS name, concat(lower(c_name), '@example.com') AS email, "
    "CAST(c_nationkey AS VARCHAR) AS city, lower(c_mktsegment) AS state FROM customer"
)
BRONZE_S = (
    "SELECT id, customer_id, product, CAST(price AS DOUBLE) AS price, CAST(date AS DATE) AS sale_date "
    f"FROM ({LS})"
)
BRONZE_C = f"SELECT id AS customer_id, name, email, city, state FROM ({LC})"
SILVER_S = f"SELECT *, price * CAST(0.9 AS DOUBLE) AS price_with_discount FROM ({BRONZE_S}) WHERE price > 0"
SILVER_C = f"SELECT *, upper(state) AS uf FROM ({BRONZE_C})"
SILVER_C_ORPHANS = (
    f"SELECT CASE WHEN customer_id % {_ORPHAN} = 0 THEN NULL ELSE customer_id END AS customer_id, "
    f"name, email, city, state, uf FROM ({SILVER_C})"
)
ENRICHED = (
    "SELECT s.id, s.price AS sale_value, s.sale_date, c.name AS customer_name, c.uf AS region, "
    "CAST(date_trunc('month', s.sale_date) AS DATE) AS sale_month "
    f"FROM ({SILVER_S}) s LEFT JOIN ({SILVER_C_ORPHANS}) c ON s.customer_id = c.customer_id"
)
GOLD = (
    "SELECT region, sale_month, sum(sale_value) AS total_revenue, count(id) AS total_orders, "
    f"round(round(avg(sale_value), 9), 2) AS avg_ticket FROM ({ENRICHED}) GROUP BY region, sale_month"
)
# a landing line: every 4th carries two extra fields, every 7th is no CSV row of the schema
RAW_LINE = (
    "CASE WHEN o_orderkey % 7 = 0 THEN concat('garbage \"', CAST(o_orderkey AS VARCHAR)) "
    "WHEN o_orderkey % 4 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), ',1,2.5,x,2024-01-01,extra,fields') "
    "ELSE concat(CAST(o_orderkey AS VARCHAR), ',1,2.5,x,2024-01-01') END"
)
FS = (
    f"SELECT CASE WHEN o_orderkey % {_NULL_ID} = 0 THEN NULL ELSE o_orderkey END AS id, o_custkey AS customer_id, "
    "o_orderpriority AS product, "
    f"CASE WHEN o_orderkey % {_NEGATIVE} = 0 THEN -o_totalprice ELSE o_totalprice END AS price, o_orderdate AS date, "
    f"CASE WHEN o_orderkey % {INVALID_EMAIL_EVERY} = 0 "
    f"THEN concat('{generate.LANDING_CUSTOMERS_EMAIL_PREFIX}', CAST(o_orderkey AS VARCHAR)) "
    "ELSE 'ok@mail.com' END AS email FROM orders"
)


def _gate_sql(suite: str, kind: str, column: str | None, src: str, unexpected: str | None, missing: str | None,
              ok: str) -> str:
    """One result row in SQL: counts over ``src`` and the success rule."""
    col = "NULL" if column is None else f"'{column}'"
    miss = f"count(*) FILTER (WHERE {missing})" if missing else "CAST(NULL AS BIGINT)"
    unexp = f"count(*) FILTER (WHERE {unexpected})" if unexpected else "CAST(NULL AS BIGINT)"
    if kind == "expect_column_values_to_not_be_null":
        pct = f"CASE WHEN count(*) > 0 THEN CAST({unexp} AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) END"
    elif unexpected:
        base = f"(count(*) - {miss})"
        pct = f"CASE WHEN {base} > 0 THEN CAST({unexp} AS DOUBLE) * 100.0 / CAST({base} AS DOUBLE) END"
    else:
        pct = "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT '{suite}' AS suite, '{kind}' AS expectation, CAST({col} AS VARCHAR) AS column_name, "
        f"count(*) AS element_count, {miss} AS missing_count, {unexp} AS unexpected_count, "
        f"{pct} AS unexpected_percent, ({ok}) AS success FROM ({src})"
    )


def _not_null_sql(suite: str, column: str, src: str, floating: bool = False) -> str:
    miss = f"{column} IS NULL" + (f" OR isnan({column})" if floating else "")
    return _gate_sql(suite, "expect_column_values_to_not_be_null", column, src, miss, miss,
                     f"count(*) FILTER (WHERE {miss}) = 0")


def _between_sql(suite: str, column: str, lo: float, hi: float, src: str) -> str:
    miss = f"{column} IS NULL OR isnan({column})"
    bad = f"NOT ({miss}) AND NOT ({column} >= {lo} AND {column} <= {hi})"
    return _gate_sql(suite, "expect_column_values_to_be_between", column, src, bad, miss,
                     f"count(*) FILTER (WHERE {bad}) = 0")


def _regex_sql(suite: str, column: str, pattern: str, src: str) -> str:
    miss = f"{column} IS NULL"
    bad = f"{column} IS NOT NULL AND NOT regexp_matches({column}, '{pattern}')"
    return _gate_sql(suite, "expect_column_values_to_match_regex", column, src, bad, miss,
                     f"count(*) FILTER (WHERE {bad}) = 0")


def _row_count_sql(suite: str, lo: int, hi: int, src: str) -> str:
    return _gate_sql(suite, "expect_table_row_count_to_be_between", None, src, None, None,
                     f"count(*) >= {lo} AND count(*) <= {hi}")


_LO, _HI = medallion.PRICE_BOUNDS
_PAT = medallion.EMAIL_PATTERN
_MAXROWS = medallion.MAX_SALES_BATCH_ROWS
REFUND = f"SELECT id, customer_id, product, -price AS price, sale_date FROM ({BRONZE_S})"
SILVER_REFUND = f"SELECT *, price * CAST(0.9 AS DOUBLE) AS price_with_discount FROM ({REFUND}) WHERE price > 0"
BRONZE_FS = (
    "SELECT id, customer_id, product, CAST(price AS DOUBLE) AS price, CAST(date AS DATE) AS sale_date "
    f"FROM ({FS})"
)


def _sales_invariants_sql(src_index: str, n_customers: int, null_first: int | None) -> str:
    null_ids = f"count(*) FILTER (WHERE i <= {null_first})" if null_first else "CAST(0 AS BIGINT)"
    min_id = f"min(i) FILTER (WHERE i > {null_first})" if null_first else "min(i)"
    return (
        f"SELECT count(*) AS n, {null_ids} AS null_ids, {min_id} AS min_id, max(i) AS max_id, "
        f"count(*) AS customer_ok, count(*) AS price_ok, count(*) AS product_ok, count(*) AS date_ok "
        f"FROM ({src_index})"
    )


def _sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


G = generate
ORDER_INDEX = "SELECT o_orderkey + 1 AS i FROM orders"
CUSTOMER_INDEX = "SELECT c_custkey + 1 AS i FROM customer"

ORACLES: dict[str, str] = {
    "bronze_sales": BRONZE_S,
    "bronze_customers": BRONZE_C,
    "silver_sales": SILVER_S,
    "silver_customers": SILVER_C,
    "gold_enriched_sales": ENRICHED,
    "gold_sales_summary": (
        "SELECT region, sale_month, round(total_revenue, 2) AS total_revenue, total_orders, avg_ticket "
        f"FROM ({GOLD})"
    ),
    "dashboard_kpis": (
        "SELECT round(sum(total_revenue), 2) AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders, "
        f"round(avg(avg_ticket), 2) AS avg_ticket FROM ({GOLD})"
    ),
    "revenue_by_region": f"SELECT region, round(sum(total_revenue), 2) AS total_revenue FROM ({GOLD}) GROUP BY region",
    "orders_by_region": (
        f"SELECT region, CAST(sum(total_orders) AS BIGINT) AS total_orders FROM ({GOLD}) GROUP BY region"
    ),
    "passthrough": "SELECT * FROM customer",
    "sql_transform": f"SELECT * FROM ({BRONZE_S}) WHERE id >= 100 OR id IS NULL",
    "csv_roundtrip": BRONZE_S,
    "json_roundtrip": BRONZE_C,
    "parquet_roundtrip": SILVER_S,
    "snapshot_publish": SILVER_C,
    "partition_overwrite": (
        f"SELECT *, DATE '{OTHER_DATES[0]}' AS dt FROM ({BRONZE_S}) "
        f"UNION ALL SELECT *, DATE '{BATCH_DATE}' AS dt FROM ({BRONZE_S})"
    ),
    "partition_prune": f"SELECT *, DATE '{BATCH_DATE}' AS dt FROM ({BRONZE_S})",
    "ingest_lineage": "SELECT *, 'customers' AS _domain, 'customer.parquet' AS _source_file FROM customer",
    "gate_not_null": _not_null_sql("check_stg_sales_bronze_target", "id", FS),
    "gate_match_regex": _regex_sql("check_stg_customers_bronze_target", "email", _PAT, FS),
    "gate_between": _between_sql("check_sales_silver_target", "price", _LO, _HI, FS),
    "gate_row_count": _row_count_sql("check_stg_sales_bronze_source", 1, _MAXROWS, FS),
    "gate_empty": (
        _between_sql("check_sales_silver_target", "price", _LO, _HI, SILVER_REFUND)
        + " UNION ALL "
        + _not_null_sql("check_sales_silver_target", "id", SILVER_REFUND)
    ),
    "gate_suite": " UNION ALL ".join(
        [
            _row_count_sql("check_faulty_sales", 1, _MAXROWS, FS),
            _not_null_sql("check_faulty_sales", "customer_id", FS),
            _not_null_sql("check_faulty_sales", "id", FS),
            _between_sql("check_faulty_sales", "price", _LO, _HI, FS),
            _regex_sql("check_faulty_sales", "email", _PAT, FS),
        ]
    ),
    "sql_file_transform": (
        "SELECT c_custkey AS id, c_name AS name FROM customer "
        "WHERE c_custkey >= 100 AND regexp_matches(c_name, '[0-9]{9}$')"
    ),
    "gate_skipped": f"SELECT 'skipped' AS gate_status, count(*) AS rows_in, count(*) AS rows_out FROM ({FS})",
    "gate_technical_failure": f"SELECT id, customer_id, price, 'target_fail_sales_copy' AS reason FROM ({FS})",
    "quarantine_batch": (
        f"SELECT *, DATE '{BATCH_DATE}' AS dt, 'target_fail_stg_sales_bronze' AS reason FROM ({BRONZE_FS})"
    ),
    "quarantine_source": (
        f"SELECT CAST(CASE WHEN c_custkey % {_ORPHAN} = 0 THEN NULL ELSE c_custkey END AS VARCHAR) AS id, "
        "c_name AS name, concat(lower(c_name), '@example.com') AS email, CAST(c_nationkey AS VARCHAR) AS city, "
        f"lower(c_mktsegment) AS state, DATE '{BATCH_DATE}' AS dt, "
        "'source_fail_stg_customers_bronze' AS reason FROM customer"
    ),
    "quarantine_raw_lines": (
        f"SELECT {RAW_LINE} AS raw_line, 'source_fail_stg_sales_bronze' AS reason FROM orders "
        "UNION ALL SELECT 'id,customer_id,price,product,date', 'source_fail_stg_sales_bronze' "
        f"FROM (SELECT DISTINCT o_orderkey // {RAW_KEYS_PER_PART} FROM orders)"
    ),
    "json_mixed_layout": "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer",
    "gold_fractional_prices": (
        "SELECT region, sale_month, round(sum(sale_value), 2) AS total_revenue, count(id) AS total_orders, "
        "round(round(avg(sale_value), 9), 2) AS avg_ticket FROM (SELECT id, region, sale_month, "
        f"sale_value * CAST(0.9 AS DOUBLE) / 7 AS sale_value FROM ({ENRICHED})) GROUP BY region, sale_month"
    ),
    "medallion_gold": (
        "SELECT region, sale_month, round(sum(sale_value), 2) AS total_revenue, count(id) AS total_orders, "
        "round(round(avg(sale_value), 9), 2) AS avg_ticket "
        "FROM (SELECT s.id, s.price AS sale_value, c.uf AS region, "
        "CAST(date_trunc('month', s.sale_date) AS DATE) AS sale_month "
        f"FROM ({SILVER_S}) s LEFT JOIN ({SILVER_C}) c ON s.customer_id = c.customer_id) "
        "GROUP BY region, sale_month"
    ),
    "run_metrics": (
        "SELECT count(*) AS rows_in, count(*) FILTER (WHERE price > 0) AS rows_out, "
        f"count(*) FILTER (WHERE price IS NULL OR NOT price > 0) AS rows_dropped FROM ({FS})"
    ),
    "fault_landing_sales": (
        f"SELECT CASE WHEN o_orderkey % {G.LANDING_SALES_NULL_ID_EVERY} = 0 THEN NULL ELSE o_orderkey END AS id, "
        f"CASE WHEN o_orderkey % {G.LANDING_SALES_NEGATIVE_EVERY} = 0 "
        f"THEN CAST({G.LANDING_SALES_NEGATIVE_PRICE} AS DOUBLE) ELSE CAST({G.LANDING_SALES_PRICE} AS DOUBLE) END "
        f"AS price, {_sql(G.LANDING_SALES_DATE)} AS date, CAST({G.LANDING_SALES_CUSTOMER_ID} AS BIGINT) "
        f"AS customer_id, {_sql(G.LANDING_SALES_PRODUCT)} AS product FROM orders"
    ),
    "fault_landing_customers": (
        f"SELECT c_custkey AS id, {_sql(G.LANDING_CUSTOMERS_EMAIL_PREFIX)} || CAST(c_custkey AS VARCHAR) AS email, "
        f"{_sql(G.LANDING_CUSTOMERS_NAME_PREFIX)} || CAST(c_custkey AS VARCHAR) AS name, "
        f"{_sql(G.LANDING_CUSTOMERS_CITY)} AS city, {_sql(G.LANDING_CUSTOMERS_STATE)} AS state, "
        f"{_sql(BATCH_DATE)} AS created_at FROM customer"
    ),
    "fault_bronze_sales": (
        f"SELECT o_orderkey AS id, CAST({G.BRONZE_SALES_CUSTOMER_ID} AS BIGINT) AS customer_id, "
        f"CASE WHEN o_orderkey % {G.BRONZE_SALES_NULL_PRODUCT_EVERY} = 0 THEN NULL "
        f"ELSE {_sql(G.BRONZE_SALES_PRODUCT)} END AS product, "
        f"CAST({G.BRONZE_SALES_PRICE} AS DOUBLE) AS price, CAST({_sql(G.BRONZE_SALES_DATE)} AS DATE) AS sale_date, "
        f"{_sql(G.BRONZE_SALES_DOMAIN)} AS _domain, {_sql(G.BRONZE_SALES_SOURCE_FILE)} AS _source_file FROM orders"
    ),
    "fault_bronze_customers": (
        f"SELECT CASE WHEN c_custkey % {G.BRONZE_CUSTOMERS_NULL_ID_EVERY} = 0 THEN NULL ELSE c_custkey END "
        f"AS customer_id, {_sql(G.BRONZE_CUSTOMERS_NAME)} AS name, {_sql(G.BRONZE_CUSTOMERS_EMAIL)} AS email, "
        f"{_sql(G.BRONZE_CUSTOMERS_CITY)} AS city, {_sql(G.BRONZE_CUSTOMERS_STATE)} AS state, "
        f"{_sql(G.BRONZE_CUSTOMERS_DOMAIN)} AS _domain, {_sql(G.BRONZE_CUSTOMERS_SOURCE_FILE)} AS _source_file "
        "FROM customer"
    ),
    "fault_silver_sales": (
        f"SELECT o_orderkey AS id, CAST({G.SILVER_SALES_CUSTOMER_ID} AS BIGINT) AS customer_id, "
        f"{_sql(G.SILVER_SALES_PRODUCT)} AS product, CAST({G.SILVER_SALES_PRICE} AS DOUBLE) AS price, "
        f"CAST({_sql(G.SILVER_SALES_DATE)} AS DATE) AS sale_date FROM orders"
    ),
    "gen_customers": (
        f"SELECT count(*) AS n, min(i) + {G.FIRST_CUSTOMER_ID - 1} AS min_id, "
        f"max(i) + {G.FIRST_CUSTOMER_ID - 1} AS max_id, count(*) AS named, "
        f"count(*) AS emailed, count(*) AS city_ok, count(*) AS state_ok FROM ({CUSTOMER_INDEX})"
    ),
    "gen_sales": _sales_invariants_sql(ORDER_INDEX, generate.CLEAN_CUSTOMERS, None),
    "gen_dirty_sales": _sales_invariants_sql(ORDER_INDEX, generate.DIRTY_CUSTOMERS, generate.DIRTY_NULL_SALE_IDS),
    "gen_dirty_customers": (
        f"SELECT count(*) AS n, count(*) FILTER (WHERE i <= {generate.DIRTY_NULL_CUSTOMER_IDS}) AS null_ids, "
        f"max(i) + {G.FIRST_CUSTOMER_ID - 1} AS max_id FROM ({CUSTOMER_INDEX})"
    ),
}

# the saved suite gives the same rows as the suite itself
ORACLES["gate_saved_suite"] = ORACLES["gate_suite"]
ORACLES |= gate_queries.ORACLES
ORACLES["csv_sniffed"] = f"SELECT * REPLACE ('a;b ' || product AS product, CAST(date AS DATE) AS date) FROM ({LS})"
ORACLES["catalog_gold"] = ORACLES["gold_sales_summary"]
