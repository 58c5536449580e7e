"""Registered queries of the measured expectations, with their SQL.

All run over the whole ``orders`` table with planted faults: a code that a
third of the rows share, missing and orphaned customer ids, negated prices.
Suites are declared as a user would, by class name and keyword arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expectations import Suite
from strata.operators.gates import evaluate_suite, unexpected_values
from strata.sources.testdata import every, table

# Which keys carry which fault.
SHARED_CODE_EVERY, NO_CUSTOMER_EVERY, ORPHAN_EVERY, NEGATIVE_EVERY = 3, 10, 7, 15
ORPHAN_OFFSET = 1_000_000_000


def planted_orders(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    customer = F.when(every(key, NO_CUSTOMER_EVERY), F.lit(None)).when(
        every(key, ORPHAN_EVERY), F.col("o_custkey") + ORPHAN_OFFSET
    )
    return table(spark, sf, "orders").select(
        key.alias("id"),
        F.when(every(key, SHARED_CODE_EVERY), F.lit(-1)).otherwise(key).alias("code"),
        customer.otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderstatus").alias("status"),
        F.when(every(key, NEGATIVE_EVERY), -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("price"),
        F.col("o_orderdate").alias("day"),
    )


PLANTED = (
    f"(SELECT o_orderkey AS id, CASE WHEN o_orderkey % {SHARED_CODE_EVERY} = 0 THEN -1 ELSE o_orderkey END AS code, "
    f"CASE WHEN o_orderkey % {NO_CUSTOMER_EVERY} = 0 THEN NULL WHEN o_orderkey % {ORPHAN_EVERY} = 0 "
    f"THEN o_custkey + {ORPHAN_OFFSET} ELSE o_custkey END AS customer_id, o_orderpriority AS product, "
    f"o_orderstatus AS status, CASE WHEN o_orderkey % {NEGATIVE_EVERY} = 0 THEN -o_totalprice ELSE o_totalprice END AS price, "
    "o_orderdate AS day FROM orders)"
)


def _suite(name: str, *specs: tuple[str, dict]) -> Suite:
    return Suite.from_specs(name, [{"expectation": cls, "kwargs": kwargs} for cls, kwargs in specs])


def _counts(df: DataFrame) -> DataFrame:
    return df.drop("observed_values")


def _observed(df: DataFrame, digits: int = 9) -> DataFrame:
    """One row per observed value."""
    each = df.select("suite", "expectation", "column_name", "element_count", "success", F.posexplode("observed_values").alias("place", "value"))
    return each.withColumn("value", F.round("value", digits))


# --- SQL of a result row ----------------------------------------------------


def _lit(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else "'" + text.replace("'", "''") + "'"


def _row(suite: Suite, i: int, elements: str, missing: str, unexpected: str, source: str, base: str | None = None) -> str:
    """A counted result row; the three counts are SQL over ``source``."""
    e = suite.expectations[i]
    return (
        f"SELECT {_lit(suite.name)} AS suite, {_lit(e.type)} AS expectation, {_lit(e.label)} AS column_name, n AS element_count, "
        "m AS missing_count, u AS unexpected_count, CASE WHEN b > 0 THEN CAST(u AS DOUBLE) * 100.0 / CAST(b AS DOUBLE) END AS unexpected_percent, "
        f"b = 0 OR CAST(b - u AS DOUBLE) / CAST(b AS DOUBLE) >= {e.mostly} AS success "
        f"FROM (SELECT n, m, u, {base or 'n - m'} AS b FROM (SELECT CAST({elements} AS BIGINT) AS n, CAST({missing} AS BIGINT) AS m, "
        f"CAST({unexpected} AS BIGINT) AS u FROM {source}))"
    )


def _value_row(suite: Suite, i: int, place: int, value: str, success: str, source: str, where: str = "true") -> str:
    e = suite.expectations[i]
    return (
        f"SELECT {_lit(suite.name)} AS suite, {_lit(e.type)} AS expectation, {_lit(e.label)} AS column_name, "
        f"(SELECT count(*) FROM {PLANTED} WHERE {where}) AS element_count, {success} AS success, {place} AS place, "
        f"round(CAST(value AS DOUBLE), 9) AS value FROM (SELECT {value} AS value FROM {source})"
    )


# --- uniqueness -------------------------------------------------------------

UNIQUE = _suite(
    "unique_orders",
    ("ExpectColumnValuesToBeUnique", {"column": "id"}),
    ("ExpectColumnValuesToBeUnique", {"column": "code", "mostly": 0.6}),
    ("ExpectColumnValuesToBeUnique", {"column": "customer_id"}),
)
COMPOUND = _suite(
    "unique_order_keys",
    ("ExpectCompoundColumnsToBeUnique", {"column_list": ["customer_id", "day"], "ignore_row_if": "any_value_is_missing"}),
    ("ExpectCompoundColumnsToBeUnique", {"column_list": ["customer_id", "product"]}),
    ("ExpectCompoundColumnsToBeUnique", {"column_list": ["code", "status", "product"], "ignore_row_if": "never"}),
    ("ExpectCompoundColumnsToBeUnique", {"column_list": ["id", "code"]}),
)


def q_gate_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(evaluate_suite(planted_orders(spark, sf), UNIQUE))


def q_gate_compound_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(evaluate_suite(planted_orders(spark, sf), COMPOUND))


def _unique_sql(suite: Suite) -> str:
    rows = []
    for i, e in enumerate(suite.expectations):
        keys = e.columns or (e.column,)
        rule = "any_value_is_missing" if e.column else e.ignore_row_if
        skip = {"never": "false", "any_value_is_missing": " OR ", "all_values_are_missing": " AND "}[rule]
        skip = skip if skip == "false" else "(" + skip.join(f"{k} IS NULL" for k in keys) + ")"
        source = f"(SELECT {', '.join(keys)}, count(*) AS k FROM {PLANTED} GROUP BY ALL)"
        rows.append(_row(suite, i, "sum(k)", f"coalesce(sum(k) FILTER (WHERE {skip}), 0)",
                         f"coalesce(sum(k) FILTER (WHERE k > 1 AND NOT {skip}), 0)", source))
    return " UNION ALL ".join(rows)


# --- order ------------------------------------------------------------------

ORDER = _suite(
    "ordered_orders",
    ("ExpectColumnValuesToBeIncreasing", {"column": "id", "order_by": ["id"], "strictly": True}),
    ("ExpectColumnValuesToBeIncreasing", {"column": "code", "order_by": ["id"], "mostly": 0.5}),
    ("ExpectColumnValuesToBeIncreasing", {"column": "code", "order_by": ["id"], "strictly": True}),
    ("ExpectColumnValuesToBeDecreasing", {"column": "customer_id", "order_by": ["day", "id"]}),
    ("ExpectColumnValuesToBeDecreasing", {"column": "price", "order_by": ["product", "id"], "strictly": True}),
)


def q_gate_order(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(evaluate_suite(planted_orders(spark, sf), ORDER))


def _order_sql() -> str:
    rows = []
    for i, e in enumerate(ORDER.expectations):
        sign = (">" if "decreasing" in e.type else "<") + ("=" if e.strictly else "")
        lagged = f"(SELECT {e.column} AS v, lag({e.column}) OVER (ORDER BY {', '.join(e.order_by)}) AS b FROM {PLANTED} WHERE {e.column} IS NOT NULL)"
        rows.append(_row(ORDER, i, f"(SELECT count(*) FROM {PLANTED})", f"(SELECT count(*) FROM {PLANTED} WHERE {e.column} IS NULL)",
                         f"count(*) FILTER (WHERE v {sign} b)", lagged))
    return " UNION ALL ".join(rows)


# --- quantiles --------------------------------------------------------------

QUANTILES = _suite(
    "order_quantiles",
    ("ExpectColumnQuantileValuesToBeBetween", {
        "column": "price",
        "quantile_ranges": {"quantiles": [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0], "value_ranges": [
            [None, 0], [None, 0], [0, 250_000], [100_000, 300_000], [400_000, None], [400_000, 500_000], [400_000, 500_000]]}}),
    ("ExpectColumnQuantileValuesToBeBetween", {
        "column": "code", "quantile_ranges": {"quantiles": [0.1, 1 / 3, 0.7], "value_ranges": [[-1, -1], [-1, None], [0, None]]}}),
    ("ExpectColumnMedianToBeBetween", {"column": "price", "min_value": 100_000, "max_value": 300_000}),
    ("ExpectColumnMedianToBeBetween", {"column": "customer_id", "max_value": 10, "row_condition": "price < 0", "condition_parser": "spark"}),
)


def q_gate_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _observed(evaluate_suite(planted_orders(spark, sf), QUANTILES))


def _quantile_sql() -> str:
    rows = []
    for i, e in enumerate(QUANTILES.expectations):
        where = e.row_condition or "true"
        source = f"{PLANTED} WHERE {where} AND {e.column} IS NOT NULL"
        if e.quantile_ranges is None:
            low = "true" if e.min_value is None else f"value >= {e.min_value}"
            high = "true" if e.max_value is None else f"value <= {e.max_value}"
            rows.append(_value_row(QUANTILES, i, 0, f"median({e.column})", f"{low} AND {high}", source, where))
            continue
        checks = []
        for q, lo, hi in e.quantile_ranges:
            value = f"(SELECT quantile_disc({e.column}, {q!r}) FROM {source})"
            checks += [f"{value} >= {lo}"] * (lo is not None) + [f"{value} <= {hi}"] * (hi is not None)
        for place, (q, _, _) in enumerate(e.quantile_ranges):
            rows.append(_value_row(QUANTILES, i, place, f"quantile_disc({e.column}, {q!r})", "(" + " AND ".join(checks) + ")", source, where))
    return " UNION ALL ".join(rows)


# --- distinct values --------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SETS = _suite(
    "order_values",
    ("ExpectColumnDistinctValuesToBeInSet", {"column": "product", "value_set": PRIORITIES}),
    ("ExpectColumnDistinctValuesToBeInSet", {"column": "product", "value_set": PRIORITIES[:3]}),
    ("ExpectColumnDistinctValuesToContainSet", {"column": "status", "value_set": ["F", "O"]}),
    ("ExpectColumnDistinctValuesToContainSet", {"column": "status", "value_set": ["F", "X", "Y"]}),
    ("ExpectColumnDistinctValuesToEqualSet", {"column": "status", "value_set": ["F", "O", "P"]}),
    ("ExpectColumnDistinctValuesToEqualSet", {"column": "code", "value_set": [-1, -2]}),
)
SHARES = _suite(
    "order_shares",
    ("ExpectColumnUniqueValueCountToBeBetween", {"column": "customer_id", "max_value": 100}),
    ("ExpectColumnProportionOfUniqueValuesToBeBetween", {"column": "code", "min_value": 0.6, "max_value": 0.7}),
    ("ExpectColumnProportionOfUniqueValuesToBeBetween", {"column": "customer_id", "min_value": 0.5}),
    ("ExpectColumnUniqueValueCountToBeBetween", {
        "column": "product", "min_value": 5, "max_value": 5, "row_condition": 'col("status") == "F"', "condition_parser": "great_expectations"}),
)


def q_gate_distinct_sets(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate_suite(planted_orders(spark, sf), SETS).withColumn("distinct_values", F.col("observed_values")[0]).drop("observed_values")


def q_gate_unique_share(spark: SparkSession, sf: str) -> DataFrame:
    return _observed(evaluate_suite(planted_orders(spark, sf), SHARES))


def _sets_sql() -> str:
    rows = []
    for i, e in enumerate(SETS.expectations):
        listed = ", ".join(repr(v) for v in e.value_set)
        outside = f"count(DISTINCT CASE WHEN {e.column} NOT IN ({listed}) THEN {e.column} END)"
        absent = f"({len(e.value_set)} - count(DISTINCT CASE WHEN {e.column} IN ({listed}) THEN {e.column} END))"
        wrong = {"in_set": outside, "contain_set": absent, "equal_set": f"{outside} + {absent}"}[
            next(k for k in ("contain_set", "equal_set", "in_set") if e.type.endswith(k))
        ]
        rows.append(
            f"SELECT {_lit(SETS.name)} AS suite, {_lit(e.type)} AS expectation, {_lit(e.column)} AS column_name, count(*) AS element_count, "
            f"count(*) FILTER (WHERE {e.column} IS NULL) AS missing_count, {wrong} AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent, "
            f"{wrong} = 0 AS success, CAST(count(DISTINCT {e.column}) AS DOUBLE) AS distinct_values FROM {PLANTED}"
        )
    return " UNION ALL ".join(rows)


def _shares_sql() -> str:
    rows = []
    for i, e in enumerate(SHARES.expectations):
        where = "status = 'F'" if e.row_condition else "true"
        share = "proportion" in e.type
        value = f"count(DISTINCT {e.column})" + (f" / CAST(count({e.column}) AS DOUBLE)" if share else "")
        ok = " AND ".join(f"value {op} {b}" for op, b in ((">=", e.min_value), ("<=", e.max_value)) if b is not None)
        rows.append(_value_row(SHARES, i, 0, value, ok, f"{PLANTED} WHERE {where}", where))
    return " UNION ALL ".join(rows)


# --- distributions ----------------------------------------------------------

DISTRIBUTION = _suite(
    "order_distribution",
    ("ExpectColumnKLDivergenceToBeLessThan", {
        "column": "status", "threshold": 0.1, "partition_object": {"values": ["F", "O", "P"], "weights": [0.5, 0.25, 0.25]}}),
    ("ExpectColumnKLDivergenceToBeLessThan", {
        "column": "product", "threshold": 0.1, "internal_weight_holdout": 0.2,
        "partition_object": {"values": ["1-URGENT", "2-HIGH", "none"], "weights": [0.5, 0.5, 0.0]}}),
    ("ExpectColumnKLDivergenceToBeLessThan", {
        "column": "price", "threshold": 0.5, "tail_weight_holdout": 0.02,
        "partition_object": {"bins": [0.0, 100_000.0, 250_000.0, 400_000.0], "weights": [0.3, 0.4, 0.3]}}),
)
Z_SCORES = _suite(
    "order_z_scores",
    ("ExpectColumnValueZScoresToBeLessThan", {"column": "price", "threshold": 1.5, "double_sided": True, "mostly": 0.9}),
    ("ExpectColumnValueZScoresToBeLessThan", {"column": "price", "threshold": 1.25, "double_sided": False}),
    ("ExpectColumnValueZScoresToBeLessThan", {"column": "customer_id", "threshold": 2, "mostly": 0.5}),
)


def q_gate_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _observed(evaluate_suite(planted_orders(spark, sf), DISTRIBUTION))


def q_gate_z_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(evaluate_suite(planted_orders(spark, sf), Z_SCORES))


def _distribution_sql() -> str:
    # observed and expected weight per cell, written out for the three partitions
    status = "(SELECT count(*) AS c, CASE status WHEN 'F' THEN 0.5 ELSE 0.25 END AS q FROM orders_planted GROUP BY status)"
    others = "(SELECT count(DISTINCT product) FROM orders_planted WHERE product NOT IN ('1-URGENT', '2-HIGH', 'none'))"
    product = (
        "(SELECT count(*) AS c, CASE WHEN product IN ('1-URGENT', '2-HIGH') THEN 0.5 * 0.8 ELSE "
        f"0.2 / ({others} + 1) END AS q FROM orders_planted GROUP BY product)"
    )
    price = (
        "(SELECT count(*) AS c, CASE cell WHEN 0 THEN 0.01 WHEN 4 THEN 0.01 WHEN 2 THEN 0.4 * 0.98 ELSE 0.3 * 0.98 END AS q FROM "
        "(SELECT CASE WHEN price < 0 THEN 0 WHEN price < 100000 THEN 1 WHEN price < 250000 THEN 2 WHEN price <= 400000 THEN 3 ELSE 4 END AS cell "
        "FROM orders_planted) GROUP BY cell)"
    )
    rows = []
    for i, cells in enumerate((status, product, price)):
        e = DISTRIBUTION.expectations[i]
        value = "sum(c / CAST((SELECT count(*) FROM orders_planted) AS DOUBLE) * ln(c / CAST((SELECT count(*) FROM orders_planted) AS DOUBLE) / q))"
        rows.append(_value_row(DISTRIBUTION, i, 0, value, f"value <= {e.threshold}", cells))
    return f"WITH orders_planted AS {PLANTED} " + " UNION ALL ".join(rows)


def _z_sql() -> str:
    rows = []
    for i, e in enumerate(Z_SCORES.expectations):
        z = f"({e.column} - (SELECT avg({e.column}) FROM {PLANTED})) / (SELECT stddev_samp({e.column}) FROM {PLANTED})"
        z = f"abs({z})" if e.double_sided else z
        rows.append(_row(Z_SCORES, i, "count(*)", f"count(*) FILTER (WHERE {e.column} IS NULL)", f"count(*) FILTER (WHERE {z} >= {e.threshold})", PLANTED))
    return " UNION ALL ".join(rows)


# --- other tables -----------------------------------------------------------

OTHER = _suite(
    "orders_and_customers",
    ("ExpectColumnValuesToBeInOtherTable", {"column": "customer_id", "other_table_name": "customers", "other_columns": ["c_custkey"]}),
    ("ExpectColumnValuesToBeInOtherTable", {
        "column": "customer_id", "other_table_name": "customers", "other_columns": ["c_custkey"], "mostly": 0.9,
        "row_condition": "price > 0 or price is null", "condition_parser": "spark"}),
    ("ExpectColumnValuesToBeInOtherTable", {"column": "code", "other_table_name": "orders", "other_columns": ["o_orderkey"], "mostly": 0.5}),
    ("ExpectTableRowCountToEqualOtherTable", {"other_table_name": "orders"}),
    ("ExpectTableRowCountToEqualOtherTable", {"other_table_name": "customers"}),
)


def q_gate_other_table(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"customers": table(spark, sf, "customer"), "orders": table(spark, sf, "orders")}
    return _counts(evaluate_suite(planted_orders(spark, sf), OTHER, tables))


def _other_sql() -> str:
    rows = []
    for i, e in enumerate(OTHER.expectations):
        other = {"customers": "customer", "orders": "orders"}[e.other_table_name]
        if e.column is None:
            rows.append(
                f"SELECT {_lit(OTHER.name)}, {_lit(e.type)}, CAST(NULL AS VARCHAR), count(*), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), "
                f"CAST(NULL AS DOUBLE), count(*) = (SELECT count(*) FROM {other}) FROM {PLANTED}"
            )
            continue
        source = f"(SELECT * FROM {PLANTED} WHERE {e.row_condition or 'true'})"
        orphan = f"{e.column} IS NOT NULL AND {e.column} NOT IN (SELECT {e.other_columns[0]} FROM {other})"
        rows.append(_row(OTHER, i, "count(*)", f"count(*) FILTER (WHERE {e.column} IS NULL)", f"count(*) FILTER (WHERE {orphan})", source))
    return " UNION ALL ".join(rows)


# --- row conditions and unexpected values -----------------------------------

CONDITIONS = _suite(
    "conditioned_orders",
    ("ExpectColumnValuesToBeBetween", {
        "column": "price", "min_value": 0, "row_condition": "status = 'F' and customer_id is not null", "condition_parser": "spark"}),
    ("ExpectColumnValuesToNotBeNull", {
        "column": "customer_id", "mostly": 0.95, "row_condition": 'col("price") > 100000', "condition_parser": "great_expectations"}),
    ("ExpectColumnValuesToBeInSet", {
        "column": "status", "value_set": ["F", "O"], "row_condition": 'product == "5-LOW" & customer_id.notnull()', "condition_parser": "pandas"}),
    ("ExpectColumnValuesToNotMatchRegex", {"column": "product", "regex": "^[45]"}),
    ("ExpectColumnValueLengthsToBeBetween", {"column": "product", "min_value": 5, "max_value": 8, "row_condition": "price < 0", "condition_parser": "spark"}),
)
CONDITION_SQL = ("status = 'F' AND customer_id IS NOT NULL", "price > 100000", "product = '5-LOW' AND customer_id IS NOT NULL", "true", "price < 0")
FAULT_SQL = ("price < 0", "customer_id IS NULL", "status NOT IN ('F', 'O')", "regexp_matches(product, '^[45]')", "length(product) NOT BETWEEN 5 AND 8")
LISTED = _suite(
    "listed_orders",
    ("ExpectColumnValuesToBeBetween", {"column": "code", "min_value": 0}),
    ("ExpectColumnValuesToBeBetween", {"column": "customer_id", "max_value": 700}),
    ("ExpectColumnValuesToNotMatchRegex", {"column": "product", "regex": "^[1-4]"}),
    ("ExpectColumnValuesToNotBeInSet", {"column": "status", "value_set": ["P"], "row_condition": "price < 0", "condition_parser": "spark"}),
    ("ExpectColumnValuesToBeBetween", {"column": "id", "min_value": 0}),
)
LISTED_SQL = ("code < 0", "customer_id > 700", "regexp_matches(product, '^[1-4]')", "status = 'P' AND price < 0", "id < 0")


def q_gate_row_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate_suite(planted_orders(spark, sf), CONDITIONS)


def q_gate_unexpected_values(spark: SparkSession, sf: str) -> DataFrame:
    return unexpected_values(planted_orders(spark, sf), LISTED)


def _conditions_sql() -> str:
    rows = []
    for i, (e, where, fault) in enumerate(zip(CONDITIONS.expectations, CONDITION_SQL, FAULT_SQL)):
        whole = e.type.endswith("not_be_null")
        rows.append(_row(CONDITIONS, i, "count(*)", f"count(*) FILTER (WHERE {e.column} IS NULL)", f"count(*) FILTER (WHERE {fault})",
                         f"(SELECT * FROM {PLANTED} WHERE {where})", "n" if whole else None))
    return " UNION ALL ".join(rows)


def _listed_sql() -> str:
    rows = [
        f"SELECT {_lit(LISTED.name)} AS suite, {_lit(e.type)} AS expectation, {_lit(e.column)} AS column_name, "
        "CAST(row_number() OVER (ORDER BY count(*) DESC, v) AS INTEGER) AS value_rank, v AS unexpected_value, count(*) AS value_count "
        f"FROM (SELECT CAST({e.column} AS VARCHAR) AS v FROM {PLANTED} WHERE {fault}) GROUP BY v QUALIFY value_rank <= 20"
        for e, fault in zip(LISTED.expectations, LISTED_SQL)
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({r})" for r in rows)


QUERIES = {
    "gate_unique": q_gate_unique,
    "gate_compound_unique": q_gate_compound_unique,
    "gate_order": q_gate_order,
    "gate_quantiles": q_gate_quantiles,
    "gate_distinct_sets": q_gate_distinct_sets,
    "gate_unique_share": q_gate_unique_share,
    "gate_distribution": q_gate_distribution,
    "gate_z_scores": q_gate_z_scores,
    "gate_other_table": q_gate_other_table,
    "gate_row_conditions": q_gate_row_conditions,
    "gate_unexpected_values": q_gate_unexpected_values,
}
ORACLES = {
    "gate_unique": _unique_sql(UNIQUE),
    "gate_compound_unique": _unique_sql(COMPOUND),
    "gate_order": _order_sql(),
    "gate_quantiles": _quantile_sql(),
    "gate_distinct_sets": _sets_sql(),
    "gate_unique_share": _shares_sql(),
    "gate_distribution": _distribution_sql(),
    "gate_z_scores": _z_sql(),
    "gate_other_table": _other_sql(),
    "gate_row_conditions": _conditions_sql(),
    "gate_unexpected_values": _listed_sql(),
}
