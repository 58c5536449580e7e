import json
import math

import pytest
from pyspark.sql import types as T

from strata.functions.expectations import (
    BETWEEN,
    NOT_NULL,
    Suite,
    UnknownExpectation,
    between,
    from_spec,
    match_regex,
    not_null,
    row_count_between,
)
from strata.operators.gates import check_suite, evaluate_suite

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("email", T.StringType()),
    ]
)
ROWS = [
    (1, 10.0, "a@b.com"),
    (None, 0.0, "bad"),
    (3, float("nan"), None),
    (4, None, "x@y.org"),
    (5, 10000.0, "no-at.com"),
    (6, -0.5, "c@d.io"),
]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def results(df, *exps):
    return {(r["expectation"], r["column_name"]): r.asDict() for r in evaluate_suite(df, Suite("s", exps)).collect()}


def test_not_null_counts_null_and_nan(df):
    r = results(df, not_null("id"), not_null("price"), not_null("email"))
    assert r[(NOT_NULL, "id")]["unexpected_count"] == 1
    assert r[(NOT_NULL, "price")]["unexpected_count"] == 2  # NULL and NaN
    assert r[(NOT_NULL, "email")]["unexpected_count"] == 1
    assert r[(NOT_NULL, "id")]["element_count"] == 6
    assert math.isclose(r[(NOT_NULL, "price")]["unexpected_percent"], 100 * 2 / 6)
    assert not any(v["success"] for v in r.values())


def test_between_is_inclusive_and_skips_missing(df):
    r = results(df, between("price", 0, 10000))[(BETWEEN, "price")]
    assert r["missing_count"] == 2
    assert r["unexpected_count"] == 1  # only -0.5; 0.0 and 10000.0 hit the bounds
    assert math.isclose(r["unexpected_percent"], 100 / 4)
    assert r["success"] is False


def test_between_strict_and_open_bounds(df):
    strict = results(df, between("price", 0, 10000, strict_min=True, strict_max=True))[(BETWEEN, "price")]
    assert strict["unexpected_count"] == 3
    open_top = results(df, between("price", min_value=0))[(BETWEEN, "price")]
    assert open_top["unexpected_count"] == 1


def test_regex_search_semantics_skip_nulls(df):
    r = results(df, match_regex("email", r"[^@]+@[^@]+\.[^@]+"))
    row = r[("expect_column_values_to_match_regex", "email")]
    assert row["missing_count"] == 1
    assert row["unexpected_count"] == 2  # "bad" and "no-at.com"
    anchored = results(df, match_regex("email", r"^c@"))
    assert anchored[("expect_column_values_to_match_regex", "email")]["unexpected_count"] == 4


def test_mostly(df):
    r = results(df, not_null("id", mostly=0.8))[(NOT_NULL, "id")]
    assert r["success"] is True  # 5 of 6 present
    r = results(df, not_null("price", mostly=0.8))[(NOT_NULL, "price")]
    assert r["success"] is False  # 4 of 6


def test_row_count(df):
    rows = [r.asDict() for r in evaluate_suite(df, Suite("s", (row_count_between(1, 6), row_count_between(7, None)))).collect()]
    rows = sorted(rows, key=lambda x: x["success"])
    assert [x["success"] for x in rows] == [False, True]
    assert all(x["element_count"] == 6 for x in rows)


def test_empty_batch_passes_column_checks(spark):
    empty = spark.createDataFrame([], SCHEMA)
    gate = check_suite(empty, Suite("s", (not_null("id"), between("price", 0, 1), match_regex("email", "@"))))
    assert gate.success
    assert all(r["element_count"] == 0 for r in gate.results)
    assert not check_suite(empty, Suite("s", (row_count_between(1, 10),))).success


def test_missing_column_is_a_technical_failure(df):
    gate = check_suite(df, Suite("s", (not_null("nope"),)))
    assert not gate.success
    assert gate.error.startswith("Technical validation failure")


def test_one_pass_per_suite(df):
    plan = evaluate_suite(df, Suite("s", (not_null("id"), between("price", 0, 1), row_count_between(1, 9))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") <= 2 and "Union" not in text


def test_specs_by_class_name_and_type():
    a = from_spec({"expectation": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "id"}})
    b = from_spec({"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "id"}})
    assert a == b == not_null("id")
    with pytest.raises(UnknownExpectation):
        from_spec({"expectation": "ExpectSomethingElse", "kwargs": {}})
    with pytest.raises(TypeError):
        from_spec({"expectation": "ExpectColumnValuesToNotBeNull", "kwargs": {"col": "id"}})
    with pytest.warns(UserWarning):
        s = Suite.from_specs("s", [{"expectation": "ExpectSomethingElse"}, {"type": NOT_NULL, "kwargs": {"column": "x"}}],
                             strict=False)
    assert s.expectations == (not_null("x"),)


def test_saved_suite_json_roundtrip():
    saved = {
        "name": "check_stg_sales_bronze_source",
        "expectations": [
            {"type": "expect_table_row_count_to_be_between", "kwargs": {"max_value": 2000000, "min_value": 1},
             "meta": {}, "severity": "critical", "id": "x"},
            {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "customer_id"}},
        ],
    }
    s = Suite.from_json(json.dumps(saved))
    assert s.expectations == (row_count_between(1, 2000000), not_null("customer_id"))
    assert Suite.from_json(s.to_json()) == s


def test_driver_rule_equals_spark_rule(spark):
    """``result_rows`` (driver, from observed counts) and
    ``results_from_metrics`` (Spark) implement one rule."""
    import random

    from strata.functions.expectations import metric_schema, result_rows, results_from_metrics

    suite = Suite("s", (row_count_between(2, 9), not_null("id", mostly=0.7), between("price", 0, 5, mostly=0.5),
                        match_regex("email", "@")))
    rng = random.Random(3)
    schema = metric_schema(suite)
    for _ in range(25):
        n = rng.randint(0, 12)
        counts = {f.name: rng.randint(0, n) for f in schema.fields}
        counts["__rows"] = n
        for i in (2, 3):  # unexpected never exceeds the present values
            counts[f"__unexpected_{i}"] = min(counts[f"__unexpected_{i}"], n - counts[f"__missing_{i}"])
        spark_rows = [r.asDict() for r in results_from_metrics(
            spark.createDataFrame([tuple(counts[f.name] for f in schema.fields)], schema), suite).collect()]
        assert spark_rows == result_rows(suite, counts)


def test_report_only_kwargs_are_kept_as_meta():
    e = from_spec({"expectation": "ExpectColumnValuesToNotBeNull",
                   "kwargs": {"column": "id", "result_format": "COMPLETE", "severity": "critical"}})
    assert e == not_null("id") and e.meta == {"result_format": "COMPLETE", "severity": "critical"}
    with pytest.raises(TypeError):
        from_spec({"expectation": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "id", "row_condition": "x>1"}})


def test_step_suites_export_and_load(tmp_path):
    from strata.plans import medallion

    named = medallion.suites()
    assert sorted(named) == [
        "check_customers_silver_target",
        "check_sales_silver_target",
        "check_stg_customers_bronze_source",
        "check_stg_customers_bronze_target",
        "check_stg_sales_bronze_source",
        "check_stg_sales_bronze_target",
    ]
    assert sum(len(s.expectations) for s in named.values()) == 7
    medallion.export_suites(str(tmp_path))
    assert medallion.load_suites(str(tmp_path)) == named
