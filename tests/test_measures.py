"""Measured expectations against plain Python, on awkward and skewed rows."""

import datetime as dt
import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.functions import expectations as X
from strata.functions import measures
from strata.functions.expectations import CLASS_TO_TYPE, Expectation, Suite, from_spec, not_null, row_count_between
from strata.operators.gates import check_suite, evaluate_suite, suite_columns, unexpected_values, verdict_from_metrics
from strata.plans.steps import Endpoint, GateFailed, Step, read_gate_results, read_gate_values, run_step
from strata.sources.io import write_batch


def one(df, cls, tables=None, **kwargs):
    suite = Suite("s", (from_spec({"expectation": cls, "kwargs": kwargs}),))
    return evaluate_suite(df, suite, tables).first().asDict()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(3000):
        x = None if i % 17 == 0 else float("nan") if i % 29 == 0 else 5.0 if i % 3 == 0 else round(rng.gauss(0, 50), 1)
        out.append((i, x, None if i % 11 == 0 else "v%d" % rng.randrange(40), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(90))))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, name string, day date").repartition(7).cache()


def present(rows, k):
    return [r[k] for r in rows if r[k] is not None and r[k] == r[k]]


def test_class_names_follow_the_types():
    assert CLASS_TO_TYPE["ExpectColumnValuesToBeUnique"] == X.UNIQUE
    assert CLASS_TO_TYPE["ExpectColumnKLDivergenceToBeLessThan"] == X.DIVERGENCE
    assert CLASS_TO_TYPE["ExpectColumnValueZScoresToBeLessThan"] == X.Z_SCORES
    assert CLASS_TO_TYPE["ExpectTableRowCountToEqualOtherTable"] == X.SAME_ROW_COUNT
    assert set(CLASS_TO_TYPE.values()) == X.TYPES


@pytest.mark.parametrize("cls, kwargs", [
    ("ExpectColumnValuesToBeInSet", {"column": "x"}),
    ("ExpectCompoundColumnsToBeUnique", {"column": "x"}),
    ("ExpectColumnValuesToBeIncreasing", {"column": "x"}),
    ("ExpectColumnMedianToBeBetween", {"column": "x"}),
    ("ExpectColumnKLDivergenceToBeLessThan", {"column": "x", "threshold": 1, "partition_object": {"bins": [0, 1], "weights": [1, 1]}}),
    ("ExpectColumnKLDivergenceToBeLessThan", {"column": "x", "threshold": 1, "partition_object": {"bins": [1, 0], "weights": [1]}}),
    ("ExpectColumnQuantileValuesToBeBetween", {"column": "x", "quantile_ranges": {"quantiles": [2], "value_ranges": [[0, 1]]}}),
    ("ExpectColumnValuesToBeUnique", {"column": "x", "row_condition": "x > 1"}),
    ("ExpectColumnValuesToBeUnique", {"column": "x", "row_condition": "x > 1", "condition_parser": "mine"}),
])
def test_incomplete_arguments_raise(cls, kwargs):
    with pytest.raises(TypeError):
        from_spec({"expectation": cls, "kwargs": kwargs})


def test_saved_form_keeps_every_argument():
    specs = [
        ("ExpectColumnQuantileValuesToBeBetween", {"column": "x", "quantile_ranges": {"quantiles": [0.1, 0.5], "value_ranges": [[0, 1], [None, 3]]}}),
        ("ExpectColumnKLDivergenceToBeLessThan", {"column": "x", "threshold": 0.5, "partition_object": {"values": ["a"], "weights": [1.0]}}),
        ("ExpectCompoundColumnsToBeUnique", {"column_list": ["a", "b"], "ignore_row_if": "never"}),
        ("ExpectColumnValuesToBeIncreasing", {"column": "x", "order_by": ["id"], "strictly": True}),
        ("ExpectColumnValuesToBeInSet", {"column": "x", "value_set": [1, 2], "row_condition": "x > 0", "condition_parser": "spark"}),
    ]
    suite = Suite.from_specs("s", [{"expectation": c, "kwargs": k} for c, k in specs])
    saved = json.loads(suite.to_json())
    assert Suite.from_json(suite.to_json()) == suite and hash(suite) == hash(Suite.from_json(suite.to_json()))
    assert saved["expectations"][2]["kwargs"] == {"column_list": ["a", "b"], "ignore_row_if": "never"}
    assert saved["expectations"][0]["kwargs"]["quantile_ranges"] == {"quantiles": [0.1, 0.5], "value_ranges": [[0, 1], [None, 3]]}


def test_unique_counts_all_rows_of_repeated_values(df, rows):
    for k, name in ((0, "id"), (1, "x"), (2, "name")):
        values = present(rows, k)
        r = one(df, "ExpectColumnValuesToBeUnique", column=name)
        wrong = sum(n for n in Counter(values).values() if n > 1)
        assert (r["unexpected_count"], r["missing_count"], r["success"]) == (wrong, 3000 - len(values), wrong == 0)


@pytest.mark.parametrize("rule", X.IGNORE_ROW_IF)
def test_compound_keys(df, rows, rule):
    missing = lambda v: v is None or v != v
    skip = {"never": lambda k: False, "any_value_is_missing": lambda k: any(map(missing, k)), "all_values_are_missing": lambda k: all(map(missing, k))}[rule]
    keys = [tuple(None if missing(v) else v for v in (r[1], r[2])) for r in rows]
    groups = Counter(tuple("nan" if v is not None and v != v else v for v in (r[1], r[2])) for r in rows)
    wrong = sum(n for k, n in groups.items() if n > 1 and not skip(tuple(None if v == "nan" else v for v in k)))
    r = one(df, "ExpectCompoundColumnsToBeUnique", column_list=["x", "name"], ignore_row_if=rule)
    assert (r["unexpected_count"], r["missing_count"]) == (wrong, sum(map(skip, keys)))
    assert r["column_name"] == "x, name"


def test_a_hot_value_is_combined_before_the_shuffle(spark):
    hot = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    assert measures.repeated_rows(hot, ("k",), "never") == (60_000, 0, 20_001)
    plan = hot.groupBy("k").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


@pytest.mark.parametrize("strictly", [False, True])
@pytest.mark.parametrize("falling", [False, True])
def test_order_across_range_partitions(spark, df, rows, strictly, falling):
    cls = "ExpectColumnValuesToBeDecreasing" if falling else "ExpectColumnValuesToBeIncreasing"
    for k, name, order in ((0, "id", ["id"]), (1, "x", ["id"]), (2, "name", ["day", "id"]), (1, "x", ["day"])):
        sign = -1 if falling else 1
        at = {"id": 0, "day": 3}
        kept = [r for r in rows if r[k] is not None and r[k] == r[k]]
        kept.sort(key=lambda r: r[k], reverse=falling)  # ties of the order columns
        values = [r[k] for r in sorted(kept, key=lambda r: tuple(r[at[o]] for o in order))]
        less = lambda a, b: (b < a if sign > 0 else b > a) or (strictly and a == b)
        wrong = sum(less(a, b) for a, b in zip(values, values[1:]))
        r = one(df, cls, column=name, order_by=order, strictly=strictly)
        assert (r["unexpected_count"], r["success"]) == (wrong, wrong == 0)


def test_order_of_a_hot_key(spark):
    df = spark.range(40_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    rows = sorted((0 if i % 3 == 0 else i, i % 5) for i in range(40_000))
    wrong = sum(b[1] < a[1] for a, b in zip(rows, rows[1:]))
    assert measures.order_violations(df, "v", ("k",), False, False) == wrong


def test_quantiles_are_exact(df, rows):
    values = sorted(present(rows, 1))
    quantiles = [0, 0.001, 0.3, 0.34, 0.5, 0.77, 0.999, 1]
    ranges = {"quantiles": quantiles, "value_ranges": [[None, None]] * len(quantiles)}
    got = one(df, "ExpectColumnQuantileValuesToBeBetween", column="x", quantile_ranges=ranges)["observed_values"]
    assert got == [values[max(1, math.ceil(len(values) * q)) - 1] for q in quantiles]
    middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    r = one(df, "ExpectColumnMedianToBeBetween", column="x", min_value=middle, strict_min=True)
    assert r["observed_values"] == [middle] and not r["success"]


@pytest.mark.parametrize("hot", [0, 1, 2])
def test_order_statistics_narrow_any_bracket(spark, monkeypatch, hot):
    """Small sketches and little room to gather: many rounds, hot values at
    the ends of brackets, and brackets that miss the rank."""
    monkeypatch.setattr(measures, "GATHER", 20)
    rng = random.Random(hot)
    numbers = [rng.randrange(10_000) for _ in range(6000)] + [4000] * 3000 * (hot > 0) + [4010] * 3000 * (hot > 1)
    df = spark.createDataFrame([(n,) for n in numbers], "v int").repartition(5)
    numbers.sort()
    ranks = [1, 2, 100, len(numbers) // 2, len(numbers) // 2 + 1, len(numbers) - 1, len(numbers)]
    for brackets in ([(0, 9999)] * 7, [(4000, 4010)] * 7, [(9000, 9001)] * 7):
        assert measures.order_statistics(df, ranks, brackets) == [numbers[k - 1] for k in ranks]


def test_distinct_values(df, rows):
    names = set(present(rows, 2))
    assert one(df, "ExpectColumnDistinctValuesToEqualSet", column="name", value_set=sorted(names))["success"]
    r = one(df, "ExpectColumnDistinctValuesToEqualSet", column="name", value_set=["v1", "none", "v2", "v2", None])
    assert (r["unexpected_count"], r["observed_values"]) == (len(names) - 2 + 1, [float(len(names))])
    assert one(df, "ExpectColumnDistinctValuesToBeInSet", column="name", value_set=["v1"])["unexpected_count"] == len(names) - 1
    assert one(df, "ExpectColumnDistinctValuesToContainSet", column="name", value_set=["v1", "zz"])["unexpected_count"] == 1
    values = present(rows, 1)
    r = one(df, "ExpectColumnProportionOfUniqueValuesToBeBetween", column="x", max_value=0.5)
    assert r["observed_values"] == [len(set(values)) / len(values)]
    assert one(df, "ExpectColumnUniqueValueCountToBeBetween", column="x", min_value=len(set(values)))["success"]


def test_divergence(df, rows):
    values = present(rows, 1)
    bins = [-20.0, 0.0, 5.0, 40.0]
    counts = [sum(-20 <= v < 0 for v in values), sum(0 <= v < 5 for v in values), sum(5 <= v <= 40 for v in values),
              sum(v < -20 for v in values), sum(v > 40 for v in values)]
    want = [0.18, 0.36, 0.36, 0.05, 0.05]
    p = [c / len(values) for c in counts]
    kl = sum(a * math.log(a / b) for a, b in zip(p, want) if a)
    part = {"bins": bins, "weights": [0.2, 0.4, 0.4]}
    r = one(df, "ExpectColumnKLDivergenceToBeLessThan", column="x", threshold=kl + 1e-9, partition_object=part, tail_weight_holdout=0.1)
    assert r["success"] and r["observed_values"][0] == pytest.approx(kl, abs=1e-12)
    r = one(df, "ExpectColumnKLDivergenceToBeLessThan", column="x", threshold=5, partition_object=part)
    assert not r["success"] and r["observed_values"] == [math.inf]  # values in a tail of no weight
    names = present(rows, 2)
    known = {"values": ["v1", "v2"], "weights": [0.5, 0.5]}
    others = Counter(n for n in names if n not in ("v1", "v2"))
    kl = sum(c / len(names) * math.log(c / len(names) / (0.1 / len(others))) for c in others.values())
    kl += sum(names.count(v) / len(names) * math.log(names.count(v) / len(names) / 0.45) for v in ("v1", "v2"))
    r = one(df, "ExpectColumnKLDivergenceToBeLessThan", column="name", threshold=1, partition_object=known, internal_weight_holdout=0.1)
    assert r["observed_values"][0] == pytest.approx(kl, abs=1e-9)
    assert one(df, "ExpectColumnKLDivergenceToBeLessThan", column="name", threshold=1, partition_object=known)["observed_values"] == [math.inf]


def test_z_scores_and_statistics(spark, df, rows):
    values = present(rows, 1)
    mean = sum(values) / len(values)
    spread = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
    for both, limit in ((True, 1.5), (False, 1.0), (False, -0.5)):
        far = sum((abs(v - mean) if both else v - mean) / spread >= limit for v in values)
        r = one(df, "ExpectColumnValueZScoresToBeLessThan", column="x", threshold=limit, double_sided=both)
        assert r["unexpected_count"] == far, (both, limit)
    flat = spark.createDataFrame([(1.0,)] * 4, "x double")
    assert one(flat, "ExpectColumnValueZScoresToBeLessThan", column="x", threshold=0.1)["success"]
    assert one(df, "ExpectColumnMaxToBeBetween", column="x", min_value=max(values), max_value=max(values))["success"]
    assert not one(df, "ExpectColumnMinToBeBetween", column="x", min_value=min(values), strict_min=True)["success"]
    assert one(df, "ExpectColumnMeanToBeBetween", column="x", min_value=mean - 1e-6, max_value=mean + 1e-6)["success"]
    assert one(df, "ExpectColumnStdevToBeBetween", column="x", min_value=spread - 1e-6, max_value=spread + 1e-6)["success"]
    assert one(df, "ExpectColumnSumToBeBetween", column="x", min_value=sum(values) - 1e-3, max_value=sum(values) + 1e-3)["success"]


def test_other_tables(spark, df, rows):
    other = spark.createDataFrame([("v%d" % i,) for i in range(30)] + [(None,)] * 3, "key string")
    tables = {"names": other, "same": df}
    orphans = sum(int(v[1:]) >= 30 for v in present(rows, 2))
    r = one(df, "ExpectColumnValuesToBeInOtherTable", tables, column="name", other_table_name="names", other_columns="key")
    assert (r["unexpected_count"], r["missing_count"]) == (orphans, 3000 - len(present(rows, 2)))
    assert one(df, "ExpectTableRowCountToEqualOtherTable", tables, other_table_name="same")["success"]
    assert not one(df, "ExpectTableRowCountToEqualOtherTable", tables, other_table_name="names")["success"]
    none = other.where("key = 'x'")
    r = one(df, "ExpectColumnValuesToBeInOtherTable", {"names": none}, column="name", other_table_name="names", other_columns="key")
    assert r["unexpected_count"] == len(present(rows, 2))
    df.createOrReplaceTempView("measured_rows")  # names the suite's caller does not bind come from the catalog
    assert one(df, "ExpectTableRowCountToEqualOtherTable", other_table_name="measured_rows")["success"]
    gate = check_suite(df, Suite("s", (Expectation(X.SAME_ROW_COUNT, other_table_name="no_such_table"),)))
    assert not gate.success and gate.error


def test_row_conditions_are_filtered_counts_of_one_scan(df, rows):
    suite = Suite("s", tuple(
        Expectation(X.BETWEEN, column="x", min_value=0, row_condition=c, condition_parser=p)
        for c, p in (("name = 'v3'", "spark"), ('col("name").notNull() & col("id") > 100', "great_expectations"), ('name == "v5" | id < 9', "pandas"))
    ) + (row_count_between(1), Expectation(X.MEDIAN, column="x", min_value=0, row_condition="id >= 1500", condition_parser="spark")))
    chosen = [lambda r: r[2] == "v3", lambda r: r[2] is not None and r[0] > 100, lambda r: r[2] == "v5" or r[0] < 9]
    got = evaluate_suite(df, suite).collect()
    for r, keep in zip(got, chosen):
        mine = [x for x in rows if keep(x)]
        assert r["element_count"] == len(mine)
        assert r["unexpected_count"] == sum(v < 0 for v in present(mine, 1))
    assert got[3]["element_count"] == 3000 and got[4]["element_count"] == 1500
    counted = Suite("s", suite.expectations[:4])
    plan = evaluate_suite(df, counted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1


def test_the_whole_common_pass_rides_on_one_scan(spark, tmp_path, df):
    path = str(tmp_path / "t")
    df.write.parquet(path)
    suite = Suite("s", (
        not_null("id"), Expectation(X.MEDIAN, column="x", min_value=0), Expectation(X.UNIQUE, column="id"),
        Expectation(X.DISTINCT_IN_SET, column="name", value_set=("a",)), Expectation(X.Z_SCORES, column="x", threshold=2),
        Expectation(X.DIVERGENCE, column="x", threshold=1, partition_object={"bins": [0, 1], "weights": [1]}),
    ))
    read = spark.read.parquet(path)
    plan = read.agg(*suite_columns(suite, read.schema))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "day" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_tables_pass(df):
    none = df.where("id < 0")
    suite = Suite("s", (
        Expectation(X.UNIQUE, column="x"), Expectation(X.INCREASING, column="x", order_by=("id",)),
        Expectation(X.MEDIAN, column="x", min_value=5), Expectation(X.QUANTILES, column="x", quantile_ranges=((0.5, 1, 2),)),
        Expectation(X.DISTINCT_IN_SET, column="x", value_set=(1.0,)), Expectation(X.UNIQUE_PROPORTION, column="x", min_value=0.5),
        Expectation(X.DIVERGENCE, column="x", threshold=0.1, partition_object={"bins": [0, 1], "weights": [1]}),
        Expectation(X.Z_SCORES, column="x", threshold=1), Expectation(X.COLUMN_MAX, column="x", max_value=1),
        Expectation(X.IN_OTHER_TABLE, column="id", other_table_name="t", other_columns=("id",)),
    ))
    gate = check_suite(none, suite, {"t": none})
    assert gate.success and gate.error is None, (gate.error, gate.failed)


def test_simple_value_checks(df, rows):
    r = one(df, "ExpectColumnValuesToBeNull", column="name", mostly=0.05)
    assert (r["unexpected_count"], r["success"]) == (len(present(rows, 2)), True)
    assert one(df, "ExpectColumnValuesToBeInSet", column="name", value_set=[])["unexpected_count"] == len(present(rows, 2))
    assert one(df, "ExpectColumnValuesToNotBeInSet", column="x", value_set=[5.0])["unexpected_count"] == present(rows, 1).count(5.0)
    assert one(df, "ExpectColumnValueLengthsToBeBetween", column="name", max_value=2)["unexpected_count"] == sum(len(n) > 2 for n in present(rows, 2))
    assert one(df, "ExpectTableRowCountToEqual", value=3000)["success"] and not one(df, "ExpectTableRowCountToEqual", value=1)["success"]


def test_unexpected_values_have_exact_counts(df, rows):
    suite = Suite("s", (Expectation(X.BETWEEN, column="x", max_value=0), Expectation(X.NOT_MATCH_REGEX, column="name", regex="v[12]"), not_null("id")))
    got = unexpected_values(df, suite, top=5).collect()
    want = sorted(Counter(str(v) for v in present(rows, 1) if v > 0).items(), key=lambda c: (-c[1], c[0]))[:5]
    assert [(r["unexpected_value"], r["value_count"]) for r in sorted(got, key=lambda r: r["value_rank"]) if r["column_name"] == "x"] == want
    want = sorted(Counter(v for v in present(rows, 2) if v[1] in "12").items(), key=lambda c: (-c[1], c[0]))[:5]
    assert [(r["unexpected_value"], r["value_count"]) for r in sorted(got, key=lambda r: r["value_rank"]) if r["column_name"] == "name"] == want
    assert unexpected_values(df, Suite("s", (not_null("id"),))).count() == 0


def test_verdict_needs_the_frame_only_for_measures(df):
    suite = Suite("s", (not_null("id"),))
    assert verdict_from_metrics(suite, {"__rows": 3, "__missing_0": 0}).success
    assert verdict_from_metrics(Suite("s", (Expectation(X.UNIQUE, column="id"),)), {}).error


def test_a_step_with_measured_gates(spark, lake, df):
    date = "2026-04-19"
    path = f"{lake.root}/landing/t/dt={date}"
    write_batch(df.withColumnRenamed("x", "price"), path, "parquet")
    step = lambda name, source=(), target=(): Step(
        name=name, group="bronze", source=Endpoint("{{ root }}/landing/t/dt={{ execution_date }}", "parquet"),
        target=Endpoint(f"{{{{ root }}}}/bronze/{name}/dt={{{{ execution_date }}}}", "parquet"),
        source_expectations=tuple(source), target_expectations=tuple(target),
    )
    same = Expectation(X.SAME_ROW_COUNT, other_table_name="source_data")
    good = run_step(spark, step("good", [Expectation(X.UNIQUE, column="id")], [Expectation(X.MEDIAN, column="id", min_value=1499), same, not_null("id")]), date, lake)
    assert good.status == "success" and good.rows_in == good.rows_out == 3000 and good.gate_status == "passed"
    with pytest.raises(GateFailed) as err:
        run_step(spark, step("twice", (), [Expectation(X.UNIQUE, column="name"), not_null("id")]), date, lake)
    assert err.value.result.status == "target_fail" and not spark.read.parquet(err.value.result.quarantine_path).isEmpty()
    with pytest.raises(GateFailed):
        run_step(spark, step("named", [Expectation(X.NOT_IN_SET, column="name", value_set=("v1", "v2"))]), date, lake)
    results = {(r["step"], r["expectation"]): r for r in read_gate_results(spark, lake).collect()}
    assert results[("good", X.MEDIAN)]["observed_values"] == [1499.5] and results[("good", X.SAME_ROW_COUNT)]["success"]
    assert not results[("twice", X.UNIQUE)]["success"] and results[("twice", X.NOT_NULL)]["success"]
    values = read_gate_values(spark, lake).where("step = 'named'").collect()
    assert {v["unexpected_value"] for v in values} == {"v1", "v2"} and all(v["value_count"] > 0 for v in values)
