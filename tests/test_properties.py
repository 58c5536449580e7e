"""Property tests: Spark operators against plain-Python brute force."""

import datetime as dt
import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.expectations import Suite, between, match_regex, not_null, row_count_between
from strata.operators import marts, transforms
from strata.operators.gates import evaluate_suite

from test_transforms import CUSTOMERS, SALES

MONTHS = [dt.date(2024, 1, 5), dt.date(2024, 1, 28), dt.date(2024, 2, 1), dt.date(2024, 3, 9)]
PRICE = st.one_of(st.none(), st.floats(-5, 1000, allow_nan=False), st.integers(0, 100_000).map(lambda c: c / 100))
sale = st.tuples(
    st.one_of(st.none(), st.integers(1, 50)),  # id
    st.one_of(st.none(), st.integers(1, 6)),  # customer_id (small range: hot keys)
    PRICE,
    st.sampled_from(MONTHS),
)
customer = st.tuples(st.one_of(st.none(), st.integers(1, 8)), st.sampled_from(["sp", "rj", None]))
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, database=None,
                    suppress_health_check=list(HealthCheck))


def brute_gold(sales, customers):
    """Join-then-aggregate over unrounded prices."""
    regions = defaultdict(list)
    for cid, state in customers:
        if cid is not None:
            regions[cid].append(state.upper() if state else None)
    groups = defaultdict(lambda: [0.0, 0, 0])
    for sid, cid, price, day in sales:
        if price is None or not price > 0:
            continue  # silver filter
        month = day.replace(day=1)
        for region in regions.get(cid, [None]) if cid is not None else [None]:
            g = groups[(region, month)]
            g[0] += price
            g[1] += sid is not None
            g[2] += 1
    out = {}
    for key, (rev, orders, n) in groups.items():
        avg = math.floor(math.floor(rev / n * 1e9 + 0.5) / 1e9 * 100 + 0.5) / 100
        out[key] = (rev, orders, avg)
    return out


@SETTINGS
@given(st.lists(sale, max_size=40), st.lists(customer, max_size=10))
def test_mart_matches_brute_force(spark, sales_rows, customer_rows):
    sales = transforms.silver_sales(spark.createDataFrame(
        [(i, c, "p", p, d) for i, c, p, d in sales_rows], SALES))
    customers = transforms.silver_customers(spark.createDataFrame(
        [(c, "n", "e@x.io", "city", s) for c, s in customer_rows], CUSTOMERS))
    want = brute_gold(sales_rows, customer_rows)
    for strategy in ("broadcast", "pre_aggregate"):
        got = {(r["region"], r["sale_month"]): r for r in marts.sales_summary(sales, customers, strategy).collect()}
        assert set(got) == set(want), strategy
        for key, (rev, orders, avg) in want.items():
            r = got[key]
            assert math.isclose(r["total_revenue"], rev, rel_tol=1e-9, abs_tol=1e-6)
            assert r["total_orders"] == orders and r["avg_ticket"] == avg, (strategy, key)
    enriched = marts.enrich_sales(sales, customers).count()
    assert enriched == sum(
        max(1, sum(1 for c, _ in customer_rows if c == cid)) if cid is not None else 1
        for _, cid, p, _ in sales_rows if p is not None and p > 0
    )


cell = st.one_of(st.none(), st.just(float("nan")), st.floats(allow_nan=False, min_value=-50, max_value=50))
text = st.one_of(st.none(), st.sampled_from(["a@b.co", "bad", "x@y", "@z.io", "k@l.m"]))


@SETTINGS
@given(st.lists(st.tuples(cell, text), max_size=30), st.floats(0, 1))
def test_gates_match_brute_force(spark, rows, mostly):
    import re

    df = spark.createDataFrame(rows, "x double, s string")
    suite = Suite("p", (not_null("x", mostly=mostly), between("x", -10, 10, mostly=mostly),
                        match_regex("s", r"[^@]+@[^@]+\.[^@]+"), row_count_between(1, 20)))
    got = [r.asDict() for r in evaluate_suite(df, suite).collect()]
    n = len(rows)
    missing_x = sum(1 for x, _ in rows if x is None or math.isnan(x))
    present_x = [x for x, _ in rows if x is not None and not math.isnan(x)]
    outside = sum(1 for x in present_x if not -10 <= x <= 10)
    present_s = [s for _, s in rows if s is not None]
    nomatch = sum(1 for s in present_s if not re.search(r"[^@]+@[^@]+\.[^@]+", s))

    def ok(base, bad, m):
        return base == 0 or (base - bad) / base >= m

    assert got[0]["unexpected_count"] == missing_x and got[0]["success"] == ok(n, missing_x, mostly)
    assert got[1]["unexpected_count"] == outside and got[1]["success"] == ok(len(present_x), outside, mostly)
    assert got[2]["unexpected_count"] == nomatch and got[2]["success"] == ok(len(present_s), nomatch, 1.0)
    assert got[3]["element_count"] == n and got[3]["success"] == (1 <= n <= 20)


id_text = st.one_of(
    st.integers(-10**15, 10**15).map(str),
    st.integers(-10**15, 10**15).map(lambda i: f"{i}.0"),
    st.integers(0, 10**6).map(lambda i: f" {i} "),
    st.just(""),
)


@SETTINGS
@given(st.lists(id_text, min_size=1, max_size=30))
def test_integral_ids_from_text(spark, values):
    from pyspark.sql import functions as F

    from strata.functions.columns import integral_from_text

    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r["v"] for r in df.select(integral_from_text("s").alias("v")).collect()]
    want = [None if not v.strip() else int(float(v)) if v.strip().endswith(".0") else int(v) for v in values]
    assert got == want
    bad = spark.createDataFrame([("12.5",)], "s string").select(integral_from_text(F.col("s")).alias("v"))
    with pytest.raises(Exception):
        bad.collect()
