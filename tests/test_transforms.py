import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import round_half_away
from strata.operators import marts, transforms
from strata.sources.schemas import LANDING_SALES
from strata.sources.testdata import SF_SMALL

SALES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("sale_date", T.DateType()),
    ]
)
CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)
D1, D2 = dt.date(2024, 1, 15), dt.date(2024, 2, 3)


def test_bronze_sales_casts_and_renames(spark):
    landing = spark.createDataFrame([(1, 7, "12.50", "Laptop", "2024-01-01")], LANDING_SALES)
    row = transforms.bronze_sales(landing).collect()[0]
    assert row.asDict() == {"id": 1, "customer_id": 7, "product": "Laptop", "price": 12.5,
                            "sale_date": dt.date(2024, 1, 1)}


@pytest.mark.parametrize("price,date", [("12,5", "2024-01-01"), ("1.0", "2024-13-45"), ("abc", "x")])
def test_bronze_strict_cast_fails_the_batch(spark, price, date):
    landing = spark.createDataFrame([(1, 7, price, "Laptop", date)], LANDING_SALES)
    with pytest.raises(Exception):
        transforms.bronze_sales(landing).collect()


def test_bronze_customers(spark):
    landing = spark.createDataFrame([(5, "n", "e@x.io", "c", "sp", "2024-01-01")],
                                    "id long, name string, email string, city string, state string, created_at string")
    out = transforms.bronze_customers(landing)
    assert out.columns == ["customer_id", "name", "email", "city", "state"]


def test_silver_sales_filter_and_discount(spark):
    rows = [(1, 1, "a", 10.0, D1), (2, 1, "a", None, D1), (3, 1, "a", 0.0, D1), (4, 1, "a", -5.0, D1),
            (5, 1, "a", float("nan"), D1)]
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = transforms.silver_sales(spark.createDataFrame(rows, SALES), processed_at=at).collect()
    ids = sorted(r["id"] for r in out)
    assert ids == [1, 5]  # NULL, 0 and negatives dropped; NaN > 0 holds as in SQL engines
    one = next(r for r in out if r["id"] == 1)
    assert one["price_with_discount"] == 10.0 * 0.9
    assert one["silver_processed_at"] == dt.datetime(2024, 1, 1)


def test_silver_filter_reaches_parquet_scan(spark, tmp_path):
    spark.createDataFrame([(1, 1, "a", 10.0, D1)], SALES).write.parquet(str(tmp_path / "b"))
    plan = transforms.silver_sales(spark.read.parquet(str(tmp_path / "b")))._jdf.queryExecution().executedPlan()
    assert "GreaterThan(price,0" in plan.toString()


def test_silver_customers_upper(spark):
    df = spark.createDataFrame([(1, "n", "e", "c", "sp"), (2, "n", "e", "c", None)], CUSTOMERS)
    assert [r["uf"] for r in transforms.silver_customers(df).orderBy("customer_id").collect()] == ["SP", None]


def _gold_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (str(t[0]), t[1]))


def silver_fixtures(spark):
    sales = spark.createDataFrame(
        [
            (1, 10, "a", 100.0, D1),
            (2, 10, "a", 50.0, D2),
            (3, 11, "a", 30.0, D1),
            (None, 12, "a", 20.0, D1),  # NULL id: counted in revenue, not in orders
            (5, None, "a", 7.0, D1),  # NULL customer: NULL region
            (6, 99, "a", 3.0, D1),  # unknown customer: NULL region
            (7, 13, "a", 1.01, D1),
            (8, 13, "a", 1.02, D1),  # mean 1.015: exact half-cent tie
        ],
        SALES,
    )
    customers = spark.createDataFrame(
        [
            (10, "A", "a@x.io", "c", "sp"),
            (11, "B", "b@x.io", "c", "rj"),
            (12, "C", "c@x.io", "c", "rj"),
            (12, "C2", "c@x.io", "c", "mg"),  # duplicate id: fan-out into two regions
            (13, "D", "d@x.io", "c", "pr"),
            (None, "E", "e@x.io", "c", "rs"),  # NULL key never matches
        ],
        CUSTOMERS,
    )
    return transforms.silver_sales(sales), transforms.silver_customers(customers)


def test_enrich_left_join_semantics(spark):
    s, c = silver_fixtures(spark)
    out = marts.enrich_sales(s, c)
    assert out.count() == 9  # 8 sales, one duplicated by the duplicate customer
    regions = {(r["id"], r["region"]) for r in out.collect()}
    assert (5, None) in regions and (6, None) in regions
    assert {r["sale_month"] for r in out.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}


def test_sales_summary_values(spark):
    s, c = silver_fixtures(spark)
    got = {(r["region"], r["sale_month"]): r.asDict() for r in marts.sales_summary(s, c).collect()}
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert got[("SP", jan)]["total_revenue"] == 100.0 and got[("SP", feb)]["total_orders"] == 1
    assert got[("RJ", jan)]["total_revenue"] == 50.0 and got[("RJ", jan)]["total_orders"] == 1
    assert got[("MG", jan)]["total_orders"] == 0 and got[("MG", jan)]["avg_ticket"] == 20.0
    assert got[(None, jan)]["total_revenue"] == 10.0 and got[(None, jan)]["total_orders"] == 2
    assert got[("PR", jan)]["avg_ticket"] == 1.01  # the double 1.015 lies below the tie
    ordered = [r["total_revenue"] for r in marts.sales_summary(s, c).collect()]
    assert ordered == sorted(ordered, reverse=True)


@pytest.mark.parametrize("strategy", ["broadcast", "pre_aggregate", "auto"])
def test_mart_strategies_equal_join_then_aggregate(spark, strategy):
    s, c = silver_fixtures(spark)
    assert _gold_rows(marts.sales_summary(s, c, strategy)) == _gold_rows(marts.sales_summary_direct(s, c))


@pytest.mark.parametrize("strategy", ["broadcast", "pre_aggregate"])
def test_mart_equals_brute_force_on_tables(spark, strategy):
    from strata.plans.queries import _silver_customers_with_orphans, _silver_sales

    s, c = _silver_sales(spark, SF_SMALL), _silver_customers_with_orphans(spark, SF_SMALL)
    fast = {(r[0], r[1]): r for r in marts.sales_summary(s, c, strategy).collect()}
    slow = {(r[0], r[1]): r for r in marts.sales_summary_direct(s, c).collect()}
    assert fast.keys() == slow.keys()
    for k in fast:
        assert fast[k]["total_orders"] == slow[k]["total_orders"]
        assert fast[k]["avg_ticket"] == slow[k]["avg_ticket"]
        assert math.isclose(fast[k]["total_revenue"], slow[k]["total_revenue"], rel_tol=1e-12)


def test_mart_plan_aggregates_before_a_shuffle_join(spark):
    s, c = silver_fixtures(spark)
    plan = marts.sales_summary(s, c, "pre_aggregate")._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join LeftOuter")
    assert plan.count("Aggregate") >= 2
    assert plan.rindex("Aggregate") > join_at  # an aggregate sits below the join


def test_mart_broadcasts_only_a_small_customers_side(spark, tmp_path):
    s, c = silver_fixtures(spark)
    c.write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    assert marts.fits_broadcast(c)
    plan = marts.sales_summary(s, c)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    # well-compressed rows: small files, but too many rows to broadcast
    many = spark.range(300_000).selectExpr("id AS customer_id", "'n' AS name", "'SP' AS uf")
    many.write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert not marts.fits_broadcast(many)
    assert "BroadcastHashJoin" not in marts.sales_summary(s, many)._jdf.queryExecution().executedPlan().toString()


def test_kpis_mean_of_means(spark):
    gold = spark.createDataFrame([("A", D1, 10.0, 1, 10.0), ("B", D1, 90.0, 9, 10.0), ("C", D1, 1.0, 1, 1.0)],
                                 "region string, sale_month date, total_revenue double, total_orders long, avg_ticket double")
    k = marts.dashboard_kpis(gold).collect()[0]
    assert (k["total_revenue"], k["total_orders"], k["avg_ticket"]) == (101.0, 11, 7.0)
    by_region = {r["region"]: r["total_orders"] for r in marts.orders_by_region(gold).collect()}
    assert by_region == {"A": 1, "B": 9, "C": 1}


@pytest.mark.parametrize("x", [1.015, 2.675, 0.125, -0.125, -1.015, 1.005, 290312.395, 12345.675, 0.0, 1e300, 3.14159])
def test_round_half_away_matches_reference_engine(spark, x):
    ours = spark.range(1).select(round_half_away(F.lit(x), 2).alias("r")).collect()[0]["r"]
    ref = duckdb.sql(f"SELECT round({x!r}::DOUBLE, 2)").fetchall()[0][0]
    assert ours == ref


def test_round_half_away_nulls_and_nan(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(round_half_away("x").alias("r")).collect()
    assert rows[0]["r"] is None and math.isnan(rows[1]["r"])


def test_enrich_spreads_null_keys_over_partitions(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(i, None if i % 3 else 10, "a", 5.0, D1) for i in range(3000)]
        sales = transforms.silver_sales(spark.createDataFrame(rows, SALES))
        customers = transforms.silver_customers(spark.createDataFrame([(10, "A", "e", "c", "sp")], CUSTOMERS))
        out = marts.enrich_sales(sales, customers)
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        per_part = out.rdd.glom().map(len).collect()
        assert sum(per_part) == 3000 and max(per_part) < 2000  # NULL keys are not in one task
        assert out.where("region IS NULL").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_mart_does_not_emit_pairs_for_copied_customers(spark):
    """A customer id copied many times: the mart scales sums by the copy
    count instead of joining every copy with every sale."""
    sales = transforms.silver_sales(spark.createDataFrame([(i, 7, "a", 2.5, D1) for i in range(50)], SALES))
    copies = transforms.silver_customers(spark.createDataFrame([(7, "n", "e", "c", "sp")] * 400, CUSTOMERS))
    for strategy in ("broadcast", "pre_aggregate"):
        df = marts.sales_summary(sales, copies, strategy)
        row = df.collect()[0]
        assert (row["total_orders"], row["total_revenue"], row["avg_ticket"]) == (20000, 50000.0, 2.5)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "copies" in plan
    assert marts.enrich_sales(sales, copies).count() == 20000  # the row-level join is the pairs


def test_hot_customer_key_is_split_by_adaptive_execution(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = [(i, 7 if i % 3 else (i % 50) + 100, "a", 5.0, D1) for i in range(30000)]  # customer 7: 2/3 of sales
        sales = transforms.silver_sales(spark.createDataFrame(rows, SALES))
        customers = transforms.silver_customers(
            spark.createDataFrame([(c, "n", "e", "c", "sp") for c in [7, *range(100, 150)]], CUSTOMERS))
        out = marts.enrich_sales(sales, customers)
        assert len(out.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
