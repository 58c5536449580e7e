"""End-to-end outcomes: the expected gate results for each kind of batch."""

import pytest
from pyspark.sql import functions as F

from strata.operators import generate, transforms
from strata.plans import medallion
from strata.plans.medallion import read_gold, read_silver, run_medallion
from strata.plans.steps import Endpoint, GateFailed, Step, read_gate_results, read_run_log, run_step
from strata.sources import fs
from strata.sources.io import read_table
from strata.functions.expectations import between

DATE = "2026-04-19"


def run(spark, step, lake, date=DATE):
    return run_step(spark, step, date, lake)


def test_gate_results_are_logged(spark, lake):
    generate.dirty_batch(spark, lake, DATE, n_customers=100, n_sales=500)
    with pytest.raises(GateFailed):
        run(spark, medallion.SALES_BRONZE, lake)
    rows = {(r["suite"], r["column_name"]): r for r in read_gate_results(spark, lake).collect()}
    assert rows[("check_stg_sales_bronze_target", "id")]["unexpected_count"] == 51
    assert rows[("check_stg_sales_bronze_source", "customer_id")]["success"] is True
    run_row = read_run_log(spark, lake).collect()[0]
    assert run_row["status"] == "target_fail" and run_row["rows_in"] == 500 and run_row["started_at"] is not None


def test_clean_batch_reaches_gold(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=200, n_sales=2000)
    results = run_medallion(spark, lake, DATE)
    assert [r.status for r in results] == ["success"] * 5
    assert results[-1].gate_status == "skipped"
    gold = read_gold(spark, lake, DATE)
    assert gold.count() <= 5
    assert gold.agg(F.sum("total_orders")).collect()[0][0] == 2000
    runs = read_run_log(spark, lake)
    assert runs.where("status = 'success'").count() == 5
    assert not fs.exists(spark, lake.quarantine_root)


def test_dirty_sales_fail_bronze_target(spark, lake):
    generate.dirty_batch(spark, lake, DATE, n_customers=100, n_sales=500)
    with pytest.raises(GateFailed) as err:
        run(spark, medallion.SALES_BRONZE, lake)
    res = err.value.result
    assert res.status == "target_fail" and res.rows_in == 500
    assert res.quarantine_path.endswith(f"dt={DATE}/reason=target_fail_stg_sales_bronze")
    assert [g.success for g in res.gates] == [True, False]
    assert res.gates[1].results[0]["unexpected_count"] == generate.DIRTY_NULL_SALE_IDS
    # nothing published, the batch is in quarantine with its dt and reason
    assert not fs.exists(spark, lake.paths(DATE)["sales_bronze"])
    q = read_table(spark, lake.quarantine_root, execution_date=DATE)
    assert q.count() == 500 and q.where("id IS NULL").count() == 51
    assert {r["reason"] for r in q.select("reason").distinct().collect()} == {"target_fail_stg_sales_bronze"}


def test_dirty_customers_fail_bronze_source(spark, lake):
    generate.dirty_batch(spark, lake, DATE, n_customers=100, n_sales=500)
    with pytest.raises(GateFailed) as err:
        run(spark, medallion.CUSTOMERS_BRONZE, lake)
    res = err.value.result
    assert res.status == "source_fail"
    assert res.gates[0].results[0]["unexpected_count"] == generate.DIRTY_NULL_CUSTOMER_IDS
    assert not fs.exists(spark, lake.paths(DATE)["customers_bronze"])
    q = spark.read.parquet(res.quarantine_path)
    assert q.columns[:2] == ["raw_line", "source_file"]  # the whole landing batch, line by line
    assert not fs.exists(spark, lake.table("bronze", "customers_crm") + "/_staging/" + res.run_id)


def test_corrupt_landing(spark, lake):
    generate.corrupt_landing(spark, lake, DATE)
    with pytest.raises(GateFailed) as sales:
        run(spark, medallion.SALES_BRONZE, lake)
    assert sales.value.result.gates[1].results[0]["unexpected_count"] == 10
    with pytest.raises(GateFailed) as customers:
        run(spark, medallion.CUSTOMERS_BRONZE, lake)
    assert customers.value.result.status == "target_fail"
    assert customers.value.result.gates[1].results[0]["unexpected_count"] == 50


def test_corrupt_bronze_flows_through_silver(spark, lake):
    generate.corrupt_bronze(spark, lake, DATE)
    sales = run(spark, medallion.SALES_SILVER, lake)
    assert (sales.status, sales.rows_in, sales.rows_out) == ("success", 50, 0)  # all prices negative
    customers = run(spark, medallion.CUSTOMERS_SILVER, lake)
    assert customers.status == "success"
    silver_sales, silver_customers = read_silver(spark, lake, DATE)
    assert silver_sales.count() == 0
    assert silver_customers.where("customer_id IS NULL").count() == 17
    gold = run(spark, medallion.SALES_SUMMARY_STEP, lake)
    assert gold.rows_out == 0 and read_gold(spark, lake, DATE).count() == 0


def test_corrupt_silver_fails_the_price_bound(spark, lake):
    generate.corrupt_silver(spark, lake, DATE)
    silver, _ = read_silver(spark, lake, DATE)
    from strata.operators.gates import check_suite
    from strata.functions.expectations import Suite
    gate = check_suite(silver, Suite("check_sales_silver_target", (between("price", 0, 10000),)))
    assert not gate.success and gate.results[0]["unexpected_count"] == 10


def test_failed_silver_target_is_not_published(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=50, n_sales=300)
    run(spark, medallion.SALES_BRONZE, lake)
    tight = Step(**{**medallion.SALES_SILVER.__dict__, "target_expectations": (between("price", 0, 100),)})
    with pytest.raises(GateFailed) as err:
        run(spark, tight, lake)
    assert err.value.result.status == "target_fail"
    silver, _ = read_silver(spark, lake, DATE)
    assert silver.count() == 0  # no published version
    assert spark.read.parquet(err.value.result.quarantine_path).count() == 300


def test_rerun_is_idempotent_and_other_dates_untouched(spark, lake):
    generate.clean_batch(spark, lake, "2026-04-18", n_customers=50, n_sales=300)
    generate.clean_batch(spark, lake, DATE, n_customers=50, n_sales=400)
    run_medallion(spark, lake, "2026-04-18")
    run_medallion(spark, lake, DATE)
    run_medallion(spark, lake, DATE)
    versions = spark.sparkContext._jvm.java.io.File(lake.paths(DATE)["sales_silver"] + "/versions").list()
    assert len(versions) == 2  # live version and the one before it
    bronze = read_table(spark, lake.table("bronze", "sales_erp"))
    counts = {str(r["dt"]): r["count"] for r in bronze.groupBy("dt").count().collect()}
    assert counts == {"2026-04-18": 300, DATE: 400}
    gold = read_table(spark, lake.table("gold", "sales_summary"))
    assert gold.groupBy("dt").agg(F.sum("total_orders").alias("n")).orderBy("dt").collect()[1]["n"] == 400


def test_rerun_with_empty_batch_replaces_the_partition(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=50, n_sales=300)
    run(spark, medallion.SALES_BRONZE, lake)
    run(spark, medallion.SALES_SILVER, lake)
    refunds = Step(**{**medallion.SALES_SILVER.__dict__,
                      "transform": lambda df: transforms.silver_sales(df.withColumn("price", -F.col("price")))})
    res = run(spark, refunds, lake)
    assert res.rows_out == 0
    silver, _ = read_silver(spark, lake, DATE)
    assert silver.count() == 0


def test_sql_text_transform_and_unreadable_source(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=20, n_sales=50)
    sql_step = Step(**{**medallion.SALES_BRONZE.__dict__,
                       "transform": "SELECT id, customer_id, product, CAST(price AS DOUBLE) AS price, "
                                    "CAST(date AS DATE) AS sale_date FROM source_data WHERE id > 10"})
    assert run(spark, sql_step, lake).rows_out == 40
    missing = Step(**{**medallion.SALES_BRONZE.__dict__,
                      "source": Endpoint("{{ root }}/landing/nothing/dt={{ execution_date }}", "csv",
                                         medallion.SALES_BRONZE.source.schema)})
    with pytest.raises(GateFailed) as err:
        run(spark, missing, lake)
    assert err.value.result.status == "source_fail"
    assert "Technical validation failure" in err.value.result.error


def test_bad_text_in_landing_fails_the_batch(spark, lake):
    path = lake.paths(DATE)["sales_landing"]
    fs.mkdirs(spark, path)
    with open(path.replace("file:", "") + "/part-0.csv", "w") as f:
        f.write("id,customer_id,price,product,date\n1,5,12.5,Laptop,2024-01-01\n2,6,oops,Laptop,2024-01-01\n")
    with pytest.raises(Exception) as err:
        run(spark, medallion.SALES_BRONZE, lake)
    assert not isinstance(err.value, GateFailed)  # the source gate passed; the strict cast failed
    assert not fs.exists(spark, lake.paths(DATE)["sales_bronze"])
    runs = read_run_log(spark, lake).collect()
    assert runs[0]["status"] == "failed" and "oops" in runs[0]["error"]


def test_ingest_with_lineage(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=20, n_sales=60)
    sales_step, customers_step = medallion.ingest_steps()
    res = run(spark, sales_step, lake)
    assert res.rows_out == 60
    out = spark.read.parquet(res.target_path)
    assert out.columns[-3:] == ["_ingested_at", "_domain", "_source_file"]
    names = {r["_source_file"] for r in out.select("_source_file").distinct().collect()}
    assert all(n.startswith("part-") and n.endswith(".csv") for n in names)
    assert out.where("_domain = 'sales'").count() == 60
    run(spark, customers_step, lake)
    assert fs.exists(spark, lake.table("bronze", "customers_crm_ingest"))


def test_dashboard_reads_the_mart(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=50, n_sales=500)
    run_medallion(spark, lake, DATE)
    view = medallion.dashboard(spark, lake, DATE)
    assert view["kpis"].collect()[0]["total_orders"] == 500
    assert view["revenue_by_region"].count() == view["preview"].select("region").distinct().count()
    empty = medallion.dashboard(spark, lake, "2000-01-01")
    assert empty["preview"].count() == 0 and empty["kpis"].collect()[0]["total_orders"] is None


def test_source_gate_of_a_shuffling_step_is_measured_on_its_own(spark, lake):
    from strata.functions.expectations import not_null, row_count_between

    generate.clean_batch(spark, lake, DATE, n_customers=30, n_sales=300)
    per_customer = Step(
        name="sales_by_customer",
        group="silver",
        source=medallion.SALES_BRONZE.source,
        target=Endpoint("{{ root }}/{{ group }}/sales_by_customer/dt={{ execution_date }}", "parquet"),
        transform=lambda df: df.groupBy("customer_id").agg(F.count("id").alias("n")),
        source_expectations=(row_count_between(1, 1000), not_null("customer_id")),
        target_expectations=(not_null("customer_id"),),
    )
    res = run(spark, per_customer, lake)
    assert res.status == "success" and res.rows_in == 300
    assert [g.suite for g in res.gates] == ["check_sales_by_customer_source", "check_sales_by_customer_target"]
    assert spark.read.parquet(res.target_path).agg(F.sum("n")).collect()[0][0] == 300
    tight = Step(**{**per_customer.__dict__, "source_expectations": (row_count_between(1, 10),)})
    with pytest.raises(GateFailed) as err:
        run(spark, tight, lake)
    assert err.value.result.status == "source_fail"


def test_transform_that_ignores_its_source_does_not_hang(spark, lake):
    from strata.functions.expectations import not_null

    generate.clean_batch(spark, lake, DATE, n_customers=10, n_sales=20)
    constant = Step(
        name="constant",
        group="silver",
        source=medallion.SALES_BRONZE.source,
        target=Endpoint("{{ root }}/{{ group }}/constant/dt={{ execution_date }}", "parquet"),
        transform=lambda df: df.sparkSession.range(3).withColumnRenamed("id", "x"),
        source_expectations=(not_null("customer_id"),),
    )
    res = run(spark, constant, lake)
    assert (res.status, res.rows_in, res.rows_out) == ("success", 20, 3)


def test_float_printed_ids_reach_the_target_gate(spark, lake):
    """Landing ids printed as floats with NULLs (a float-typed writer):
    read exactly, so the bronze target gate sees 51 NULL ids."""
    path = lake.paths(DATE)["sales_landing"]
    fs.mkdirs(spark, path)
    lines = ["id,customer_id,price,product,date"]
    lines += [f"{'' if i <= 51 else f'{i}.0'},{1000 + i % 7},{10 + i}.25,Laptop,{DATE}" for i in range(1, 201)]
    with open(path.replace("file:", "") + "/part-0.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    with pytest.raises(GateFailed) as err:
        run(spark, medallion.SALES_BRONZE, lake)
    res = err.value.result
    assert res.status == "target_fail" and res.rows_in == 200
    assert res.gates[1].results[0]["unexpected_count"] == 51


def test_sql_transform_with_bound_parameters(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=20, n_sales=100)
    step = Step(**{**medallion.SALES_BRONZE.__dict__,
                   "transform": "SELECT id, customer_id, product, CAST(price AS DOUBLE) AS price, "
                                "CAST(date AS DATE) AS sale_date FROM {source_data} "
                                "WHERE id <= :last_id AND product <> :skip",
                   "transform_args": {"last_id": 60, "skip": "none"}})
    assert run(spark, step, lake).rows_out == 60


def test_logs_of_a_new_lake_are_empty(spark, lake):
    assert read_run_log(spark, lake).count() == 0
    assert read_gate_results(spark, lake).count() == 0


def test_silver_step_keeps_filter_pushdown_under_its_gate(spark, lake):
    from pyspark.sql import Observation

    from strata.functions.expectations import metric_columns
    from strata.plans.steps import apply_transform

    generate.clean_batch(spark, lake, DATE, n_customers=10, n_sales=50)
    run(spark, medallion.SALES_BRONZE, lake)
    step = medallion.SALES_SILVER
    src = spark.read.parquet(lake.paths(DATE)["sales_bronze"])
    out = apply_transform(spark, step.transform, {"source_data": src})
    plan = out.observe(Observation("t"), *metric_columns(step.target_suite, out.schema)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price,0" in plan and "CollectMetrics" in plan and "Exchange" not in plan


def test_failed_domain_does_not_stop_the_other(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=30, n_sales=200)
    dirty = lake.paths("2000-01-01")  # write dirty customers over the date's landing
    generate.dirty_batch(spark, lake, "2000-01-01", n_customers=30, n_sales=10)
    fs.delete(spark, lake.paths(DATE)["customers_landing"])
    fs.rename(spark, dirty["customers_landing"], lake.paths(DATE)["customers_landing"])
    with pytest.raises(GateFailed) as err:
        run_medallion(spark, lake, DATE)
    status = {r.step: r.status for r in err.value.results}
    assert status == {
        "stg_customers_bronze": "source_fail",
        "customers_silver": "skipped_upstream",
        "stg_sales_bronze": "success",
        "sales_silver": "success",
        "sales_summary": "skipped_upstream",
    }
    assert read_run_log(spark, lake).where("status = 'skipped_upstream'").count() == 2
    assert not fs.exists(spark, lake.paths(DATE)["sales_summary"])


def test_corrupt_silver_reaches_gold_because_gold_has_no_gate(spark, lake):
    generate.clean_batch(spark, lake, DATE, n_customers=20, n_sales=100)
    run_medallion(spark, lake, DATE)
    generate.corrupt_silver(spark, lake, DATE)
    res = run(spark, medallion.SALES_SUMMARY_STEP, lake)
    assert (res.status, res.gate_status) == ("success", "skipped")
    gold = read_gold(spark, lake, DATE).collect()
    # customer 1 is not a generated customer (ids start at 1001): NULL region
    corrupt = [r for r in gold if r["sale_month"].isoformat() == "2026-04-01" and r["region"] is None]
    assert corrupt and corrupt[0]["total_orders"] == 10
    assert corrupt[0]["avg_ticket"] == generate.SILVER_SALES_PRICE


def test_source_quarantine_with_explicit_csv_options(spark, lake):
    generate.dirty_batch(spark, lake, DATE, n_customers=20, n_sales=80)
    step = Step(**{**medallion.SALES_BRONZE.__dict__,
                   "source": Endpoint("{{ root }}/landing/sales_erp/dt={{ execution_date }}", "csv",
                                      medallion.SALES_BRONZE.source.schema, {"header": "true", "sep": ","}),
                   "source_expectations": (medallion.not_null("id"),)})
    with pytest.raises(GateFailed) as err:
        run(spark, step, lake)
    assert err.value.result.status == "source_fail"
    kept = spark.read.parquet(err.value.result.quarantine_path)
    files = kept.select("source_file").distinct().count()
    assert kept.count() == 80 + files  # every line, each file's header included


def test_latest_gate_results_per_suite(spark, lake):
    from strata.plans.steps import latest_gate_results

    generate.dirty_batch(spark, lake, DATE, n_customers=20, n_sales=100)
    with pytest.raises(GateFailed):
        run(spark, medallion.SALES_BRONZE, lake)
    generate.clean_batch(spark, lake, DATE, n_customers=20, n_sales=100)
    run(spark, medallion.SALES_BRONZE, lake)
    assert read_gate_results(spark, lake).count() == 6  # two runs, three expectations each
    latest = latest_gate_results(spark, lake, DATE).collect()
    assert len(latest) == 3 and all(r["success"] and r["status"] == "success" for r in latest)


def test_text_target_failing_its_gate_is_quarantined_as_parquet(spark, lake):
    from strata.functions.expectations import between

    generate.clean_batch(spark, lake, DATE, n_customers=10, n_sales=40)
    step = Step(**{**medallion.SALES_BRONZE.__dict__,
                   "target": Endpoint("{{ root }}/export/sales/dt={{ execution_date }}", "csv"),
                   "target_expectations": (between("price", 0, 1),)})
    with pytest.raises(GateFailed) as err:
        run(spark, step, lake)
    res = err.value.result
    assert res.status == "target_fail" and not fs.exists(spark, res.target_path)
    assert spark.read.parquet(res.quarantine_path).count() == 40
    assert not fs.exists(spark, lake.root + "/export/sales/_staging/" + res.run_id)


def test_failed_publish_is_recorded(spark, lake, monkeypatch):
    from strata.plans import steps as steps_module

    generate.clean_batch(spark, lake, DATE, n_customers=10, n_sales=30)

    def refuse(*_args, **_kwargs):
        raise OSError("rename refused")

    monkeypatch.setattr(steps_module.fs, "rename", refuse)
    with pytest.raises(OSError):
        run(spark, medallion.SALES_BRONZE, lake)
    row = read_run_log(spark, lake).collect()[0]
    assert row["status"] == "failed" and row["error"].startswith("publish failed: rename refused")
