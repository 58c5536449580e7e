"""Benchmark: headline queries and the full medallion run, one JSON line out.

Environment:
  BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] (default 8)
  BENCH_CLEAN    1 (default) to also time the clean workload at the
                 reference's sizes: 1,000,000 sales, 100,000 customers

Row-level queries are timed with the ``noop`` sink (the whole plan runs,
nothing is collected); one-row results are collected. Query times exclude
session start; a warm-up run of the flagship query comes first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators import generate  # noqa: E402
from strata.plans import queries as Q  # noqa: E402
from strata.plans.medallion import build_steps, run_medallion  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.sources import fs  # noqa: E402
from strata.sources.io import write_batch  # noqa: E402
from strata.sources.paths import Lake  # noqa: E402
from strata.sources.testdata import landing_customers, landing_sales  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
CLEAN = os.environ.get("BENCH_CLEAN", "1") == "1"
DATE = "2026-04-19"

# Row-level outputs: run through the noop sink.
ROW_QUERIES = [
    "bronze_sales",
    "silver_sales",
    "gold_enriched_sales",
    "fault_landing_sales",
]
# Small results (aggregates, gate tables): collected.
SMALL_QUERIES = [
    "gold_sales_summary",
    "dashboard_kpis",
    "revenue_by_region",
    "gate_suite",
    "gate_between",
    "gen_sales",
]
# Queries that write and read back through the sinks (row-level results
# go to the noop sink, one-row results are collected).
SINK_QUERIES = {"quarantine_batch": "noop", "run_metrics": "collect", "partition_overwrite": "noop"}


def _sf_value(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


ERRORS: dict[str, str] = {}


def _timed(fn, name: str = "") -> float | None:
    """Seconds taken by ``fn``; a failure is recorded, not raised, so the
    JSON line is always printed."""
    t0 = time.perf_counter()
    try:
        fn()
    except Exception as err:  # noqa: BLE001
        ERRORS[name or getattr(fn, "__name__", "?")] = str(err).strip().splitlines()[0][:300] if str(err) else type(err).__name__
        return None
    return round(time.perf_counter() - t0, 3)


def _step_seconds(results) -> dict[str, float]:
    return {r.step: round((r.finished_at - r.started_at).total_seconds(), 3) for r in results}


def _noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        app_name="strata-bench",
        shuffle_partitions=max(8, 2 * CPUS),
        extra_conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    extra: dict[str, float | int] = {}

    _timed(lambda: Q.gold(spark, SF_DIR).collect(), "warm_up")  # JVM, codegen, file listing

    for key in ROW_QUERIES:
        times[key] = _timed(lambda k=key: _noop(Q.QUERIES[k](spark, SF_DIR)), key)
    for key in SMALL_QUERIES:
        times[key] = _timed(lambda k=key: Q.QUERIES[k](spark, SF_DIR).collect(), key)
    for key, sink in SINK_QUERIES.items():
        if sink == "noop":
            times[key] = _timed(lambda k=key: _noop(Q.QUERIES[k](spark, SF_DIR)), key)
        else:
            times[key] = _timed(lambda k=key: Q.QUERIES[k](spark, SF_DIR).collect(), key)

    # Full medallion over landing files derived from the tables:
    # orders -> sales CSV, customer -> customers JSON, then every gated step.
    lake = Lake(scratch_path(spark, "bench-lake"))
    paths = lake.paths(DATE)
    sales_landing = landing_sales(spark, SF_DIR).withColumn("date", F.col("date").cast("date").cast("string"))
    times["landing_write"] = _timed(
        lambda: (
            write_batch(sales_landing, paths["sales_landing"], "csv"),
            write_batch(landing_customers(spark, SF_DIR), paths["customers_landing"], "json"),
        ),
        "landing_write",
    )
    # order totals stay under one million: the silver price gate uses that domain
    steps = build_steps(price_bounds=Q.ORDER_PRICE_BOUNDS)
    results = []
    times["medallion_run"] = _timed(lambda: results.extend(run_medallion(spark, lake, DATE, steps)), "medallion_run")
    if times["medallion_run"] is not None:
        sales_rows = next(r.rows_in for r in results if r.step == "stg_sales_bronze")
        extra["medallion_sales_rows"] = int(sales_rows)
        extra["medallion_rows_per_sec"] = round(sales_rows / max(times["medallion_run"], 1e-9))
        extra["medallion_steps"] = _step_seconds(results)

    if CLEAN:
        clean = Lake(scratch_path(spark, "bench-clean"))
        times["clean_generate"] = _timed(lambda: generate.clean_batch(spark, clean, DATE), "clean_generate")
        clean_results = []
        times["clean_medallion_run"] = _timed(
            lambda: clean_results.extend(run_medallion(spark, clean, DATE)), "clean_medallion_run"
        )
        if times["clean_medallion_run"] is not None:
            extra["clean_sales_rows"] = generate.CLEAN_SALES
            extra["clean_rows_per_sec"] = round(generate.CLEAN_SALES / max(times["clean_medallion_run"], 1e-9))
            extra["clean_steps"] = _step_seconds(clean_results)

    # the bench's own lakes are not needed after timing
    _timed(lambda: fs.delete(spark, lake.root), "cleanup")
    if CLEAN:
        _timed(lambda: fs.delete(spark, clean.root), "cleanup")

    total = round(sum(v for v in times.values() if v is not None), 3)
    if ERRORS:
        extra["errors"] = ERRORS
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": _sf_value(SF_DIR),
                "cpus": CPUS,
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
