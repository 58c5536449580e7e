"""Write PLANS.md: physical plans of the headline queries at a given scale.

Usage: python tools/explain_plans.py [sf_dir]
Each plan is the formatted physical plan Spark would run (before adaptive
re-planning), followed by a short note on what to look for.
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, ".")

from pyspark.sql import Observation  # noqa: E402

from strata.functions.expectations import metric_columns  # noqa: E402
from strata.operators import marts  # noqa: E402
from strata.plans import medallion  # noqa: E402
from strata.plans import queries as Q  # noqa: E402
from strata.plans.steps import apply_transform  # noqa: E402
from strata.session import build_session  # noqa: E402

NOTES = {
    "gold_sales_summary (customers broadcast)": "customers side under the broadcast threshold: customer rows "
    "are counted per (customer_id, region) (a small shuffle of the dimension) and broadcast; sales are joined "
    "where they are read (no shuffle of sales), then one small shuffle of partial (region, month) groups. "
    "`price > 0` in PushedFilters, ReadSchema has the 4 used columns of orders.",
    "gold_sales_summary (customers over the threshold)": "same mart with broadcasting disabled: partial "
    "aggregation per (customer_id, month) before the first exchange, so the shuffle join moves partial "
    "sums, not sales; a hot customer or the NULL key collapses map-side.",
    "gold_enriched_sales (no broadcast)": "row-level join: both sides hash-partitioned on (customer_id, _salt); "
    "sales with a NULL customer_id get a spread salt, so they do not pile into one task.",
    "stg_sales_bronze write (one pass)": "CSV read by header name, strict casts, source and target gates as "
    "CollectMetrics on the same pass as the write; no exchange.",
    "gate_suite": "five expectations in one aggregate: one partial and one final HashAggregate, no join, no union.",
    "sales_silver write (one pass)": "the target gate's CollectMetrics sits above the filter, so `price > 0` "
    "is still in PushedFilters of the bronze scan; no exchange.",
}


def _bronze_write_plan(spark, sf):
    step = medallion.SALES_BRONZE
    lake = Q._landing_lake(spark, sf)
    src = Q.read_batch(spark, lake.paths(Q.BATCH_DATE)["sales_landing"], "csv", step.source.schema)
    observed = src.observe(Observation("source"), *metric_columns(step.source_suite, src.schema))
    out = apply_transform(spark, step.transform, {"source_data": observed})
    return out.observe(Observation("target"), *metric_columns(step.target_suite, out.schema))


def _silver_write_plan(spark, sf):
    step = medallion.SALES_SILVER
    lake = Q._landing_lake(spark, sf)
    bronze = Q.transforms.bronze_sales(Q.read_batch(spark, lake.paths(Q.BATCH_DATE)["sales_landing"], "csv",
                                                    medallion.SALES_BRONZE.source.schema))
    Q.write_batch(bronze, lake.paths(Q.BATCH_DATE)["sales_bronze"], "parquet")
    src = Q.read_batch(spark, lake.paths(Q.BATCH_DATE)["sales_bronze"], "parquet")
    out = apply_transform(spark, step.transform, {"source_data": src})
    return out.observe(Observation("target"), *metric_columns(step.target_suite, out.schema))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    def formatted(df) -> str:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()

    plans = {}
    plans["gold_sales_summary (customers broadcast)"] = formatted(Q.gold(spark, sf))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans["gold_sales_summary (customers over the threshold)"] = formatted(
        marts.sales_summary(Q._silver_sales(spark, sf), Q._silver_customers_with_orphans(spark, sf))
    )
    plans["gold_enriched_sales (no broadcast)"] = formatted(Q.QUERIES["gold_enriched_sales"](spark, sf))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plans["stg_sales_bronze write (one pass)"] = formatted(_bronze_write_plan(spark, sf))
    plans["sales_silver write (one pass)"] = formatted(_silver_write_plan(spark, sf))
    plans["gate_suite"] = formatted(Q.QUERIES["gate_suite"](spark, sf))
    out = ["# Physical plans", "", f"Generated by `tools/explain_plans.py` over `{sf}`.", ""]
    for title, text in plans.items():
        out += [f"## {title}", "", NOTES[title], "", "```", text.strip(), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
