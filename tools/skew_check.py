"""Skew check: gold mart and enriched join on uniform vs skewed sales.

Usage: python tools/skew_check.py [n_sales] [n_customers]
Skewed sales put a third of the rows on NULL customer ids and a third on
one customer. Broadcasting is off so both plans shuffle. Prints one JSON
line of seconds per case.
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import marts, transforms  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.sources import fs  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    nc = int(sys.argv[2]) if len(sys.argv) > 2 else 1_000_000
    spark = build_session("local[8]", shuffle_partitions=64,
                          extra_conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    root = scratch_path(spark, "skew-check")
    base = spark.range(n).select(
        F.col("id"),
        (F.lit(10.0) + (F.col("id") % 997)).alias("price"),
        F.lit("2024-01-15").cast("date").alias("sale_date"),
        F.lit("p").alias("product"),
    )
    spread = F.pmod(F.xxhash64("id"), F.lit(nc))
    uniform = base.withColumn("customer_id", spread)
    skewed = base.withColumn(
        "customer_id",
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("long"))
        .when(F.col("id") % 3 == 1, F.lit(7).cast("long"))
        .otherwise(spread),
    )
    states = F.array(*[F.lit(s) for s in ("sp", "rj", "mg")])
    customers = spark.range(nc).select(
        F.col("id").alias("customer_id"), F.lit("n").alias("name"), F.lit("e").alias("email"),
        F.lit("c").alias("city"), F.element_at(states, (F.col("id") % 3 + 1).cast("int")).alias("state"),
    )
    uniform.write.parquet(f"{root}/uniform")
    skewed.write.parquet(f"{root}/skewed")
    customers.write.parquet(f"{root}/customers")
    c = transforms.silver_customers(spark.read.parquet(f"{root}/customers"))
    out = {}
    for label in ("uniform", "skewed"):
        s = transforms.silver_sales(spark.read.parquet(f"{root}/{label}"))
        marts.sales_summary(s, c, "pre_aggregate").collect()  # warm-up
        t = time.perf_counter()
        marts.sales_summary(s, c, "pre_aggregate").collect()
        out[f"gold_{label}"] = round(time.perf_counter() - t, 2)
        t = time.perf_counter()
        marts.enrich_sales(s, c).write.format("noop").mode("overwrite").save()
        out[f"enriched_{label}"] = round(time.perf_counter() - t, 2)
    print(json.dumps(out))
    fs.delete(spark, root)


if __name__ == "__main__":
    main()
