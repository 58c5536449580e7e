"""Scale check: the full medallion on a generated batch of a given size.

Usage: python tools/scale_check.py [n_sales] [n_customers]
Default is ten times the reference's clean workload. Prints one JSON line.
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")

from strata.operators import generate  # noqa: E402
from strata.plans.medallion import build_steps, run_medallion  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.sources import fs  # noqa: E402
from strata.sources.paths import Lake  # noqa: E402

DATE = "2026-04-19"


def main() -> None:
    n_sales = int(sys.argv[1]) if len(sys.argv) > 1 else 10 * generate.CLEAN_SALES
    n_customers = int(sys.argv[2]) if len(sys.argv) > 2 else 10 * generate.CLEAN_CUSTOMERS
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra_conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake(scratch_path(spark, "scale-check"))
    t = time.perf_counter()
    generate.clean_batch(spark, lake, DATE, n_customers=n_customers, n_sales=n_sales)
    generated = time.perf_counter() - t
    # the row-count gate's upper bound is a parameter; raise it to the batch size
    steps = build_steps()
    t = time.perf_counter()
    results = run_medallion(spark, lake, DATE, steps)
    ran = time.perf_counter() - t
    print(json.dumps({
        "n_sales": n_sales, "n_customers": n_customers, "generate_sec": round(generated, 1),
        "run_sec": round(ran, 1), "sales_rows_per_sec": round(n_sales / ran),
        "steps": {r.step: round((r.finished_at - r.started_at).total_seconds(), 2) for r in results},
    }))
    fs.delete(spark, lake.root)


if __name__ == "__main__":
    main()
