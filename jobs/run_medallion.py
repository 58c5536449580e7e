"""Command-line jobs over one lake and one execution date.

    python -m jobs.run_medallion --root <lake> --date 2026-04-19 generate clean
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 run
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 run --steps stg_sales_bronze sales_silver
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 corrupt landing
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 ingest
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 dashboard
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 report
    python -m jobs.run_medallion --root <lake> --date 2026-04-19 suites --out suites/

The date is required: every batch is addressed by it. ``run`` runs every
step whose upstream succeeded, prints one line per step and exits with
status 2 when a gate failed; failed batches are then in quarantine.
On a cluster, submit with ``spark-submit`` and leave ``--master`` out.
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.operators import generate
from strata.plans import medallion
from strata.plans.steps import GateFailed, latest_gate_results, run_step
from strata.session import build_session
from strata.sources.paths import Lake


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="run_medallion", description=__doc__.split("\n\n")[0])
    p.add_argument("--root", required=True, help="lake root (any Hadoop file system URI)")
    p.add_argument("--date", required=True, help="execution date, YYYY-MM-DD")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)
    g = sub.add_parser("generate", help="write synthetic landing batches")
    g.add_argument("kind", choices=["clean", "dirty"])
    g.add_argument("--customers", type=int, default=None)
    g.add_argument("--sales", type=int, default=None)
    g.add_argument("--seed", type=int, default=42)
    c = sub.add_parser("corrupt", help="replace a layer's batch with corrupt rows")
    c.add_argument("layer", choices=["landing", "bronze", "silver"])
    r = sub.add_parser("run", help="run the gated steps and the gold mart")
    r.add_argument("--max-sales-rows", type=int, default=None, help="upper bound of the sales row-count gate (default: none)")
    r.add_argument("--steps", nargs="*", default=None, help="step names (default: all)")
    sub.add_parser("ingest", help="copy landing batches to Parquet with lineage columns")
    sub.add_parser("dashboard", help="print the KPIs of the date's mart")
    sub.add_parser("report", help="print the latest result of every gate for the date")
    x = sub.add_parser("suites", help="write the steps' expectation suites as JSON files")
    x.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.job == "suites":
        for path in medallion.export_suites(args.out):
            print(path)
        return 0
    spark = build_session(args.master, app_name=f"strata-{args.job}")
    lake = Lake(args.root)
    if args.job == "generate":
        if args.kind == "clean":
            generate.clean_batch(spark, lake, args.date, args.customers or generate.CLEAN_CUSTOMERS,
                                 args.sales or generate.CLEAN_SALES, args.seed)
        else:
            generate.dirty_batch(spark, lake, args.date, args.customers or generate.DIRTY_CUSTOMERS,
                                 args.sales or generate.DIRTY_SALES, args.seed)
        return 0
    if args.job == "corrupt":
        {"landing": generate.corrupt_landing, "bronze": generate.corrupt_bronze,
         "silver": generate.corrupt_silver}[args.layer](spark, lake, args.date)
        return 0
    if args.job == "run":
        steps = medallion.build_steps(max_sales_rows=args.max_sales_rows)
        if args.steps:
            steps = tuple(s for s in steps if s.name in set(args.steps))
        code = 0
        try:
            results = medallion.run_medallion(spark, lake, args.date, steps)
        except GateFailed as failed:
            results, code = getattr(failed, "results", [failed.result]), 2
        for r in results:
            print(json.dumps({"step": r.step, "status": r.status, "gates": r.gate_status, "rows_in": r.rows_in,
                              "rows_out": r.rows_out, "target": r.target_path,
                              "quarantine_path": r.quarantine_path, "error": r.error}))
        return code
    if args.job == "ingest":
        for step in medallion.ingest_steps():
            r = run_step(spark, step, args.date, lake)
            print(json.dumps({"step": r.step, "status": r.status, "rows_out": r.rows_out}))
        return 0
    if args.job == "report":
        rows = latest_gate_results(spark, lake, args.date).orderBy("suite", "expectation", "column_name")
        for row in rows.collect():  # one row per expectation of each suite
            print(json.dumps(row.asDict(), default=str))
        return 0
    view = medallion.dashboard(spark, lake, args.date)
    print(json.dumps(view["kpis"].collect()[0].asDict()))
    for row in view["revenue_by_region"].orderBy("region").collect():
        print(json.dumps(row.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
