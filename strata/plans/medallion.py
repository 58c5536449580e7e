"""The sales / customers medallion: four gated steps and the gold mart.

    landing CSV/JSON ─▶ bronze Parquet ─▶ silver snapshot ─▶ gold Parquet
                     gate            gate              (no gate: skipped)

Paths are templates under ``{{ root }}``; each batch is one ``dt=`` folder.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expectations import Suite, between, match_regex, not_null, row_count_between
from strata.operators import marts, transforms
from strata.operators.ingest import with_lineage
from strata.plans.steps import Endpoint, GateFailed, Step, StepResult, run_step, write_run_log
from strata.sources.io import read_or_empty
from strata.sources.paths import Lake
from strata.sources.schemas import (
    LANDING_CUSTOMERS,
    LANDING_SALES,
    SALES_SUMMARY,
    SILVER_CUSTOMERS,
    SILVER_SALES,
)

# Gate parameters of the four steps. The upper row bound holds
# only where a caller asks for it (``max_sales_rows``).
MAX_SALES_BATCH_ROWS = 2_000_000
EMAIL_PATTERN = r"[^@]+@[^@]+\.[^@]+"
PRICE_BOUNDS = (0, 10_000)

def build_steps(
    max_sales_rows: int | None = None,
    email_pattern: str = EMAIL_PATTERN,
    price_bounds: tuple[float, float] = PRICE_BOUNDS,
) -> tuple[Step, ...]:
    """The five steps, with the gate parameters given."""
    sales_bronze = Step(
        name="stg_sales_bronze",
        group="bronze",
        source=Endpoint("{{ root }}/landing/sales_erp/dt={{ execution_date }}", "csv", LANDING_SALES),
        target=Endpoint("{{ root }}/{{ group }}/sales_erp/dt={{ execution_date }}", "parquet"),
        transform=transforms.bronze_sales,
        source_expectations=(row_count_between(1, max_sales_rows), not_null("customer_id")),
        target_expectations=(not_null("id"),),
    )
    sales_silver = Step(
        name="sales_silver",
        group="silver",
        source=Endpoint("{{ root }}/bronze/sales_erp/dt={{ execution_date }}", "parquet"),
        target=Endpoint("{{ root }}/{{ group }}/sales/dt={{ execution_date }}", "delta"),
        transform=transforms.silver_sales,
        target_expectations=(between("price", *price_bounds),),
        depends_on=("stg_sales_bronze",),
    )
    customers_bronze = Step(
        name="stg_customers_bronze",
        group="bronze",
        source=Endpoint("{{ root }}/landing/customers_crm/dt={{ execution_date }}", "json", LANDING_CUSTOMERS),
        target=Endpoint("{{ root }}/{{ group }}/customers_crm/dt={{ execution_date }}", "parquet"),
        transform=transforms.bronze_customers,
        source_expectations=(not_null("id"),),
        target_expectations=(match_regex("email", email_pattern),),
    )
    customers_silver = Step(
        name="customers_silver",
        group="silver",
        source=Endpoint("{{ root }}/bronze/customers_crm/dt={{ execution_date }}", "parquet"),
        target=Endpoint("{{ root }}/{{ group }}/customers/dt={{ execution_date }}", "delta"),
        transform=transforms.silver_customers,
        target_expectations=(not_null("email"),),
        depends_on=("stg_customers_bronze",),
    )
    sales_summary = Step(
        name="sales_summary",
        group="gold",
        source={
            "silver_sales": Endpoint("{{ root }}/silver/sales/dt={{ execution_date }}", "delta"),
            "silver_customers": Endpoint("{{ root }}/silver/customers/dt={{ execution_date }}", "delta"),
        },
        target=Endpoint("{{ root }}/{{ group }}/sales_summary/dt={{ execution_date }}", "parquet"),
        transform=marts.sales_summary,
        depends_on=("sales_silver", "customers_silver"),
    )
    return customers_bronze, customers_silver, sales_bronze, sales_silver, sales_summary


CUSTOMERS_BRONZE, CUSTOMERS_SILVER, SALES_BRONZE, SALES_SILVER, SALES_SUMMARY_STEP = build_steps()
LAYER_STEPS: tuple[Step, ...] = (CUSTOMERS_BRONZE, CUSTOMERS_SILVER, SALES_BRONZE, SALES_SILVER)
ALL_STEPS: tuple[Step, ...] = LAYER_STEPS + (SALES_SUMMARY_STEP,)


def _ingest_transform(domain: str):
    def transform(df: DataFrame) -> DataFrame:
        renamed = df.withColumnRenamed("_source_file", "__file")
        return with_lineage(renamed, domain, source_file=F.col("__file")).drop("__file")

    return transform


def ingest_steps() -> tuple[Step, Step]:
    """Direct ingestion: each landing batch copied as-is to Parquet with
    ``_ingested_at``, ``_domain`` and ``_source_file``. The target is its own
    table (``<domain>_ingest``) so it never collides with the gated bronze."""
    sales = Step(
        name="sales_ingest",
        group="bronze",
        source=Endpoint("{{ root }}/landing/sales_erp/dt={{ execution_date }}", "csv", LANDING_SALES,
                        file_name_column="_source_file"),
        target=Endpoint("{{ root }}/{{ group }}/sales_erp_ingest/dt={{ execution_date }}", "parquet"),
        transform=_ingest_transform("sales"),
    )
    customers = Step(
        name="customers_ingest",
        group="bronze",
        source=Endpoint("{{ root }}/landing/customers_crm/dt={{ execution_date }}", "json", LANDING_CUSTOMERS,
                        file_name_column="_source_file"),
        target=Endpoint("{{ root }}/{{ group }}/customers_crm_ingest/dt={{ execution_date }}", "parquet"),
        transform=_ingest_transform("customers"),
    )
    return sales, customers


def ordered(steps: Sequence[Step]) -> list[Step]:
    """Steps in dependency order (declared order breaks ties)."""
    done: set[str] = set()
    names = {s.name for s in steps}
    out: list[Step] = []
    pending = list(steps)
    while pending:
        ready = [s for s in pending if all(d in done or d not in names for d in s.depends_on)]
        if not ready:
            raise ValueError(f"dependency cycle among {[s.name for s in pending]}")
        for s in ready:
            out.append(s)
            done.add(s.name)
            pending.remove(s)
    return out


def run_medallion(
    spark: SparkSession,
    lake: Lake,
    execution_date: str,
    steps: Sequence[Step] = ALL_STEPS,
    run_id: str | None = None,
    stop_on_failure: bool = False,
) -> list[StepResult]:
    """Run the steps for one date in dependency order.

    A failed step (gate or error) does not stop steps that do not depend on
    it; steps downstream of it are recorded as ``skipped_upstream``. After
    the run the first failure is raised, with every step's result attached
    as ``.results``. ``stop_on_failure`` stops at the first failure instead.
    """
    results: list[StepResult] = []
    broken: set[str] = set()
    first: BaseException | None = None
    for step in ordered(steps):
        if any(dep in broken for dep in step.depends_on):
            skipped = StepResult(
                run_id=run_id or f"{execution_date}-{uuid.uuid4().hex[:10]}",
                step=step.name,
                execution_date=execution_date,
                status="skipped_upstream",
                error="upstream step failed: " + ", ".join(d for d in step.depends_on if d in broken),
            )
            skipped.started_at = skipped.finished_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            write_run_log(spark, lake, skipped)
            results.append(skipped)
            broken.add(step.name)
            continue
        try:
            results.append(run_step(spark, step, execution_date, lake, run_id=run_id))
        except GateFailed as failed:
            results.append(failed.result)
            broken.add(step.name)
            first = first or failed
        except Exception as err:
            text = str(err).strip().splitlines()[0] if str(err).strip() else type(err).__name__
            results.append(getattr(err, "step_result", None) or StepResult(run_id=run_id or "", step=step.name, execution_date=execution_date,
                                      status="failed", error=text))
            broken.add(step.name)
            first = first or err
        if first is not None and stop_on_failure:
            break
    if first is not None:
        try:
            first.results = results
        except AttributeError:
            pass
        raise first
    return results


def read_gold(spark: SparkSession, lake: Lake, execution_date: str) -> DataFrame:
    """The published mart of one date; empty (typed) when none exists."""
    return read_or_empty(spark, lake.paths(execution_date)["sales_summary"], SALES_SUMMARY)


def read_silver(spark: SparkSession, lake: Lake, execution_date: str) -> tuple[DataFrame, DataFrame]:
    paths = lake.paths(execution_date)
    return (
        read_or_empty(spark, paths["sales_silver"], SILVER_SALES, "delta"),
        read_or_empty(spark, paths["customers_silver"], SILVER_CUSTOMERS, "delta"),
    )


def dashboard(spark: SparkSession, lake: Lake, execution_date: str) -> dict[str, DataFrame]:
    """The BI view of one date's mart: headline KPIs, revenue and orders by
    region, and the mart itself. A missing mart gives empty frames."""
    gold = read_gold(spark, lake, execution_date)
    return {
        "kpis": marts.dashboard_kpis(gold),
        "revenue_by_region": marts.revenue_by_region(gold),
        "orders_by_region": marts.orders_by_region(gold),
        "preview": gold,
    }


def suites(steps: Sequence[Step] = ALL_STEPS) -> dict[str, Suite]:
    """Every non-empty suite of the steps, by name (``check_<step>_<side>``)."""
    out: dict[str, Suite] = {}
    for step in steps:
        for suite in (step.source_suite, step.target_suite):
            if suite:
                out[suite.name] = suite
    return out


def export_suites(directory: str, steps: Sequence[Step] = ALL_STEPS) -> list[str]:
    """Write each suite as ``<name>.json`` (the saved-suite shape)."""
    import os

    os.makedirs(directory, exist_ok=True)
    paths = []
    for name, suite in sorted(suites(steps).items()):
        path = os.path.join(directory, f"{name}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(suite.to_json() + "\n")
        paths.append(path)
    return paths


def load_suites(directory: str, strict: bool = True) -> dict[str, Suite]:
    """Read every ``*.json`` suite of a folder."""
    import glob
    import os

    loaded = {}
    for path in sorted(glob.glob(os.path.join(directory, "*.json"))):
        with open(path, encoding="utf-8") as f:
            suite = Suite.from_json(f.read(), strict=strict)
        loaded[suite.name] = suite
    return loaded

