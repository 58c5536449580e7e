"""Declarative pipeline steps and the step runner.

A ``Step`` names a source (one endpoint, or several by name), a target, a
transform (SQL text or a DataFrame function) and two expectation suites.
``run_step`` executes it as one Spark job over the source:

    read ─ observe(source suite, rows_in) ─ transform ─ observe(target
    suite, rows_out) ─ write to a staging folder

Both suites are measured by ``observe`` on the same pass that writes the
data, so the source is scanned once. Observed metrics of the write's final
stage are counted once per partition even when tasks are retried. A
transform that shuffles would put the source observation in a map stage,
which a lost executor can re-run; such steps measure the source suite in
its own aggregate first. Then, on the driver, only the metric rows are
inspected:

* source gate failed: the staging folder is dropped, the source batch is
  copied to ``quarantine/dt=<date>/reason=source_fail_<step>/`` and
  ``GateFailed`` is raised — nothing is published;
* target gate failed: the staged output is moved to
  ``quarantine/.../reason=target_fail_<step>/``, ``GateFailed`` is raised;
* both passed: the staged output replaces the target (directory swap for
  file formats, pointer swap for snapshot tables).

Readers therefore never see a batch that failed a gate, and a rerun of the
same date replaces the old batch entirely, even with zero rows.

Expectations that need more than the observed metrics (uniqueness, order,
quantiles, other tables) are completed on the source frame and on the staged
output, before anything is published; a suite may name the step's other
sources, or catalog tables, as other tables. When a gate fails, the most
frequent unexpected values are recorded with the run.

When the write itself fails (a bad cast, an unreadable landing file) and
the step has a source suite, that suite is evaluated on its own so a bad
batch is still reported and quarantined as a source failure.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expectations import ROWS, Expectation, Suite, metric_columns
from strata.operators.gates import (
    VALUES_SCHEMA,
    GateResult,
    check_suite,
    has_measures,
    root_cause,
    suite_columns,
    technical_failure,
    unexpected_values,
    verdict_from_metrics,
)
from strata.sources import fs, snapshot
from strata.sources.io import read_batch, table_format, write_batch
from strata.sources.paths import Lake, check_date, render_path
from strata.sources.schemas import GATE_RESULTS, RUN_LOG

log = logging.getLogger("strata.steps")

Transform = str | Callable[..., DataFrame] | None


@dataclass(frozen=True)
class Endpoint:
    path: str
    format: str
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    file_name_column: str | None = None


@dataclass(frozen=True)
class Step:
    name: str
    group: str
    source: Endpoint | Mapping[str, Endpoint]
    target: Endpoint
    transform: Transform = None
    source_expectations: tuple[Expectation, ...] = ()
    target_expectations: tuple[Expectation, ...] = ()
    depends_on: tuple[str, ...] = ()
    transform_args: Mapping[str, object] = field(default_factory=dict)

    @property
    def source_suite(self) -> Suite:
        return Suite(f"check_{self.name}_source", tuple(self.source_expectations))

    @property
    def target_suite(self) -> Suite:
        return Suite(f"check_{self.name}_target", tuple(self.target_expectations))

    def sources(self) -> dict[str, Endpoint]:
        if isinstance(self.source, Endpoint):
            return {"source_data": self.source}
        return dict(self.source)


@dataclass
class StepResult:
    run_id: str
    step: str
    execution_date: str
    status: str = "running"
    gate_status: str = "skipped"
    rows_in: int | None = None
    rows_out: int | None = None
    target_path: str | None = None
    target_format: str | None = None
    quarantine_path: str | None = None
    error: str | None = None
    gates: list[GateResult] = field(default_factory=list)
    started_at: _dt.datetime | None = None
    finished_at: _dt.datetime | None = None


class GateFailed(RuntimeError):
    """A quality gate stopped the step; the batch is in quarantine."""

    def __init__(self, result: StepResult):
        self.result = result
        super().__init__(
            f"{result.step}: {result.status} on {result.execution_date}; "
            f"quarantined at {result.quarantine_path}; {result.error or ''}".strip()
        )


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def load_sql(spark: SparkSession, path: str) -> str:
    """The SQL text of a step from a file on any file system."""
    text = fs.read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return text


def apply_transform(
    spark: SparkSession,
    transform: Transform,
    frames: Mapping[str, DataFrame],
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run the step transform over the named source frames.

    SQL text may use ``{name}`` placeholders for the sources or the bare view name ``source_data`` for a single-source step; scalar
    values are bound as named parameters (``:name``) from ``args``.
    """
    if transform is None:
        if len(frames) != 1:
            raise ValueError("a step with several sources needs a transform")
        return next(iter(frames.values()))
    if callable(transform):
        if len(frames) == 1:
            return transform(next(iter(frames.values())))
        return transform(**frames)
    text = str(transform)
    params = dict(args) if args else None
    for name, df in frames.items():  # other braces, as in regular expressions, stay
        df.createOrReplaceTempView(name)
        text = text.replace("{" + name + "}", name)
    return spark.sql(text, args=params)


def _staging_path(target_path: str, fmt: str, run_id: str) -> str:
    if fmt == "snapshot":
        return snapshot.version_path(target_path, run_id)
    parent, _, leaf = target_path.rstrip("/").rpartition("/")
    return f"{parent}/_staging/{run_id}/{leaf}"


def _drop_staging(spark: SparkSession, staged: str, fmt: str) -> None:
    """Remove what is left of a run's staging folder."""
    fs.delete(spark, staged if fmt == "snapshot" else staged.rsplit("/", 1)[0])


def _publish(spark: SparkSession, staged: str, target_path: str, fmt: str, run_id: str) -> None:
    if fmt == "snapshot":
        snapshot.publish(spark, target_path, run_id)
        return
    if fmt == "delta":  # the table format replaces its contents and keeps its history
        write_batch(read_batch(spark, staged, fmt), target_path, fmt)
        _drop_staging(spark, staged, fmt)
        return
    # the old batch is set aside, never deleted before the new one is in place
    aside = f"{staged}.old"
    if fs.exists(spark, target_path):
        fs.rename(spark, target_path, aside)
    try:
        fs.rename(spark, staged, target_path)
    except Exception:
        if fs.exists(spark, aside) and not fs.exists(spark, target_path):
            fs.rename(spark, aside, target_path)
        raise
    _drop_staging(spark, staged, fmt)


def publish_batch(
    spark: SparkSession,
    df: DataFrame,
    target_path: str,
    fmt: str = "parquet",
    run_id: str | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Replace the batch at ``target_path`` with ``df``: write to staging,
    then swap in (a pointer swap for snapshot tables). Also replaces with
    an empty batch. Returns the rows written (observed on the write)."""
    fmt = table_format(spark, fmt)
    run_id = run_id or uuid.uuid4().hex[:12]
    staged = _staging_path(target_path, fmt, run_id)
    obs = Observation(f"publish_{run_id}")
    try:
        write_batch(df.observe(obs, F.count(F.lit(1)).alias(ROWS)), staged, fmt, options=options)
    except Exception:
        _drop_staging(spark, staged, fmt)
        raise
    _publish(spark, staged, target_path, fmt, run_id)
    return int(obs.get.get(ROWS) or 0)


def _read_for_quarantine(spark: SparkSession, path: str, endpoint: Endpoint) -> DataFrame:
    """Read a batch so that all of it can be copied: text formats line by
    line, as they are (``raw_line``), with the name of each line's file."""
    fmt = table_format(spark, endpoint.format)
    if fmt in ("csv", "json"):
        lines = spark.read.text(path)
        return lines.select(F.col("value").alias("raw_line"), F.col("_metadata.file_name").alias("source_file"))
    return read_batch(spark, path, fmt, endpoint.schema, endpoint.options)


def quarantine_batch(df: DataFrame, lake: Lake, execution_date: str, reason: str) -> str:
    """Copy a whole batch, as Parquet, to ``quarantine/dt=<date>/reason=<reason>/``."""
    path = lake.quarantine_path(execution_date, reason)
    write_batch(df, path, "parquet", mode="overwrite")
    return path


def _quarantine_staged(spark: SparkSession, staged: str, fmt: str, lake: Lake, date: str, reason: str) -> str:
    path = lake.quarantine_path(date, reason)
    if fmt in ("parquet", "snapshot"):
        fs.delete(spark, path)
        fs.rename(spark, staged, path)
    else:
        write_batch(read_batch(spark, staged, fmt), path, "parquet")
    _drop_staging(spark, staged, fmt)
    return path


RUN_LOG_SCHEMA = T.StructType(RUN_LOG.fields + [T.StructField("gate_status", T.StringType(), True)])


def _stamp(value: _dt.datetime | None) -> str | None:
    return value.isoformat(timespec="milliseconds") if value is not None else None


def write_run_log(spark: SparkSession, lake: Lake, result: StepResult) -> None:
    """Record the step run and its gate rows under the lake's ``_meta``.

    One small JSON-lines file per step run, written through the file
    system (no Spark job); ``read_run_log`` / ``read_gate_results`` read
    them back with declared schemas.
    """
    run = {
        "run_id": result.run_id,
        "step": result.step,
        "execution_date": result.execution_date,
        "status": result.status,
        "rows_in": result.rows_in,
        "rows_out": result.rows_out,
        "target_path": result.target_path,
        "target_format": result.target_format,
        "quarantine_path": result.quarantine_path,
        "error": result.error,
        "started_at": _stamp(result.started_at),
        "finished_at": _stamp(result.finished_at),
        "gate_status": result.gate_status,
    }
    leaf = f"{result.run_id}-{result.step}.json"
    fs.write_text(spark, f"{lake.meta_root}/run_log/{leaf}", json.dumps(run))
    keys = {"run_id": result.run_id, "step": result.step, "execution_date": result.execution_date}
    gate_rows = [{**keys, **r} for g in result.gates for r in g.results]
    gate_rows += [{**keys, "suite": g.suite, "success": False} for g in result.gates if g.error]
    if gate_rows:
        text = "\n".join(json.dumps(r) for r in gate_rows)
        fs.write_text(spark, f"{lake.meta_root}/gate_results/{leaf}", text)
    values = [{**keys, **v} for g in result.gates for v in g.values]
    if values:
        fs.write_text(spark, f"{lake.meta_root}/gate_values/{leaf}", "\n".join(json.dumps(v) for v in values))


GATE_VALUES = T.StructType(GATE_RESULTS.fields[:3] + VALUES_SCHEMA.fields)


def with_values(gate: GateResult, df: DataFrame, suite: Suite) -> GateResult:
    """A failed gate with its most frequent unexpected values; the verdict
    stands without them if they cannot be read."""
    failed = {(r["expectation"], r["column_name"]) for r in gate.failed}
    if gate.success or not failed:
        return gate
    wrong = tuple(e for e in suite.expectations if (e.type, e.label) in failed)
    try:
        values = unexpected_values(df, replace(suite, expectations=wrong)).collect()  # a fixed number per expectation
    except Exception as err:
        log.warning("no unexpected values for %s: %s", suite.name, root_cause(err))
        return gate
    return replace(gate, values=tuple(v.asDict() for v in sorted(values, key=lambda v: (v["expectation"], v["column_name"], v["value_rank"]))))


def _read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not fs.has_data(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_run_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every recorded step run of the lake (empty before the first run)."""
    return _read_log(spark, f"{lake.meta_root}/run_log", RUN_LOG_SCHEMA)


def read_gate_results(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every recorded expectation result of the lake."""
    return _read_log(spark, f"{lake.meta_root}/gate_results", GATE_RESULTS)


def read_gate_values(spark: SparkSession, lake: Lake) -> DataFrame:
    """The unexpected values recorded with every failed gate of the lake."""
    return _read_log(spark, f"{lake.meta_root}/gate_values", GATE_VALUES)


def latest_gate_results(spark: SparkSession, lake: Lake, execution_date: str | None = None) -> DataFrame:
    """The result rows of the most recent run of each suite (per date), with
    that run's status and finish time: the current report of every gate."""
    from pyspark.sql import Window

    runs = read_run_log(spark, lake).select("run_id", "step", "status", "finished_at")
    gates = read_gate_results(spark, lake)
    if execution_date is not None:
        gates = gates.where(F.col("execution_date") == F.lit(execution_date))
    rows = gates.join(runs, on=["run_id", "step"], how="left")
    latest = Window.partitionBy("suite", "execution_date").orderBy(
        F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()
    )
    return (
        rows.withColumn("_rank", F.dense_rank().over(latest))
        .where(F.col("_rank") == F.lit(1))
        .drop("_rank")
    )


def _physical_plan(df: DataFrame) -> str:
    """The physical plan as text (exchanges and observed-metric nodes)."""
    return str(df._jdf.queryExecution().executedPlan().toString())


def _count_rows(frames: Mapping[str, DataFrame]) -> int:
    return int(sum(df.count() for df in frames.values()))


def run_step(
    spark: SparkSession,
    step: Step,
    execution_date: str,
    lake: Lake,
    run_id: str | None = None,
    record: bool = True,
) -> StepResult:
    """Gate, transform, write and publish one step for one date.

    The step's Spark jobs carry the description ``strata <step> dt=<date>
    run=<run_id>`` (Spark UI, event log)."""
    check_date(execution_date)
    run_id = run_id or f"{execution_date}-{uuid.uuid4().hex[:10]}"
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"strata {step.name} dt={execution_date} run={run_id}")
    try:
        return _run_step(spark, step, execution_date, lake, run_id, record)
    finally:
        sc.setJobDescription(previous)


def _run_step(
    spark: SparkSession, step: Step, execution_date: str, lake: Lake, run_id: str, record: bool
) -> StepResult:
    result = StepResult(run_id=run_id, step=step.name, execution_date=execution_date, started_at=_now())
    ctx = {"root": lake.root, "name": step.name, "group": step.group}
    endpoints = step.sources()
    source_paths = {
        k: render_path(ep.path, execution_date, format=ep.format, **ctx) for k, ep in endpoints.items()
    }
    fmt = table_format(spark, step.target.format)
    target_path = render_path(step.target.path, execution_date, format=step.target.format, **ctx)
    result.target_path, result.target_format = target_path, fmt
    src_suite, tgt_suite = step.source_suite, step.target_suite
    primary = next(iter(endpoints))
    staged = _staging_path(target_path, fmt, run_id)

    def finish(status: str, error: str | None = None) -> StepResult:
        result.status, result.error, result.finished_at = status, error, _now()
        if result.gates:
            result.gate_status = "passed" if all(g.success for g in result.gates) else "failed"
        if record:
            try:
                write_run_log(spark, lake, result)
            except Exception as err:  # the log must never hide the step outcome
                log.error("run log not written for %s: %s", step.name, err)
        return result

    def fail_source(gate: GateResult) -> None:
        result.gates.append(with_values(gate, frames[primary], src_suite) if primary in frames else gate)
        _drop_staging(spark, staged, fmt)
        reason = f"source_fail_{step.name}"
        note = ""
        try:
            raw = _read_for_quarantine(spark, source_paths[primary], endpoints[primary])
            result.quarantine_path = quarantine_batch(raw, lake, execution_date, reason)
        except Exception as err:
            note = f"; quarantine failed: {_first_line(err)}"
        finish("source_fail", _describe(gate) + note)
        raise GateFailed(result)

    frames: dict[str, DataFrame] = {}
    try:
        for k, ep in endpoints.items():
            frames[k] = read_batch(spark, source_paths[k], ep.format, ep.schema, ep.options, ep.file_name_column)
    except Exception as err:
        if src_suite:
            fail_source(technical_failure(src_suite, err))
        err.step_result = finish("failed", _first_line(err))
        raise

    # rows_in: folded into the source observation when the source is gated
    # or is text; a metadata count for ungated columnar sources.
    src_cols = None
    obs_in = None
    if src_suite or table_format(spark, endpoints[primary].format) in ("csv", "json"):
        try:
            src_cols = suite_columns(src_suite, frames[primary].schema)
        except Exception as err:
            fail_source(technical_failure(src_suite, err))
        obs_in_name = f"in_{step.name}_{uuid.uuid4().hex[:8]}"
        obs_in = Observation(obs_in_name)
        observed = dict(frames)
        observed[primary] = frames[primary].observe(obs_in, *src_cols)
    else:
        observed = frames
        result.rows_in = _count_rows(frames)

    try:
        out = apply_transform(spark, step.transform, observed, step.transform_args)
        plan = _physical_plan(out) if obs_in is not None else ""
        if obs_in is not None and ("Exchange" in plan or obs_in_name not in plan):
            # The source observation would sit in a shuffle map stage, which
            # a lost executor can re-run (counting twice), or the transform
            # does not read the source at all (nothing would be observed):
            # measure the source in its own aggregate instead.
            obs_in = None
            if src_suite:
                gate_in = check_suite(frames[primary], src_suite, frames)
                unconditioned = [r for r, e in zip(gate_in.results, src_suite.expectations) if e.row_condition is None]
                result.rows_in = unconditioned[0]["element_count"] if unconditioned else None
                if not gate_in.success:
                    fail_source(gate_in)
                result.gates.append(gate_in)
            else:
                result.rows_in = _count_rows({primary: frames[primary]})
            out = apply_transform(spark, step.transform, frames, step.transform_args)
        gate_broken = None
        try:
            tgt_cols = suite_columns(tgt_suite, out.schema)
        except Exception as err:  # the gate can't be evaluated: it fails, the staged batch is quarantined
            gate_broken = technical_failure(tgt_suite, err)
            tgt_cols = metric_columns(Suite(tgt_suite.name, ()), out.schema)
    except GateFailed:
        raise
    except Exception as err:
        err.step_result = finish("failed", _first_line(err))
        raise
    obs_out = Observation(f"out_{step.name}_{uuid.uuid4().hex[:8]}")
    try:
        write_batch(out.observe(obs_out, *tgt_cols), staged, fmt, options=step.target.options)
    except Exception as err:
        _drop_staging(spark, staged, fmt)
        if src_suite:
            gate = check_suite(frames[primary], src_suite, frames)
            if not gate.success:
                fail_source(gate)
        err.step_result = finish("failed", _first_line(err))
        raise

    if obs_in is not None:
        metrics_in = obs_in.get
        result.rows_in = int(metrics_in.get(ROWS) or 0)
        gate_in = verdict_from_metrics(src_suite, metrics_in, frames[primary], frames)
        if src_suite:
            if not gate_in.success:
                fail_source(gate_in)
            result.gates.append(gate_in)

    metrics_out = obs_out.get
    result.rows_out = int(metrics_out.get(ROWS) or 0)
    if tgt_suite:
        written = None
        if gate_broken is None and (has_measures(tgt_suite) or not verdict_from_metrics(tgt_suite, metrics_out).success):
            written = read_batch(spark, staged, "parquet" if fmt == "snapshot" else fmt, out.schema)
        gate_out = gate_broken or verdict_from_metrics(tgt_suite, metrics_out, written, frames)
        if not gate_out.success and written is not None:
            gate_out = with_values(gate_out, written, tgt_suite)
        result.gates.append(gate_out)
        if not gate_out.success:
            reason = f"target_fail_{step.name}"
            note = ""
            try:
                result.quarantine_path = _quarantine_staged(spark, staged, fmt, lake, execution_date, reason)
            except Exception as err:
                note = f"; quarantine failed: {_first_line(err)}"
            finish("target_fail", _describe(gate_out) + note)
            raise GateFailed(result)

    try:
        _publish(spark, staged, target_path, fmt, run_id)
    except Exception as err:
        # the staged output is left in place, to be moved by hand; a rerun
        # writes its own
        err.step_result = finish("failed", f"publish failed: {_first_line(err)}; staged at {staged}")
        raise
    return finish("success")


def _first_line(err: BaseException) -> str:
    return root_cause(err)


def _describe(gate: GateResult) -> str:
    if gate.error:
        return gate.error
    parts = [
        f"{r['expectation']}({r['column_name'] or ''}): {r['unexpected_count'] if r['unexpected_count'] is not None else r['element_count']}"
        for r in gate.failed
    ]
    return f"{gate.suite} failed: " + "; ".join(parts)
