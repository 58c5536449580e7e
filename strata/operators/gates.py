"""Quality gates: evaluate a suite over a DataFrame in one aggregation.

``evaluate_suite`` returns the result table (one row per expectation); it is
lazy for suites that single rows decide, and measures the others first. ``check_suite`` runs it and returns a ``GateResult``: only
that small table (one row per expectation) reaches the driver. Any error
while evaluating (missing column, unreadable batch, bad cast) is a failed
gate carrying the error text, never a passed one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expectations import (
    BETWEEN,
    BE_NULL,
    IN_SET,
    LENGTHS_BETWEEN,
    MATCH_REGEX,
    MEASURED,
    NOT_IN_SET,
    NOT_MATCH_REGEX,
    Suite,
    _field,
    _unexpected,
    metric_columns,
    result_rows,
    results_from_metrics,
    row_condition,
)
from strata.functions.measures import MEASURED_SCHEMA, Tables, complete, first_pass


@dataclass(frozen=True)
class GateResult:
    suite: str
    success: bool
    results: tuple[Mapping[str, object], ...] = field(default_factory=tuple)
    error: str | None = None
    values: tuple[Mapping[str, object], ...] = field(default_factory=tuple)

    @property
    def failed(self) -> tuple[Mapping[str, object], ...]:
        return tuple(r for r in self.results if not r.get("success"))


def has_measures(suite: Suite) -> bool:
    """Whether the suite holds expectations that single rows cannot decide."""
    return any(e.type in MEASURED for e in suite.expectations)


def suite_columns(suite: Suite, schema: T.StructType) -> list[Column]:
    """All aggregates of the suite's common pass, for ``agg`` or ``observe``."""
    return metric_columns(suite, schema) + first_pass(suite, schema)


def rows_found(df: DataFrame | None, suite: Suite, metrics: Mapping[str, object], tables: Tables | None = None) -> list[dict[str, object]]:
    """Result rows, in the suite's order, from the metrics of the common pass;
    what these leave open is measured on ``df``."""
    counted = iter(result_rows(suite, metrics))
    measured = complete(df, suite, metrics, tables) if has_measures(suite) else {}
    return [measured[i] if i in measured else next(counted) for i in range(len(suite.expectations))]


def evaluate_suite(df: DataFrame, suite: Suite, tables: Tables | None = None) -> DataFrame:
    """Result table of ``suite`` over ``df``: one pass over a pruned scan for
    all counts and sketches. Lazy, unless measured expectations need more; the
    result then carries ``observed_values``, too. ``tables`` resolves names of
    other tables (others are looked up in the session's catalog)."""
    columns = suite_columns(suite, df.schema)
    if not has_measures(suite):
        return results_from_metrics(df.agg(*columns), suite)
    rows = rows_found(df, suite, df.agg(*columns).first().asDict(), tables)
    values = [tuple(row.get(f.name) for f in MEASURED_SCHEMA.fields) for row in rows]
    return df.sparkSession.createDataFrame(values, MEASURED_SCHEMA)


# Expectations whose unexpected values can be listed.
_LISTED = (BE_NULL, MATCH_REGEX, NOT_MATCH_REGEX, BETWEEN, IN_SET, NOT_IN_SET, LENGTHS_BETWEEN)
TOP_VALUES = 20
VALUES_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType(), True),
        T.StructField("expectation", T.StringType(), True),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("value_rank", T.IntegerType(), True),
        T.StructField("unexpected_value", T.StringType(), True),
        T.StructField("value_count", T.LongType(), True),
    ]
)


def unexpected_values(df: DataFrame, suite: Suite, top: int = TOP_VALUES) -> DataFrame:
    """The most frequent unexpected values of every expectation about values,
    with exact counts (ties by value): one scan for the whole suite. Rows
    without an unexpected value leave the plan at the scan, equal values are
    counted in the tasks that read them, and ranks are cut before the shuffle."""
    faults = []
    for i, e in enumerate(suite.expectations):
        if e.type not in _LISTED:
            continue
        c, dtype = F.col(f"`{e.column}`"), _field(df.schema, e.column).dataType
        bad = _unexpected(e, c, dtype)
        chosen = row_condition(e)
        fault = F.struct(F.lit(i).alias("i"), c.cast("string").alias("unexpected_value"))
        faults.append(F.when(bad if chosen is None else chosen & bad, fault))
    if not faults:
        return df.sparkSession.createDataFrame([], VALUES_SCHEMA)
    found = df.select(F.inline(F.array_compact(F.array(*faults))))
    counts = found.groupBy("i", "unexpected_value").agg(F.count(F.lit(1)).alias("value_count"))
    order = Window.partitionBy("i").orderBy(F.desc("value_count"), "unexpected_value")
    ranked = counts.withColumn("value_rank", F.row_number().over(order)).where(F.col("value_rank") <= top)
    pick = lambda names: F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), F.col("i") + 1)
    return ranked.select(
        F.lit(suite.name).alias("suite"),
        pick([e.type for e in suite.expectations]).alias("expectation"),
        pick([e.label for e in suite.expectations]).alias("column_name"),
        "value_rank", "unexpected_value", "value_count",
    )


def _verdict(suite: Suite, rows: list) -> GateResult:
    results = tuple(r.asDict() for r in rows)
    return GateResult(suite.name, all(bool(r["success"]) for r in results), results)


def root_cause(err: BaseException) -> str:
    """The message that says why: the innermost ``Caused by`` of a JVM error,
    else the first line."""
    lines = str(err).strip().splitlines()
    causes = [x.strip()[len("Caused by:") :].strip() for x in lines if x.strip().startswith("Caused by:")]
    return causes[-1] if causes else lines[0] if lines else type(err).__name__


def technical_failure(suite: Suite, err: BaseException) -> GateResult:
    return GateResult(suite.name, False, (), f"Technical validation failure: {root_cause(err)}")


def check_suite(df: DataFrame, suite: Suite, tables: Tables | None = None) -> GateResult:
    """Run the suite; an empty suite passes without touching the data."""
    if not suite:
        return GateResult(suite.name, True)
    try:
        return _verdict(suite, evaluate_suite(df, suite, tables).collect())
    except Exception as err:  # any failure to evaluate fails the gate
        return technical_failure(suite, err)


def verdict_from_metrics(
    suite: Suite, metrics: Mapping[str, object], df: DataFrame | None = None, tables: Tables | None = None
) -> GateResult:
    """Gate verdict from metrics already gathered (e.g. by ``observe``);
    ``df`` is read for what a measured expectation still needs."""
    if not suite:
        return GateResult(suite.name, True)
    try:
        results = tuple(rows_found(df, suite, metrics, tables))
    except Exception as err:  # any failure to evaluate fails the gate
        return technical_failure(suite, err)
    return GateResult(suite.name, all(bool(r["success"]) for r in results), results)
