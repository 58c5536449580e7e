"""Data-quality expectations compiled to Spark aggregate expressions.

A suite is a value: a name and a tuple of expectations. ``metric_columns``
turns the whole suite into aggregate columns for **one** pass over the
data (``df.agg`` or ``df.observe``); ``results_from_metrics`` turns the one
row of counts into one result row per expectation. Column pruning keeps the
scan to the checked columns.

Missing values: NULL, and NaN in floating columns (the reference validated
on pandas, where both are missing). Not-null counts them as unexpected;
all other checks of values skip them.

A row condition limits an expectation to the rows that fulfil it; conditions
become filtered counts of the same pass. Expectations about more than single
rows (uniqueness, order, quantiles, distributions, other tables) have their
own aggregates and further steps in ``strata.functions.measures``.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import is_missing

NOT_NULL = "expect_column_values_to_not_be_null"
MATCH_REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
ROW_COUNT_BETWEEN = "expect_table_row_count_to_be_between"

BE_NULL = "expect_column_values_to_be_null"
NOT_MATCH_REGEX = "expect_column_values_to_not_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
NOT_IN_SET = "expect_column_values_to_not_be_in_set"
LENGTHS_BETWEEN = "expect_column_value_lengths_to_be_between"
ROW_COUNT_EQUAL = "expect_table_row_count_to_equal"
UNIQUE = "expect_column_values_to_be_unique"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"
INCREASING = "expect_column_values_to_be_increasing"
DECREASING = "expect_column_values_to_be_decreasing"
QUANTILES = "expect_column_quantile_values_to_be_between"
MEDIAN = "expect_column_median_to_be_between"
DISTINCT_IN_SET = "expect_column_distinct_values_to_be_in_set"
DISTINCT_CONTAIN_SET = "expect_column_distinct_values_to_contain_set"
DISTINCT_EQUAL_SET = "expect_column_distinct_values_to_equal_set"
UNIQUE_COUNT = "expect_column_unique_value_count_to_be_between"
UNIQUE_PROPORTION = "expect_column_proportion_of_unique_values_to_be_between"
DIVERGENCE = "expect_column_kl_divergence_to_be_less_than"
Z_SCORES = "expect_column_value_z_scores_to_be_less_than"
COLUMN_MIN = "expect_column_min_to_be_between"
COLUMN_MAX = "expect_column_max_to_be_between"
COLUMN_MEAN = "expect_column_mean_to_be_between"
COLUMN_SUM = "expect_column_sum_to_be_between"
COLUMN_STDEV = "expect_column_stdev_to_be_between"
SAME_ROW_COUNT = "expect_table_row_count_to_equal_other_table"
IN_OTHER_TABLE = "expect_column_values_to_be_in_other_table"

# Counted row by row in the common pass; the others are measured.
TABLE_COUNTS = frozenset({ROW_COUNT_BETWEEN, ROW_COUNT_EQUAL})
COUNTED = TABLE_COUNTS | {
    NOT_NULL, BE_NULL, MATCH_REGEX, NOT_MATCH_REGEX, BETWEEN, IN_SET, NOT_IN_SET, LENGTHS_BETWEEN,
}
MEASURED = frozenset({
    UNIQUE, COMPOUND_UNIQUE, INCREASING, DECREASING, QUANTILES, MEDIAN, DISTINCT_IN_SET, DISTINCT_CONTAIN_SET,
    DISTINCT_EQUAL_SET, UNIQUE_COUNT, UNIQUE_PROPORTION, DIVERGENCE, Z_SCORES, COLUMN_MIN, COLUMN_MAX, COLUMN_MEAN,
    COLUMN_SUM, COLUMN_STDEV, SAME_ROW_COUNT, IN_OTHER_TABLE,
})
TYPES = COUNTED | MEASURED
# Suite specs name an expectation by its type or by the quality library's
# class name, which is the type in camel case.
CLASS_TO_TYPE = {
    "".join(word.capitalize() for word in name.split("_")).replace("Kl", "KL"): name for name in sorted(TYPES)
} | {"ExpectColumnKlDivergenceToBeLessThan": DIVERGENCE}

_NEEDS = {
    "regex": (MATCH_REGEX, NOT_MATCH_REGEX),
    "value_set": (IN_SET, NOT_IN_SET, DISTINCT_IN_SET, DISTINCT_CONTAIN_SET, DISTINCT_EQUAL_SET),
    "columns": (COMPOUND_UNIQUE,),
    "order_by": (INCREASING, DECREASING),
    "quantile_ranges": (QUANTILES,),
    "partition_object": (DIVERGENCE,),
    "threshold": (DIVERGENCE, Z_SCORES),
    "value": (ROW_COUNT_EQUAL,),
    "other_table_name": (SAME_ROW_COUNT, IN_OTHER_TABLE),
}
_BOUNDED = (
    BETWEEN, ROW_COUNT_BETWEEN, LENGTHS_BETWEEN, MEDIAN, UNIQUE_COUNT, UNIQUE_PROPORTION, COLUMN_MIN, COLUMN_MAX,
    COLUMN_MEAN, COLUMN_SUM, COLUMN_STDEV,
)
_NO_COLUMN = TABLE_COUNTS | {COMPOUND_UNIQUE, SAME_ROW_COUNT}
# Which rows a compound key skips.
IGNORE_ROW_IF = ("all_values_are_missing", "any_value_is_missing", "never")
PARSERS = ("spark", "pandas", "great_expectations", "great_expectations__experimental__")


class UnknownExpectation(ValueError):
    pass


@dataclass(frozen=True)
class Expectation:
    """One expectation. Order gates need ``order_by``, the columns that order
    the rows (a Spark table has no order of its own). A ``row_condition``
    needs a ``condition_parser``: ``spark`` takes it as a Spark SQL condition,
    the others are the quality library's notations of simple conditions."""

    type: str
    column: str | None = None
    regex: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False
    mostly: float = 1.0
    meta: Mapping[str, object] = field(default_factory=dict, compare=False, hash=False)
    columns: tuple[str, ...] | None = None
    value: int | None = None
    value_set: tuple[object, ...] | None = None
    strictly: bool = False
    order_by: tuple[str, ...] | None = None
    quantile_ranges: tuple[tuple[float, object, object], ...] | None = None  # quantile, least, largest
    partition_object: tuple[str, tuple[object, ...], tuple[float, ...]] | None = None  # bins or values, these, weights
    threshold: float | None = None
    double_sided: bool = True
    tail_weight_holdout: float = 0.0
    internal_weight_holdout: float = 0.0
    ignore_row_if: str = "all_values_are_missing"
    other_table_name: str | None = None
    other_columns: tuple[str, ...] | None = None
    row_condition: str | None = None
    condition_parser: str | None = None

    def __post_init__(self) -> None:
        if self.type not in TYPES:
            raise UnknownExpectation(self.type)
        for name in ("columns", "value_set", "order_by", "other_columns"):
            given = getattr(self, name)
            if given is not None:
                given = (given,) if isinstance(given, str) else tuple(given)
                object.__setattr__(self, name, given)
        if isinstance(self.quantile_ranges, Mapping):
            given = self.quantile_ranges
            ranges = tuple((float(q), lo, hi) for q, (lo, hi) in zip(given["quantiles"], given["value_ranges"], strict=True))
            object.__setattr__(self, "quantile_ranges", ranges)
        if isinstance(self.partition_object, Mapping):
            kind = "bins" if "bins" in self.partition_object else "values"
            given = self.partition_object
            object.__setattr__(self, "partition_object", (kind, tuple(given[kind]), tuple(map(float, given["weights"]))))
        if self.type not in _NO_COLUMN and not self.column:
            raise TypeError(f"{self.type} needs a column")
        for name, types in _NEEDS.items():
            if self.type in types and getattr(self, name) is None:
                raise TypeError(f"{self.type} needs {'a regex' if name == 'regex' else name}")
        if self.type in _BOUNDED and self.min_value is None and self.max_value is None:
            raise TypeError(f"{self.type} needs a bound")
        if not 0.0 <= self.mostly <= 1.0:
            raise TypeError("mostly must lie in [0, 1]")
        if any(not 0.0 <= q <= 1.0 for q, _, _ in self.quantile_ranges or ()):
            raise TypeError("quantiles must lie in [0, 1]")
        if self.partition_object is not None:
            kind, at, weights = self.partition_object
            if len(at) != len(weights) + (kind == "bins") or not weights or min(weights) < 0 or sum(weights) <= 0:
                raise TypeError("a partition needs one weight, none negative, per value or per pair of bin edges")
            if kind == "bins" and any(a >= b for a, b in zip(at, at[1:])):
                raise TypeError("bin edges must increase")
        if self.ignore_row_if not in IGNORE_ROW_IF:
            raise TypeError(f"ignore_row_if must be one of {IGNORE_ROW_IF}")
        if self.row_condition is not None and self.condition_parser not in PARSERS:
            raise TypeError(f"a row_condition needs a condition_parser, one of {PARSERS}")

    @property
    def label(self) -> str | None:
        """The column or columns, as reported."""
        return self.column or (", ".join(self.columns) if self.columns else None)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(NOT_NULL, column=column, mostly=mostly)


def match_regex(column: str, regex: str, mostly: float = 1.0) -> Expectation:
    return Expectation(MATCH_REGEX, column=column, regex=regex, mostly=mostly)


def between(
    column: str,
    min_value: float | None = None,
    max_value: float | None = None,
    strict_min: bool = False,
    strict_max: bool = False,
    mostly: float = 1.0,
) -> Expectation:
    return Expectation(
        BETWEEN,
        column=column,
        min_value=min_value,
        max_value=max_value,
        strict_min=strict_min,
        strict_max=strict_max,
        mostly=mostly,
    )


def row_count_between(min_value: int | None = None, max_value: int | None = None) -> Expectation:
    return Expectation(ROW_COUNT_BETWEEN, min_value=min_value, max_value=max_value)


_KWARGS = {f.name for f in fields(Expectation)} - {"type", "meta"}
_DEFAULTS = {f.name: f.default for f in fields(Expectation)}
# Fixed value: the quality library's name of a compound key's columns.
_ALIASES = {"column_list": "columns"}
# Keyword arguments of the quality library that only shape
# reports; kept in ``meta``, never change a verdict.
REPORT_KWARGS = frozenset({"result_format", "catch_exceptions", "include_config", "description", "notes", "severity"})


def from_spec(spec: Mapping[str, object], strict: bool = True) -> Expectation | None:
    """``{"expectation": ClassName | type, "kwargs": {...}}`` or the saved
    form ``{"type": ..., "kwargs": {...}}``.

    An unknown name or bad keyword raises; with ``strict=False`` it warns
    and returns None, so the expectation is left out of the suite.
    """
    name = str(spec.get("expectation") or spec.get("type") or "")
    kwargs = dict(spec.get("kwargs") or {})
    try:
        etype = CLASS_TO_TYPE.get(name, name)
        meta = dict(spec.get("meta") or {})
        meta.update({k: kwargs.pop(k) for k in list(kwargs) if k in REPORT_KWARGS})
        kwargs = {_ALIASES.get(k, k): v for k, v in kwargs.items()}
        unknown = set(kwargs) - _KWARGS
        if unknown:
            raise TypeError(f"{name}: unexpected arguments {sorted(unknown)}")
        return Expectation(etype, meta=meta, **kwargs)
    except (UnknownExpectation, TypeError) as err:
        if strict:
            raise
        warnings.warn(f"expectation {name!r} left out: {err}", stacklevel=2)
        return None


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.expectations)

    @classmethod
    def from_specs(cls, name: str, specs: Iterable[Mapping[str, object]], strict: bool = True) -> Suite:
        built = (from_spec(s, strict=strict) for s in specs)
        return cls(name, tuple(e for e in built if e is not None))

    @classmethod
    def from_json(cls, text_or_obj: str | Mapping[str, object], strict: bool = True) -> Suite:
        """Load the saved suite shape: ``{"name", "expectations": [{"type", "kwargs"}]}``."""
        obj = json.loads(text_or_obj) if isinstance(text_or_obj, str) else text_or_obj
        return cls.from_specs(str(obj["name"]), obj.get("expectations", []), strict=strict)

    def to_json(self) -> str:
        out = []
        for e in self.expectations:
            kwargs = {k: getattr(e, k) for k in sorted(_KWARGS) if getattr(e, k) != _DEFAULTS[k]}
            if e.quantile_ranges is not None:
                quantiles, low, high = zip(*e.quantile_ranges)
                kwargs["quantile_ranges"] = {"quantiles": quantiles, "value_ranges": list(zip(low, high))}
            if e.partition_object is not None:
                kind, at, weights = e.partition_object
                kwargs["partition_object"] = {kind: at, "weights": weights}
            kwargs = {next((a for a, own in _ALIASES.items() if own == k), k): v for k, v in kwargs.items()}
            out.append({"type": e.type, "kwargs": kwargs, "meta": dict(e.meta)})
        return json.dumps({"name": self.name, "expectations": out}, indent=2, sort_keys=True)


ROWS = "__rows"


def _elements_name(i: int) -> str:
    return f"__elements_{i}"


def _missing_name(i: int) -> str:
    return f"__missing_{i}"


def _unexpected_name(i: int) -> str:
    return f"__unexpected_{i}"


def _field(schema: T.StructType, name: str) -> T.StructField:
    for f in schema.fields:
        if f.name == name:
            return f
    raise KeyError(f"column {name!r} not in {schema.simpleString()}")


def row_condition(e: Expectation) -> Column | None:
    """Rows that the expectation is about (null: not), as Spark's own SQL
    reads the text; the quality library's notations differ in a few spellings."""
    if e.row_condition is None:
        return None
    text = e.row_condition
    if e.condition_parser != "spark":
        text = re.sub(r"""col\(\s*["']([^"']+)["']\s*\)""", r"`\1`", text)
        text = re.sub(r"\.not(?:N|n)ull\(\)|\.notna\(\)", " is not null", text)
        text = re.sub(r"\.is(?:N|n)ull\(\)|\.isna\(\)", " is null", text)
        text = re.sub(r"\s&{1,2}\s", " and ", re.sub(r"\s\|{1,2}\s", " or ", text))
    return F.coalesce(F.expr(text), F.lit(False))


def is_in(c: Column, values: Iterable[object]) -> Column:
    """Whether a value (not missing) equals one of a declared set."""
    values = [v for v in values if v is not None]
    return c.isin(*values) if values else F.lit(False)


def _unexpected(e: Expectation, c: Column, dtype: T.DataType) -> Column:
    present = ~is_missing(c, dtype)
    if e.type == BE_NULL:
        return present
    if e.type == MATCH_REGEX:
        # search semantics: the pattern may match anywhere in the value
        return present & ~c.cast(T.StringType()).rlike(e.regex)
    if e.type == NOT_MATCH_REGEX:
        return present & c.cast(T.StringType()).rlike(e.regex)
    if e.type == IN_SET:
        return present & ~is_in(c, e.value_set)
    if e.type == NOT_IN_SET:
        return present & is_in(c, e.value_set)
    if e.type == LENGTHS_BETWEEN:
        c = F.length(c.cast(T.StringType()))
    inside = F.lit(True)
    if e.min_value is not None:
        lo = F.lit(e.min_value)
        inside = inside & ((c > lo) if e.strict_min else (c >= lo))
    if e.max_value is not None:
        hi = F.lit(e.max_value)
        inside = inside & ((c < hi) if e.strict_max else (c <= hi))
    return present & ~inside


def metric_columns(suite: Suite, schema: T.StructType) -> list[Column]:
    """Aggregate columns that measure the whole suite in one pass."""
    cols = [F.count(F.lit(1)).alias(ROWS)]
    for i, e in enumerate(suite.expectations):
        if e.type not in COUNTED:
            continue
        chosen = row_condition(e)
        within = (lambda x: x) if chosen is None else (lambda x, chosen=chosen: chosen & x)
        if chosen is not None:
            cols.append(F.count_if(chosen).alias(_elements_name(i)))
        if e.type in TABLE_COUNTS:
            continue
        f = _field(schema, e.column)
        c = F.col(f"`{e.column}`")
        cols.append(F.count_if(within(is_missing(c, f.dataType))).alias(_missing_name(i)))
        if e.type != NOT_NULL:
            cols.append(F.count_if(within(_unexpected(e, c, f.dataType))).alias(_unexpected_name(i)))
    return cols


def metric_schema(suite: Suite) -> T.StructType:
    names = [ROWS]
    for i, e in enumerate(suite.expectations):
        if e.type not in COUNTED:
            continue
        if e.row_condition is not None:
            names.append(_elements_name(i))
        if e.type in TABLE_COUNTS:
            continue
        names.append(_missing_name(i))
        if e.type != NOT_NULL:
            names.append(_unexpected_name(i))
    return T.StructType([T.StructField(n, T.LongType(), True) for n in names])


def _result_struct(suite: Suite, i: int, e: Expectation) -> Column:
    n = F.col(ROWS) if e.row_condition is None else F.col(_elements_name(i))
    null_long = F.lit(None).cast(T.LongType())
    if e.type in TABLE_COUNTS:
        ok = F.lit(True) if e.value is None else n == F.lit(e.value)
        if e.min_value is not None:
            ok = ok & (n >= F.lit(e.min_value))
        if e.max_value is not None:
            ok = ok & (n <= F.lit(e.max_value))
        return F.struct(
            F.lit(suite.name).alias("suite"),
            F.lit(e.type).alias("expectation"),
            F.lit(None).cast(T.StringType()).alias("column_name"),
            n.alias("element_count"),
            null_long.alias("missing_count"),
            null_long.alias("unexpected_count"),
            F.lit(None).cast(T.DoubleType()).alias("unexpected_percent"),
            ok.alias("success"),
        )
    missing = F.col(_missing_name(i))
    if e.type == NOT_NULL:
        unexpected, base = missing, n
    elif e.type == BE_NULL:
        unexpected, base = F.col(_unexpected_name(i)), n
    else:
        unexpected, base = F.col(_unexpected_name(i)), n - missing
    percent = F.when(
        base > 0, unexpected.cast(T.DoubleType()) * F.lit(100.0) / base.cast(T.DoubleType())
    )
    ok = F.when(base == 0, F.lit(True)).otherwise(
        (base - unexpected).cast(T.DoubleType()) / base.cast(T.DoubleType()) >= F.lit(float(e.mostly))
    )
    return F.struct(
        F.lit(suite.name).alias("suite"),
        F.lit(e.type).alias("expectation"),
        F.lit(e.column).alias("column_name"),
        n.alias("element_count"),
        missing.alias("missing_count"),
        unexpected.alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        ok.alias("success"),
    )


def results_from_metrics(metrics: DataFrame, suite: Suite) -> DataFrame:
    """One result row per expectation from the one-row metrics frame."""
    structs = [_result_struct(suite, i, e) for i, e in enumerate(suite.expectations) if e.type in COUNTED]
    if not structs:
        return metrics.where(F.lit(False)).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA.fields]
        )
    return metrics.select(F.inline(F.array(*structs)))


RESULT_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType(), True),
        T.StructField("expectation", T.StringType(), True),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("element_count", T.LongType(), True),
        T.StructField("missing_count", T.LongType(), True),
        T.StructField("unexpected_count", T.LongType(), True),
        T.StructField("unexpected_percent", T.DoubleType(), True),
        T.StructField("success", T.BooleanType(), True),
    ]
)


def result_row(suite: Suite, e: Expectation, **found: object) -> dict[str, object]:
    """A result row: the expectation's names and what was found."""
    row = {f.name: None for f in RESULT_SCHEMA.fields}
    return row | {"suite": suite.name, "expectation": e.type, "column_name": e.label} | found


def share_found(e: Expectation, unexpected: int, base: int) -> dict[str, object]:
    """Percentage and verdict of ``unexpected`` among ``base`` values."""
    percent = float(unexpected) * 100.0 / float(base) if base > 0 else None
    ok = base == 0 or float(base - unexpected) / float(base) >= float(e.mostly)
    return {"unexpected_count": unexpected, "unexpected_percent": percent, "success": bool(ok)}


def result_rows(suite: Suite, metrics: Mapping[str, object]) -> list[dict[str, object]]:
    """``results_from_metrics`` for counts already on the driver (e.g. from
    ``observe``): the same rule in plain Python, with no Spark job."""

    def count(name: str) -> int:
        value = metrics.get(name)
        return int(value) if value is not None else 0

    rows: list[dict[str, object]] = []
    for i, e in enumerate(suite.expectations):
        if e.type not in COUNTED:
            continue
        n = count(ROWS if e.row_condition is None else _elements_name(i))
        if e.type in TABLE_COUNTS:
            ok = (e.min_value is None or n >= e.min_value) and (e.max_value is None or n <= e.max_value)
            rows.append(result_row(suite, e, element_count=n, success=bool(ok and e.value in (None, n))))
            continue
        missing = count(_missing_name(i))
        unexpected = missing if e.type == NOT_NULL else count(_unexpected_name(i))
        base = n if e.type in (NOT_NULL, BE_NULL) else n - missing
        rows.append(result_row(suite, e, element_count=n, missing_count=missing, **share_found(e, unexpected, base)))
    return rows
