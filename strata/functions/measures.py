"""Expectations that single rows cannot decide, measured at any size.

Every measure adds mergeable aggregates to the common pass of its suite
(``first_pass``; they ride on ``observe`` like the counts) and may need more
jobs afterwards (``complete``). None gathers a column: what reaches the driver
are counts, one row per range partition, or at most ``GATHER`` values.

* uniqueness: rows per value, combined in the tasks that read them before the
  shuffle, so a value on a third of all rows is one row per task;
* order: rows dealt by range of the order columns, neighbours compared within
  each range, and the last row of a range with the first of the next;
* quantiles: a sketch brackets each rank in the common pass; exact counts
  around the brackets, and sketches of what lies within, narrow them until the
  few values left are counted;
* distinct sets: declared values are found in the common pass, bounded by the
  set; a shuffle counts others only if there are any;
* divergence: counts per declared bin or value in the common pass;
* z-scores: mean and deviation in the common pass, then a count beyond the two
  bounds they give, which the scan can prune by;
* other tables: keys are counted per value before they meet the other table's
  distinct keys in an anti join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expectations as X
from strata.functions.columns import is_missing
from strata.functions.expectations import Expectation, Suite, is_in, result_row, row_condition, share_found

SKETCH = 10_000  # accuracy of the quantile sketches: ranks to within a share of 1/SKETCH
MARGIN = 2 / SKETCH
MARKS = 1 << 23  # bits of the table of wanted keys
GATHER = 100_000  # distinct values of a bracket that are counted one by one, at most

MEASURED_SCHEMA = T.StructType(
    X.RESULT_SCHEMA.fields + [T.StructField("observed_values", T.ArrayType(T.DoubleType()), True)]
)
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Rows:
    """The rows that an expectation is about, and what the common pass found."""

    df: DataFrame
    got: Mapping[str, object]
    tables: Tables
    e: Expectation

    @property
    def present(self) -> DataFrame:
        """The column's values, none missing, as ``v``."""
        c, dtype = _column(self.df.schema, self.e.column)
        return self.df.where(~is_missing(c, dtype)).select(c.alias("v"))

    @property
    def base(self) -> int:
        return int(self.got["elements"]) - int(self.got["missing"])

    def other(self) -> DataFrame:
        name = self.e.other_table_name
        return self.tables[name] if name in self.tables else self.df.sparkSession.table(name)


def _column(schema: T.StructType, name: str) -> tuple[Column, T.DataType]:
    return F.col(f"`{name}`"), X._field(schema, name).dataType


def _numbers(*values: object) -> list[float | None]:
    """Observed values as doubles; dates and texts are not reported."""
    out: list[float | None] = []
    for v in values:
        try:
            out.append(float(v))  # type: ignore[arg-type]
        except (TypeError, ValueError):
            out.append(None)
    return out


def _within(e: Expectation, value: object) -> bool:
    """Whether an observed value keeps the expectation's bounds; a value that
    does not exist (an empty column) does."""
    if value is None:
        return True
    low = e.min_value is None or (value > e.min_value if e.strict_min else value >= e.min_value)
    high = e.max_value is None or (value < e.max_value if e.strict_max else value <= e.max_value)
    return bool(low and high)


# --- uniqueness -------------------------------------------------------------


def repeated_rows(df: DataFrame, columns: tuple[str, ...], ignore_row_if: str) -> tuple[int, int, int]:
    """Rows, rows skipped for missing values, and rows of repeated keys."""
    keys = [_column(df.schema, c) for c in columns]
    missing = [is_missing(c, dtype) for c, dtype in keys]
    groups = df.select(*[c for c, _ in keys]).groupBy(*[c for c, _ in keys]).agg(F.count(F.lit(1)).alias("__n"))
    skip = {"never": F.lit(False), "any_value_is_missing": F.lit(False), "all_values_are_missing": F.lit(True)}[ignore_row_if]
    for m in missing:
        skip = skip & m if ignore_row_if == "all_values_are_missing" else skip | m if ignore_row_if != "never" else skip
    n = F.col("__n")
    zero = F.lit(0).cast("long")
    found = groups.agg(
        F.coalesce(F.sum(n), zero),
        F.coalesce(F.sum(F.when(skip, n)), zero),
        F.coalesce(F.sum(F.when(~skip & (n > 1), n)), zero),
    ).first()
    return int(found[0]), int(found[1]), int(found[2])


def _unique(r: Rows) -> dict[str, object]:
    columns, ignore = ((r.e.column,), "any_value_is_missing") if r.e.type == X.UNIQUE else (r.e.columns, r.e.ignore_row_if)
    n, skipped, unexpected = repeated_rows(r.df, columns, ignore)
    return {"element_count": n, "missing_count": skipped} | share_found(r.e, unexpected, n - skipped)


# --- order ------------------------------------------------------------------


def order_violations(df: DataFrame, column: str, order_by: tuple[str, ...], strictly: bool, falling: bool) -> int:
    """Values (missing ones left out) that break the order to the value
    before them, rows ordered by ``order_by`` (nulls first; ties by the value
    itself, in the order asked for)."""
    c, dtype = _column(df.schema, column)
    keys = {f"__k{j}": F.col(f"`{k}`") for j, k in enumerate(order_by)}
    rows = df.where(~is_missing(c, dtype)).select(*[k.alias(n) for n, k in keys.items()], c.alias("v"))
    value = F.col("v").desc() if falling else F.col("v").asc()
    order = [F.col(n) for n in keys] + [value, F.col("__row")]  # the row splits a hot key: equal rows, in any order
    ranged = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order)
    w = Window.partitionBy("__part").orderBy(*order)
    near = ranged.withColumn("__part", F.spark_partition_id()).select(
        "__part", "v", F.lag("v").over(w).alias("before"), F.row_number().over(w).alias("at"),
        F.lead("__row").over(w).isNull().alias("ends"),
    )
    later, earlier = (F.col("before"), F.col("v")) if falling else (F.col("v"), F.col("before"))
    broken = (later <= earlier) if strictly else (later < earlier)
    parts = near.groupBy("__part").agg(
        F.count_if((F.col("at") > 1) & broken).alias("n"),
        F.max(F.when(F.col("at") == 1, F.col("v"))).alias("first"),
        F.max(F.when(F.col("ends"), F.col("v"))).alias("last"),
    )
    found = sorted(parts.collect(), key=lambda p: p["__part"])  # one row per range partition
    total = sum(int(p["n"]) for p in found)
    for a, b in zip(found, found[1:]):
        later, earlier = (a["last"], b["first"]) if falling else (b["first"], a["last"])
        total += bool(later <= earlier if strictly else later < earlier)
    return total


def _ordered(r: Rows) -> dict[str, object]:
    e = r.e
    return share_found(e, order_violations(r.df, e.column, e.order_by, e.strictly, e.type == X.DECREASING), r.base)


# --- quantiles --------------------------------------------------------------


def _around(q: float) -> tuple[float, float]:
    return max(0.0, q - MARGIN), min(1.0, q + MARGIN)


def _sketch(value: Column, quantiles: list[float]) -> Column:
    each = [F.lit(x) for q in quantiles for x in _around(q)]
    return F.percentile_approx(value, F.array(*each), F.lit(SKETCH))


def order_statistics(values: DataFrame, ranks: list[int], brackets: list[tuple[object, object]]) -> list[object]:
    """The values (column ``v``, none missing) at some ranks from 1 on, exact.

    ``brackets`` are pairs of values that may hold them (from a sketch). Each
    round counts the rows below, on and between a pair; the rank is then on one
    of the two, or strictly between, where a sketch gives a closer pair, until
    so few rows are between that their values are counted one by one."""
    v = F.col("v")
    found: dict[int, object] = {}
    open_ = {j: (rank, *brackets[j]) for j, rank in enumerate(ranks)}
    while open_:
        counts = []
        for j, (_, lo, hi) in open_.items():
            counts += [
                F.count_if(v < F.lit(lo)).alias(f"below{j}"), F.count_if(v == F.lit(lo)).alias(f"lo{j}"),
                F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"in{j}"), F.count_if(v == F.lit(hi)).alias(f"hi{j}"),
            ]
        got = values.agg(*counts).first()
        closer, wrong = {}, []
        for j, (rank, lo, hi) in open_.items():
            start = got[f"below{j}"] + got[f"lo{j}"]
            top = start + got[f"in{j}"]
            if got[f"below{j}"] < rank <= start:
                found[j] = lo
            elif top < rank <= top + got[f"hi{j}"]:
                found[j] = hi
            elif not start < rank <= top:
                wrong.append(j)  # outside the bracket: begin again with all values
            elif got[f"in{j}"] <= GATHER:
                inside = values.where((v > F.lit(lo)) & (v < F.lit(hi)))
                for value, n in sorted(inside.groupBy("v").count().collect()):  # GATHER rows at most
                    start += n
                    if rank <= start:
                        found[j] = value
                        break
            else:
                closer[j] = ((rank - start) / got[f"in{j}"], lo, hi)
        open_ = {j: open_[j] for j in (*closer, *wrong)}
        if closer:
            pairs = values.agg(
                *[_sketch(F.when((v > F.lit(lo)) & (v < F.lit(hi)), v), [q]).alias(str(j)) for j, (q, lo, hi) in closer.items()]
            ).first()
            open_ |= {j: (open_[j][0], *pairs[str(j)]) for j in closer}
        if wrong:
            least, most = values.agg(F.min("v"), F.max("v")).first()
            open_ |= {j: (open_[j][0], least, most) for j in wrong}
    return [found[j] for j in range(len(ranks))]


def rank_of(q: float, n: int) -> int:
    """The rank of the smallest value that a share of q of all do not exceed."""
    return max(1, n - math.floor(n - n * q))


def _quantiles(r: Rows) -> dict[str, object]:
    n = r.base
    wanted = r.e.quantile_ranges
    if n == 0:
        return {"observed_values": [], "success": True}
    pairs = r.got["sketch"]
    brackets = [(pairs[2 * j], pairs[2 * j + 1]) for j in range(len(wanted))]
    values = order_statistics(r.present, [rank_of(q, n) for q, _, _ in wanted], brackets)
    ok = all((lo is None or v >= lo) and (hi is None or v <= hi) for v, (_, lo, hi) in zip(values, wanted))
    return {"observed_values": _numbers(*values), "success": bool(ok)}


def _median(r: Rows) -> dict[str, object]:
    """The middle value, or the mean of the two middle ones."""
    n = r.base
    if n == 0:
        return {"observed_values": [], "success": True}
    bracket = tuple(r.got["sketch"])
    low, high = order_statistics(r.present, [(n + 1) // 2, n // 2 + 1], [bracket, bracket])
    median = low if low == high else (low + high) / 2
    return {"observed_values": _numbers(median), "success": _within(r.e, median)}


# --- distinct values --------------------------------------------------------


def _declared(e: Expectation) -> list[object]:
    return list(dict.fromkeys(v for v in e.value_set if v is not None))


def _distinct_set(r: Rows) -> dict[str, object]:
    declared = _declared(r.e)
    absent = len(declared) - int(r.got["seen"])
    others = 0
    if r.got["outside"]:  # else every value is declared, and the common pass has seen them all
        others = r.present.where(~is_in(F.col("v"), declared)).distinct().count()
    unexpected = {X.DISTINCT_IN_SET: others, X.DISTINCT_CONTAIN_SET: absent, X.DISTINCT_EQUAL_SET: others + absent}[r.e.type]
    return {"unexpected_count": unexpected, "observed_values": [float(r.got["seen"] + others)], "success": unexpected == 0}


def _distinct_count(r: Rows) -> dict[str, object]:
    distinct = r.present.groupBy("v").agg(F.lit(1)).count()
    value = distinct if r.e.type == X.UNIQUE_COUNT else distinct / r.base if r.base else None
    return {"observed_values": _numbers(value) if value is not None else [], "success": _within(r.e, value)}


# --- distributions ----------------------------------------------------------


def _cells(e: Expectation, c: Column) -> list[Column]:
    """Conditions of the declared values, or of the bins (the last one closed)
    with all below the first and above the last."""
    kind, at, _ = e.partition_object
    if kind == "values":
        return [c == F.lit(v) for v in at]
    bins = [(c >= F.lit(a)) & (c < F.lit(b)) for a, b in zip(at, at[1:-1])]
    bins.append((c >= F.lit(at[-2])) & (c <= F.lit(at[-1])))
    return [*bins, c < F.lit(at[0]), c > F.lit(at[-1])]


def divergence(observed: list[float], expected: list[float]) -> float:
    """Relative entropy of two lists of weights, each scaled to sum 1."""
    p, q = sum(observed), sum(expected)
    total = 0.0
    for a, b in zip(observed, expected):
        if a > 0 and b <= 0:
            return math.inf
        if a > 0:
            total += a / p * math.log((a / p) / (b / q))
    return total


def _divergence(r: Rows) -> dict[str, object]:
    e = r.e
    kind, at, weights = e.partition_object
    if r.base == 0:
        return {"observed_values": [], "success": True}
    counts = [float(r.got[f"cell{j}"]) for j in range(len(_cells(e, F.lit(None))))]
    total = sum(weights)
    kept = 1.0 - e.internal_weight_holdout - (e.tail_weight_holdout if kind == "bins" else 0.0)
    expected = [w / total * kept for w in weights]
    empty = sum(w == 0 for w in expected)
    spread = 0.0  # entropy of the values that are not declared, on the weight held out
    if kind == "bins":
        expected = [w or e.internal_weight_holdout / empty for w in expected] + [e.tail_weight_holdout / 2] * 2
    else:
        others = r.base - sum(counts)
        if others and e.internal_weight_holdout > 0:
            share = F.col("count") / F.lit(float(r.base))
            groups = r.present.where(~is_in(F.col("v"), at)).groupBy("v").count()
            entropy, m = groups.agg(F.sum(share * F.log(share)), F.count(F.lit(1))).first()
            each = e.internal_weight_holdout / (m + empty)
            expected = [w or each for w in expected]
            spread = entropy - others / r.base * math.log(each)
        elif others:
            spread = math.inf
        elif empty and e.internal_weight_holdout > 0:
            expected = [w or e.internal_weight_holdout / empty for w in expected]
    if spread:
        found = spread
        for a, b in zip(counts, expected):
            p = a / r.base
            found += 0.0 if not a else p * math.log(p / b) if b > 0 else math.inf
    else:
        found = divergence(counts, expected)
    return {"observed_values": [found], "success": found <= e.threshold}


def _z_scores(r: Rows) -> dict[str, object]:
    """Values further than ``threshold`` deviations from the mean. A column
    without spread has none."""
    mean, spread = r.got["mean"], r.got["spread"]
    limit = abs(r.e.threshold) if r.e.double_sided else r.e.threshold
    unexpected = 0
    if spread:
        z = (F.col("v") - F.lit(mean)) / F.lit(spread)
        # plain bounds on the column, a little wide of the mark, reach the scan
        slack = 1e-9 * (abs(mean) + abs(limit) * spread)
        far = F.col("v") >= F.lit(mean + limit * spread - slack)
        if r.e.double_sided:
            far = far | (F.col("v") <= F.lit(mean - limit * spread + slack))
        beyond = (F.abs(z) if r.e.double_sided else z) >= F.lit(float(limit))
        unexpected = r.present.where(far & beyond).count()
    return share_found(r.e, unexpected, r.base) | {"observed_values": _numbers(mean, spread)}


def _statistic(r: Rows) -> dict[str, object]:
    value = r.got["value"] if r.base else None
    return {"observed_values": [] if value is None else _numbers(value), "success": _within(r.e, value)}


# --- other tables -----------------------------------------------------------


def _marked(rows: DataFrame, key: str, wanted: DataFrame, dtype: T.DataType) -> DataFrame:
    """Rows whose key's hash sets a bit that a wanted hash set: all rows with a
    wanted key, few others, found before anything is shuffled. The bitmap has
    MARKS bits (1 MB) whatever the tables hold, and is what is broadcast."""
    bit = F.pmod(F.col("v"), F.lit(MARKS))
    maps = wanted.groupBy(F.bitmap_bucket_number(bit).alias("__block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits")
    )
    mine = F.pmod(F.xxhash64(key), F.lit(MARKS))
    met = rows.withColumn("__block", F.bitmap_bucket_number(mine)).join(F.broadcast(maps), "__block")
    place = F.bitmap_bit_position(mine)
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(key)


def _same_count(r: Rows) -> dict[str, object]:
    other = r.other().count()
    n = int(r.got["elements"])
    return {"element_count": n, "observed_values": [float(other)], "success": n == other}


def _in_other(r: Rows) -> dict[str, object]:
    """Rows whose key is no key of the other table. A missing key is skipped,
    as a foreign key is; null keys of the other table match nothing."""
    names = r.e.other_columns or (r.e.column,)
    c, dtype = _column(r.df.schema, r.e.column)
    if len(names) != 1:
        raise TypeError("one column of the other table is needed")
    known, other_type = _column(r.other().schema, names[0])
    keys = r.present.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    other = r.other().where(~is_missing(known, other_type)).select(known.alias("known"))
    other = _marked(other, "known", r.present.select(F.xxhash64(F.col("v").cast(other_type)).alias("v")), other_type).distinct()
    orphans = keys.join(other, F.col("v") == F.col("known"), "left_anti").agg(F.sum("n")).first()[0]
    return share_found(r.e, int(orphans or 0), r.base)


# --- the registry -----------------------------------------------------------

_STATISTICS: dict[str, Callable[[Column], Column]] = {
    X.COLUMN_MIN: F.min,
    X.COLUMN_MAX: F.max,
    X.COLUMN_MEAN: F.avg,
    X.COLUMN_SUM: F.sum,
    X.COLUMN_STDEV: F.stddev_samp,
}
_FINISH: dict[str, Callable[[Rows], dict[str, object]]] = {
    X.UNIQUE: _unique,
    X.COMPOUND_UNIQUE: _unique,
    X.INCREASING: _ordered,
    X.DECREASING: _ordered,
    X.QUANTILES: _quantiles,
    X.MEDIAN: _median,
    X.DISTINCT_IN_SET: _distinct_set,
    X.DISTINCT_CONTAIN_SET: _distinct_set,
    X.DISTINCT_EQUAL_SET: _distinct_set,
    X.UNIQUE_COUNT: _distinct_count,
    X.UNIQUE_PROPORTION: _distinct_count,
    X.DIVERGENCE: _divergence,
    X.Z_SCORES: _z_scores,
    X.SAME_ROW_COUNT: _same_count,
    X.IN_OTHER_TABLE: _in_other,
} | dict.fromkeys(_STATISTICS, _statistic)


def _aggregates(e: Expectation, value: Column) -> dict[str, Column]:
    """What a measure adds to the common pass; ``value`` is null where the
    column is missing or the row condition does not hold."""
    if e.type == X.QUANTILES:
        return {"sketch": _sketch(value, [q for q, _, _ in e.quantile_ranges])}
    if e.type == X.MEDIAN:
        return {"sketch": _sketch(value, [0.5])}
    if e.type in (X.DISTINCT_IN_SET, X.DISTINCT_CONTAIN_SET, X.DISTINCT_EQUAL_SET):
        known = is_in(value, _declared(e))
        return {"seen": F.size(F.collect_set(F.when(known, value))), "outside": F.count_if(~known)}
    if e.type == X.DIVERGENCE:
        return {f"cell{j}": F.count_if(cell) for j, cell in enumerate(_cells(e, value))}
    if e.type == X.Z_SCORES:
        return {"mean": F.avg(value), "spread": F.stddev_samp(value)}
    if e.type in _STATISTICS:
        return {"value": _STATISTICS[e.type](value)}
    return {}


def _name(i: int, what: str) -> str:
    return f"__measure_{i}_{what}"


def first_pass(suite: Suite, schema: T.StructType) -> list[Column]:
    """Aggregates of the suite's measured expectations for the common pass."""
    out = []
    for i, e in enumerate(suite.expectations):
        if e.type not in X.MEASURED:
            continue
        chosen = row_condition(e)
        chosen = F.lit(True) if chosen is None else chosen
        out.append(F.count_if(chosen).alias(_name(i, "elements")))
        for name in e.columns or ():
            X._field(schema, name)
        if e.column is None:
            continue
        c, dtype = _column(schema, e.column)
        out.append(F.count_if(chosen & is_missing(c, dtype)).alias(_name(i, "missing")))
        value = F.when(chosen & ~is_missing(c, dtype), c)
        out += [a.alias(_name(i, what)) for what, a in _aggregates(e, value).items()]
    return out


def complete(df: DataFrame, suite: Suite, metrics: Mapping[str, object], tables: Tables | None = None) -> dict[int, dict[str, object]]:
    """Result rows of the measured expectations, by their place in the suite:
    what the common pass leaves open is read from ``df``."""
    out = {}
    for i, e in enumerate(suite.expectations):
        if e.type not in X.MEASURED:
            continue
        chosen = row_condition(e)
        prefix = _name(i, "")
        got = {k[len(prefix):]: v for k, v in metrics.items() if k.startswith(prefix)}
        rows = Rows(df if chosen is None else df.where(chosen), got, tables or {}, e)
        found = {"element_count": int(got["elements"]), "missing_count": got.get("missing"), "observed_values": None}
        out[i] = result_row(suite, e, **found | _FINISH[e.type](rows))
    return out
