"""Dialect and types of CSV batches that declare neither.

The heads of some files (a bounded number, read through the file system) vote
on delimiter, quote character and header; files that disagree fail by name. A
head that quotes nothing, or holds one line only (Spark writes a header alone
for an empty first partition), follows the others in what it leaves open.
What the heads say is then held against **every** row in one Spark pass: a row
with another number of fields, or a value that is not of its column's type, is
reported with its file. So a wrong guess never turns into wrong data.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import fs

HEAD_BYTES = 1 << 16
HEAD_FILES = 64  # files whose heads vote; all files are checked
HEAD_LINES = 200
DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
CORRUPT = "__corrupt"

# Narrowest type first; a column takes the first one that all its values fit.
_SHAPES: tuple[tuple[T.DataType, re.Pattern[str]], ...] = (
    (T.BooleanType(), re.compile(r"(?i)true|false")),
    (T.LongType(), re.compile(r"[+-]?\d{1,18}")),
    (T.DoubleType(), re.compile(r"(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?(nan|inf(inity)?)")),
    (T.DateType(), re.compile(r"\d{4}-\d{2}-\d{2}")),
    (T.TimestampType(), re.compile(r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?")),
)


class MixedDialect(ValueError):
    """Files of one batch are written in different dialects."""


class CsvConflict(ValueError):
    """A row does not fit the dialect or the types of its batch."""


@dataclass(frozen=True)
class Dialect:
    delimiter: str
    quote: str
    header: bool
    columns: tuple[tuple[str, T.DataType], ...]

    @property
    def options(self) -> dict[str, str]:
        """Options of Spark's CSV reader."""
        return {"sep": self.delimiter, "quote": self.quote, "escape": self.quote, "header": str(self.header).lower()}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns])


def _rows(lines: list[str], delimiter: str, quote: str) -> list[list[str]]:
    try:
        return [r for r in csv.reader(lines, delimiter=delimiter, quotechar=quote, doublequote=True, strict=False) if r]
    except csv.Error:
        return []


def _type_of(values: list[str]) -> T.DataType:
    found = [v.strip() for v in values if v.strip()]
    for dtype, shape in _SHAPES:
        if found and all(shape.fullmatch(v) for v in found):
            return dtype
    return T.StringType()


def sniff_lines(lines: list[str]) -> Dialect | None:
    """Dialect of one file's first lines; None if there is no line.

    The delimiter is the one whose field count most rows share; of equal ones
    the one with more fields. The first row is a header if some column's type
    fits all other rows but not this one, or, among texts only, if its fields
    are all given, differ and none occurs again in its column."""
    lines = [line for line in lines if line.strip()]
    if not lines:
        return None
    best: tuple[tuple[float, int, bool, int], str, str, list[list[str]]] | None = None
    for k, (delimiter, quote) in enumerate((d, q) for q in QUOTES for d in DELIMITERS):
        rows = _rows(lines, delimiter, quote)
        if not rows:
            continue
        width, n = Counter(map(len, rows)).most_common(1)[0]
        # fields that begin and end with the quote character speak for it
        wrapped = any(len(v) > 1 and v[0] == v[-1] == quote for line in lines for v in map(str.strip, line.split(delimiter)))
        rank = (n / len(rows) if width > 1 else 0.0, width, wrapped, -k)
        if best is None or rank > best[0]:
            best = (rank, delimiter, quote, rows)
    if best is None:
        return None
    _, delimiter, quote, rows = best
    width = len(rows[0])
    body = [r for r in rows[1:] if len(r) == width]
    types = [_type_of([r[j] for r in body]) for j in range(width)]
    first = rows[0]
    alien = any(t != T.StringType() and first[j].strip() and _type_of([first[j]]) == T.StringType() for j, t in enumerate(types))
    names = all(v.strip() for v in first) and len(set(first)) == width
    fresh = all(_type_of([v]) == T.StringType() for v in first) and all(first[j] not in {r[j] for r in body} for j in range(width))
    header = names and (alien or (all(t == T.StringType() for t in types) and fresh))
    if not header:
        types = [_type_of([r[j] for r in [first, *body]]) for j in range(width)]
    columns = first if header else [f"column{j}" for j in range(width)]
    return Dialect(delimiter, quote, header, tuple(zip((c.strip() for c in columns), types)))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of both; a column without values in a head is text
    there and does not widen others."""
    if a == b:
        return a
    numbers, days = (T.LongType(), T.DoubleType()), (T.DateType(), T.TimestampType())
    return T.DoubleType() if a in numbers and b in numbers else T.TimestampType() if a in days and b in days else T.StringType()


def _silent(lines: list[str], dialect: Dialect) -> bool:
    """Whether the lines read the same with every quote character."""
    rows = _rows(lines, dialect.delimiter, dialect.quote)
    return all(_rows(lines, dialect.delimiter, q) == rows for q in QUOTES)


def _as(mine: Dialect, lines: list[str], other: Dialect) -> Dialect | None:
    """A file's dialect as the other files have it, where its head leaves open
    what differs: the quote character if it quotes nothing, and whether a lone
    line of texts is a header. None if it says otherwise."""
    if mine.delimiter != other.delimiter or len(mine.columns) != len(other.columns):
        return None
    if mine.quote != other.quote and not _silent(lines, mine):
        return None
    first = [v.strip() for v in _rows(lines[:1], other.delimiter, other.quote)[0]]
    if other.header:
        fits = first == [n for n, _ in other.columns] and (mine.header or len(lines) == 1)
        return Dialect(other.delimiter, other.quote, True, mine.columns) if fits else None
    if mine.header and len(lines) > 1:
        return None
    types = [_type_of([v]) for v in first] if mine.header else [t for _, t in mine.columns]
    return Dialect(other.delimiter, other.quote, False, tuple((n, t) for (n, _), t in zip(other.columns, types)))


def sniff_csv(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> Dialect:
    """Dialect of a batch (a file or folder) by the vote of its files' heads."""
    where = {k: v for k, v in (options or {}).items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    files = sorted(fs.plain(spark, f) for f in spark.read.options(**where).text(path).inputFiles())
    if not files:
        raise FileNotFoundError(path)
    step = -(-len(files) // HEAD_FILES)
    chosen = files[::step]
    with ThreadPoolExecutor(16) as pool:
        heads = list(pool.map(lambda f: fs.read_head(spark, f, HEAD_BYTES), chosen))
    found: list[tuple[str, Dialect, list[str]]] = []
    for name, head in zip(chosen, heads):
        text = head.decode("utf-8-sig", errors="replace")
        lines = text.splitlines()
        if len(head) == HEAD_BYTES and len(lines) > 1:
            lines = lines[:-1]  # cut by the end of the head
        lines = [line for line in lines[:HEAD_LINES] if line.strip()]
        mine = sniff_lines(lines)
        if mine is not None:
            found.append((name, mine, lines))
    if not found:
        return Dialect(",", '"', False, ())
    shape = lambda d: (d.delimiter, d.quote, d.header, len(d.columns), tuple(n for n, _ in d.columns) if d.header else ())
    speak = [d for _, d, lines in found if len(lines) > 1 and not _silent(lines, d)]
    speak = speak or [d for _, d, lines in found if len(lines) > 1] or [d for _, d, _ in found]
    winner = Counter(map(shape, speak)).most_common(1)[0][0]
    best = next(d for d in speak if shape(d) == winner)
    agreed: list[Dialect] = []
    for name, a, lines in found:
        mine = a if shape(a) == winner else _as(a, lines, best)
        if mine is None:
            raise MixedDialect(
                f"{name} is delimited by {a.delimiter!r} (header {a.header}, {len(a.columns)} columns), "
                f"most files of {path} by {best.delimiter!r} (header {best.header}, {len(best.columns)} columns)"
            )
        agreed.append(mine)
    # a header alone says nothing about types
    typed = [d for d, (_, _, lines) in zip(agreed, found) if not (d.header and len(lines) == 1)] or agreed
    types = []
    for j in range(len(best.columns)):
        dtype = typed[0].columns[j][1]
        for other in typed[1:]:
            dtype = _wider(dtype, other.columns[j][1])
        types.append(dtype)
    return Dialect(best.delimiter, best.quote, best.header, tuple((n, t) for (n, _), t in zip(agreed[0].columns, types)))


def _text(spark: SparkSession, path: str, dialect: Dialect, options: Mapping[str, str]) -> DataFrame:
    """All fields as text; a malformed row is kept whole in ``CORRUPT``."""
    fields = [T.StructField(n, T.StringType(), True) for n, _ in dialect.columns]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).options(**{**options, **dialect.options})
    return reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema="false").csv(path)


def _cast(name: str, dtype: T.DataType, strict: bool) -> Column:
    c = F.col(f"`{name}`")
    trimmed = c if isinstance(dtype, T.StringType) else F.nullif(F.trim(c), F.lit(""))
    return trimmed.cast(dtype) if strict else trimmed.try_cast(dtype)


def conflicts(spark: SparkSession, path: str, dialect: Dialect, options: Mapping[str, str] | None = None) -> DataFrame:
    """``file, column_name, value, record`` of rows that do not fit the
    dialect (``column_name`` null, the record as read) or a column's type."""
    text = _text(spark, path, dialect, dict(options or {}))
    wrong = [F.when(F.col(CORRUPT).isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col(CORRUPT).alias("value")))]
    for name, dtype in dialect.columns:
        c = F.col(f"`{name}`")
        if not isinstance(dtype, T.StringType):
            bad = (F.trim(c) != "") & _cast(name, dtype, strict=False).isNull()
            wrong.append(F.when(F.col(CORRUPT).isNull() & bad, F.struct(F.lit(name).alias("column_name"), c.alias("value"))))
    record = F.array_join(F.array(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n, _ in dialect.columns]), dialect.delimiter)
    rows = text.select(
        F.col("_metadata.file_path").alias("file"), F.array_compact(F.array(*wrong)).alias("wrong"), F.coalesce(F.col(CORRUPT), record).alias("record")
    )
    return rows.select("file", "record", F.inline("wrong")).select("file", "column_name", "value", "record")


def read_sniffed(spark: SparkSession, path: str, options: Mapping[str, str] | None = None, check: bool = True) -> DataFrame:
    """A CSV batch with the dialect, names and types its files show.

    With ``check`` one pass over all rows goes ahead and names the first file
    (by path) with a row that does not fit, and the row. The frame returned
    casts strictly in any case: a bad value fails its query."""
    dialect = sniff_csv(spark, path, options)
    if not dialect.columns:
        return spark.createDataFrame([], T.StructType([]))
    if check:
        found = conflicts(spark, path, dialect, options).orderBy("file", F.monotonically_increasing_id()).limit(1).collect()
        if found:
            f = found[0]
            what = "does not have the fields of its batch" if f["column_name"] is None else f"has {f['value']!r} in {f['column_name']}"
            raise CsvConflict(f"{f['file']}: row {f['record']!r} {what}")
    text = _text(spark, path, dialect, dict(options or {}))
    return text.select(*[_cast(n, t, strict=True).alias(n) for n, t in dialect.columns])
