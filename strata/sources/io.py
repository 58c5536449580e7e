"""Readers and writers, one dispatch per format.

Formats: ``csv`` (header line; columns matched by name; without a declared
schema the files show delimiter, quotes and header), ``json`` (one
object per line, or one array per file, also mixed in one batch), ``parquet``,
``delta`` (when the data source is on the class path) and ``snapshot``
(our pointer-versioned Parquet table, the stand-in for ``delta``).
Unknown formats raise.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import integral_from_text
from strata.sources import fs, snapshot
from strata.sources.sniff import sniff_csv

FORMATS = ("csv", "json", "parquet", "snapshot", "delta")

_delta_checked: dict[int, bool] = {}


def delta_available(spark: SparkSession) -> bool:
    key = id(spark)
    if key not in _delta_checked:
        try:
            spark.sparkContext._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
            _delta_checked[key] = True
        except Exception:
            _delta_checked[key] = False
    return _delta_checked[key]


def table_format(spark: SparkSession, fmt: str) -> str:
    """``delta`` falls back to ``snapshot`` when the data source is absent."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    if fmt == "delta" and not delta_available(spark):
        return "snapshot"
    return fmt


def read_batch(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    file_name_column: str | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Read one batch (a folder or file) in the given format.

    ``file_name_column`` adds the base name of each row's file, taken from
    the scan's hidden ``_metadata`` column; ``extra`` adds columns that a CSV
    or JSON scan computes from it.
    """
    extra = dict(extra or {})
    if file_name_column:
        extra[file_name_column] = F.col("_metadata.file_name")
    fmt = table_format(spark, fmt)
    opts = dict(options or {})
    if fmt == "snapshot":
        df = snapshot.read_snapshot(spark, path, schema)
        return _with_file_name(df, file_name_column)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        given = {k.lower() for k in opts}
        if schema is None and not given & {"sep", "delimiter", "header"}:
            shown = sniff_csv(spark, path, opts)
            if shown.columns:
                opts = {**shown.options, **opts}
        opts.setdefault("header", "true")
        opts.setdefault("mode", "FAILFAST")
        if schema is None:
            opts.setdefault("inferSchema", "true")
            return reader.options(**opts).csv(path).select("*", *[c.alias(n) for n, c in extra.items()])
        # Columns are matched to the header by name, as text, then cast
        # strictly: a declared CSV schema would be applied by position. The
        # header of the first file names the columns; every other file's
        # header is checked against it (enforceSchema off), so files written
        # with another column order fail instead of being misread.
        names = spark.read.options(**opts).csv(path).columns
        as_text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        text = spark.read.schema(as_text).options(**{**opts, "enforceSchema": "false"}).csv(path)
        cols = [_from_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
        return text.select(*cols, *[c.alias(n) for n, c in extra.items()])
    if fmt == "json":
        declared = next((str(opts.pop(k)).lower() == "true" for k in list(opts) if k.lower() == "multiline"), None)
        arrays, others = json_layouts(spark, path, opts) if declared is not False else ([], [path])
        if declared and others:
            raise ValueError(f"{others[0]} does not hold one JSON array; it would lose records as multiLine")
        parts = [
            _read_json(spark, files, schema, {"mode": "FAILFAST", **opts, "multiLine": multi}, extra)
            for files, multi in ((others, "false"), (arrays, "true"))
            if files
        ]
        if not parts:
            parts = [_read_json(spark, [path], schema, {**opts, "multiLine": "false"}, extra)]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=schema is None)
    if fmt == "delta":
        df = reader.options(**opts).format("delta").load(path)
    else:
        df = reader.options(**opts).parquet(path)
    return _with_file_name(df, file_name_column)


def _read_json(
    spark: SparkSession, paths: list[str], schema: T.StructType | None, opts: Mapping[str, str], extra: Mapping[str, Column]
) -> DataFrame:
    """JSON files of one layout."""
    if schema is not None:
        # integral fields are read as their JSON text, so 1011.0 is accepted
        as_text = T.StructType(
            [T.StructField(f.name, T.StringType(), True) if _integral(f.dataType) else f for f in schema.fields]
        )
        raw = spark.read.schema(as_text).options(**opts).json(paths)
        cols = [
            (_from_text(F.col(f"`{f.name}`"), f.dataType) if _integral(f.dataType) else F.col(f"`{f.name}`")).alias(f.name)
            for f in schema.fields
        ]
        return raw.select(*cols, *[c.alias(n) for n, c in extra.items()])
    return spark.read.options(**opts).json(paths).select("*", *[c.alias(n) for n, c in extra.items()])


def json_layouts(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> tuple[list[str], list[str]]:
    """The batch's files by layout: those that hold one JSON array (read
    whole, one task per file) and those with one object per line (splittable).

    A file is an array if the first character that is not blank is a bracket.
    Only heads are read, some files at once, so the rows are scanned once; the
    heads too are saved by declaring ``multiLine`` false.
    """
    where = {k: v for k, v in (options or {}).items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    files = [fs.plain(spark, f) for f in spark.read.options(**where).text(path).inputFiles()]

    def is_array(file: str) -> bool:
        size = 1 << 12
        while True:
            head = fs.read_head(spark, file, size)
            text = head.lstrip(b" \t\r\n\x0b\x0c\xef\xbb\xbf")
            if text or len(head) < size:
                return text.startswith(b"[")
            size *= 16  # blanks only, so far

    with ThreadPoolExecutor(16) as pool:
        arrays = list(pool.map(is_array, files))
    return [f for f, a in zip(files, arrays) if a], [f for f, a in zip(files, arrays) if not a]


def _integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def _from_text(c, dtype: T.DataType):
    """Text to the declared type: whole numbers may carry a ``.0``."""
    return integral_from_text(c, dtype) if _integral(dtype) else c.cast(dtype)


def _with_file_name(df: DataFrame, column: str | None) -> DataFrame:
    return df.withColumn(column, F.col("_metadata.file_name")) if column else df


def read_table(
    spark: SparkSession,
    table_root: str,
    fmt: str = "parquet",
    execution_date: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a ``dt=``-partitioned table root; ``dt`` becomes a column.

    With ``execution_date`` only that date's folder is listed and scanned.
    CSV and JSON go through ``read_batch``, with headers and strict types.
    """
    fmt = table_format(spark, fmt)
    if fmt == "snapshot":
        return _read_snapshot_table(spark, table_root, execution_date, schema)
    root = table_root.rstrip("/")
    where = f"{root}/dt={execution_date}" if execution_date is not None else root
    if fmt in ("csv", "json"):
        day = F.regexp_extract(F.col("_metadata.file_path"), r"/dt=([^/]+)/", 1).cast(T.DateType())
        opts = {"recursiveFileLookup": "true"}
        df = read_batch(spark, where, fmt, schema, opts, file_name_column=None, extra={"dt": day})
        return df
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if execution_date is not None and not fs.exists(spark, where):  # no such date: no rows
        return reader.format(fmt).load(root).where(F.col("dt") == F.lit(execution_date).cast("date"))
    return reader.format(fmt).load(where)


def _read_snapshot_table(
    spark: SparkSession, table_root: str, execution_date: str | None, schema: T.StructType | None
) -> DataFrame:
    """The live version of every ``dt=`` batch of a snapshot table, as one
    scan; ``dt`` comes from each file's path. With a date, only that batch's
    pointer is resolved."""
    root = table_root.rstrip("/")
    if execution_date is not None:
        dates = [execution_date]
    else:
        dates = [name[3:] for name in fs.list_dirs(spark, root) if name.startswith("dt=")]
    paths = []
    for d in sorted(dates):
        version = snapshot.current_version(spark, f"{root}/dt={d}")
        if version is not None:
            paths.append(snapshot.version_path(f"{root}/dt={d}", version))
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no published batch under {table_root}")
        return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField("dt", T.DateType(), True)]))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*paths)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/dt=([^/]+)/versions/", 1)
    return df.withColumn("dt", day.cast(T.DateType()))


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read a published batch; a missing one is an empty frame of ``schema``."""
    fmt = table_format(spark, fmt)
    present = (
        snapshot.current_version(spark, path) is not None
        if fmt == "snapshot"
        else fs.has_data(spark, path)
    )
    if not present:
        return spark.createDataFrame([], schema)
    return read_batch(spark, path, fmt, schema=schema)


def write_batch(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` to ``path`` with Spark's commit protocol (task retries safe)."""
    fmt = fmt.lower()
    opts = dict(options or {})
    writer = df.write.mode(mode)
    if fmt == "csv":
        opts.setdefault("header", "true")
        writer.options(**opts).csv(path)
    elif fmt == "json":
        writer.options(**opts).json(path)
    elif fmt == "delta":
        writer.options(**opts).format("delta").save(path)
    elif fmt in ("parquet", "snapshot"):
        writer.options(**opts).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
