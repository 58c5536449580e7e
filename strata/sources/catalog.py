"""Declared external sources: names bound to locations, resolved when used.

A declaration lists schemas and their tables, each with a location pattern
(path placeholders as in ``strata.sources.paths``), optionally a format and
columns::

    {"sources": [{"schema": "silver", "tables": [
        {"name": "sales_silver",
         "external_location": "{{ root }}/silver/sales/dt={{ execution_date }}",
         "format": "snapshot",
         "columns": [{"name": "id", "data_type": "bigint"}]}]}]}

Nothing is read until a table is asked for. Without a format the location
decides: a published snapshot is read at its live version, a folder of ``dt=``
batches as one table with its ``dt`` column, files by their suffix, all else
as Parquet. Declared columns are checked when a table is bound: a missing
column or another type fails there, by name, not later inside a query.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import fs, snapshot
from strata.sources.io import read_batch, read_table, table_format
from strata.sources.paths import render_path


class UnknownSource(KeyError):
    pass


class SourceMismatch(ValueError):
    """A bound source does not have its declared columns."""


@dataclass(frozen=True)
class SourceTable:
    schema: str
    name: str
    location: str
    format: str | None = None
    columns: tuple[tuple[str, str], ...] = ()
    options: Mapping[str, str] = field(default_factory=dict, compare=False, hash=False)

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def view(self) -> str:
        return f"{self.schema}__{self.name}"


def _table(schema: str, spec: Mapping[str, object]) -> SourceTable:
    location = spec.get("external_location") or (spec.get("meta") or {}).get("external_location")
    if not location:
        raise ValueError(f"{schema}.{spec.get('name')}: no external_location")
    columns = tuple((str(c["name"]), str(c.get("data_type") or "")) for c in spec.get("columns") or [])
    return SourceTable(schema, str(spec["name"]), str(location), spec.get("format"), columns, dict(spec.get("options") or {}))


@dataclass(frozen=True)
class SourceCatalog:
    tables: tuple[SourceTable, ...]
    variables: Mapping[str, str] = field(default_factory=dict, compare=False, hash=False)

    @classmethod
    def from_json(cls, text: str, **variables: str) -> SourceCatalog:
        """Declarations as JSON text; ``variables`` fill placeholders other
        than the execution date."""
        tables = [
            _table(str(source.get("schema") or source["name"]), spec)
            for source in json.loads(text)["sources"]
            for spec in source.get("tables") or []
        ]
        names = [t.full_name for t in tables]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"declared twice: {', '.join(twice)}")
        return cls(tuple(tables), dict(variables))

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, **variables: str) -> SourceCatalog:
        text = fs.read_text(spark, path)
        if text is None:
            raise FileNotFoundError(path)
        return cls.from_json(text, **variables)

    def __getitem__(self, full_name: str) -> SourceTable:
        for t in self.tables:
            if t.full_name == full_name:
                return t
        raise UnknownSource(f"{full_name} is not declared; declared: {', '.join(t.full_name for t in self.tables)}")

    def location(self, full_name: str, execution_date: str) -> str:
        """The location with its placeholders filled; the date may also be
        written as ``{{ var('execution_date') }}``."""
        pattern = re.sub(r"\{\{\s*var\(\s*['\"](\w+)['\"]\s*\)\s*\}\}", r"{{ \1 }}", self[full_name].location)
        return render_path(pattern, execution_date, **self.variables)

    def read(self, spark: SparkSession, full_name: str, execution_date: str) -> DataFrame:
        """The declared table as a frame, its columns checked."""
        source = self[full_name]
        path = self.location(full_name, execution_date)
        df = _read(spark, path, source)
        _check(source, df.schema, path)
        return df

    def used_in(self, text: str) -> list[SourceTable]:
        """Declared tables that a SQL text names as ``schema.table``."""
        return [t for t in self.tables if _named(t).search(text)]

    def sql(self, spark: SparkSession, text: str, execution_date: str, args: Mapping[str, object] | None = None) -> DataFrame:
        """Run SQL over declared tables. Only those it names are bound, each
        as a temporary view that carries its schema's name."""
        for t in self.used_in(text):
            self.read(spark, t.full_name, execution_date).createOrReplaceTempView(t.view)
            text = _named(t).sub(t.view, text)
        return spark.sql(text, args=dict(args) if args else None)


def _named(t: SourceTable) -> re.Pattern[str]:
    return re.compile(rf"(?<![\w.`]){re.escape(t.schema)}\.{re.escape(t.name)}(?![\w`])")


def _read(spark: SparkSession, path: str, source: SourceTable) -> DataFrame:
    root = path.rstrip("/")
    fmt = source.format
    if fmt is None:
        suffix = root.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
        live = snapshot.current_version(spark, root) is not None
        fmt = "snapshot" if live else suffix if suffix in ("csv", "json") else "parquet"
    fmt = table_format(spark, fmt)
    if any(name.startswith("dt=") for name in fs.list_dirs(spark, root)):
        batches = [f"{root}/{n}" for n in fs.list_dirs(spark, root) if n.startswith("dt=")]
        if source.format is None and any(snapshot.current_version(spark, b) is not None for b in batches):
            fmt = "snapshot"
        return read_table(spark, root, fmt)
    return read_batch(spark, root, fmt, options=source.options)


def _check(source: SourceTable, found: T.StructType, path: str) -> None:
    have = {f.name: f.dataType for f in found.fields}
    wrong = []
    for name, declared in source.columns:
        if name not in have:
            wrong.append(f"{name} is missing")
        elif declared and have[name] != T._parse_datatype_string(declared):
            wrong.append(f"{name} is {have[name].simpleString()}, declared {declared}")
    if wrong:
        raise SourceMismatch(f"{source.full_name} at {path}: {'; '.join(wrong)}")
