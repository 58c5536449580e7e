"""Snapshot tables: whole-table replace with a consistent read version.

Used for the silver layer when the ``delta`` data source is not on the
class path. Layout of one table::

    <table>/versions/<run_id>/part-*.parquet   one folder per write
    <table>/_CURRENT-<number>                  text: a published version id

A write goes to a new version folder; publishing adds the pointer with the
next number and deletes nothing. Readers take the highest number (a pointer
whose text is still being written counts as not there), so at any moment they
see either the old or the new version, never none and never a mix. Old versions
stay until they are removed by hand. Of two publishers that take the same
number one gets it, the other fails and its version stays unpublished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import fs

POINTER = "_CURRENT"


def version_path(table_path: str, version: str) -> str:
    return f"{table_path.rstrip('/')}/versions/{version}"


def _pointers(spark: SparkSession, table_path: str) -> list[str]:
    names = [n for n in fs.list_files(spark, table_path) if n.startswith(f"{POINTER}-")]
    return sorted(names)


def current_version(spark: SparkSession, table_path: str) -> str | None:
    for name in reversed(_pointers(spark, table_path)):
        text = fs.read_text(spark, f"{table_path.rstrip('/')}/{name}")
        if text and text.strip():
            return text.strip()
    return None


class PublishConflict(RuntimeError):
    """Another publisher took the number of this version's pointer."""


def publish(spark: SparkSession, table_path: str, version: str) -> None:
    found = _pointers(spark, table_path)
    number = int(found[-1].rsplit("-", 1)[1]) + 1 if found else 0
    try:
        fs.write_text(spark, f"{table_path.rstrip('/')}/{POINTER}-{number:012d}", version, False)
    except FileExistsError as err:
        raise PublishConflict(f"{table_path}: version {version} lost number {number} to another publisher") from err


def read_snapshot(
    spark: SparkSession, table_path: str, schema: T.StructType | None = None
) -> DataFrame:
    version = current_version(spark, table_path)
    if version is None:
        raise FileNotFoundError(f"no published snapshot at {table_path}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(version_path(table_path, version))
