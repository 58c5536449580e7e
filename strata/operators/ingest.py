"""Direct ingestion: a landing batch copied as-is with lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import source_file_name


def with_lineage(
    df: DataFrame,
    domain: str,
    source_file: str | Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """``*, _ingested_at, _domain, _source_file``.

    ``_source_file`` defaults to the base name of the file each row came
    from (the hidden ``_metadata`` column of file sources).
    """
    if source_file is None:
        file_col = source_file_name()
    elif isinstance(source_file, str):
        file_col = F.lit(source_file)
    else:
        file_col = source_file
    return df.select(
        "*",
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit(domain).alias("_domain"),
        file_col.alias("_source_file"),
    )
