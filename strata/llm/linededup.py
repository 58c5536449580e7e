"""Line dedup by site-relative frequency.

A line is boilerplate on a host when the share of the host's pages that hold
it exceeds a ratio. Pages are counted per (host, line) with map-side partial
sums over 64-bit line hashes, so only one small row per distinct line and
task is shuffled, and a host with a third of all pages is spread over its
lines. The flagged lines of a host are few: at most (lines per page) / ratio.
They become one array per host, and pages meet it by host: the table of arrays
is written first, so Spark knows its size and broadcasts it while it is small,
and texts stay where they are; beyond that it is a merge join that splits hosts
with many pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

RATIO = 0.1  # a line on more than this share of a host's pages goes
MIN_PAGES = 5  # and on at least this many of them, so that small hosts lose nothing by chance
_BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_BLANK)))


def drop_site_lines(
    pages: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text``, one row per row.

    Lines are split at line feeds and compared without blanks, tabs and
    carriage returns at either end; blank lines are never boilerplate. A line
    counts once per page, repeated rows count each. Adds ``lines_dropped`` (in
    place of a column of that name).
    Pages of unknown host (null) belong to no site and stay as they are; so
    do null and empty texts. A page of which every line goes keeps its row
    with an empty text. ``key`` need not be unique or non-null.
    """
    names = pages.columns
    k, h, t = (F.col(f"`{c}`") for c in (key, host, text))
    known = pages.where(h.isNotNull() & t.isNotNull() & (F.length(t) > 0))
    hashes = F.array_distinct(
        F.transform(F.filter(_lines(t), lambda x: F.length(F.btrim(x, F.lit(_BLANK))) > 0), _line_key)
    )
    lines = known.select(k.alias("_k"), h.alias("_h"), F.explode(hashes).alias("_line"))
    totals = pages.where(h.isNotNull()).groupBy(h.alias("_h")).agg(F.count("*").alias("_pages"))
    often = lines.groupBy("_h", "_line").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_pages)
    flagged = written(
        often.join(totals, "_h").where(F.col("_n") > F.lit(ratio) * F.col("_pages")).select("_h", "_line"),
        "site-lines",
    )
    drops = written(
        flagged.groupBy("_h").agg(F.collect_set("_line").alias("drop")).withColumnRenamed("_h", "host"), "site-drops"
    )
    # the page's own columns in one struct: no name of theirs can clash
    page = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("page"))
    own = F.col(f"page.`{text}`")
    joined = page.join(drops, F.col(f"page.`{host}`") == F.col("host"), "left")
    gone = lambda x: F.array_contains(F.col("drop"), _line_key(x))
    kept = F.filter(_lines(own), lambda x: ~gone(x))
    out = joined.withColumn("kept", F.when(F.col("drop").isNotNull() & (F.length(own) > 0), kept))
    lost = F.coalesce(F.size(_lines(own)) - F.size("kept"), F.lit(0)).cast("long")
    return out.select(
        *[
            F.when(lost > 0, F.array_join("kept", "\n")).otherwise(own).alias(c) if c == text else F.col(f"page.`{c}`").alias(c)
            for c in names
            if c != "lines_dropped"
        ],
        lost.alias("lines_dropped"),
    )


def oracle(documents: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """DuckDB SQL for ``drop_site_lines`` over ``documents`` with unique ids:
    a query of all its columns with the text rewritten, plus lines_dropped."""
    key = "trim(x, ' ' || chr(9) || chr(13))"
    return f"""
        SELECT doc_id,
               CASE WHEN dropped > 0 THEN array_to_string(kept, chr(10)) ELSE text END AS text,
               lang, source, n_chars, dropped AS lines_dropped
        FROM (
          SELECT d.*, list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(g.gone, []), {key})) AS kept,
                 coalesce(len(string_split(text, chr(10))) - len(list_filter(string_split(text, chr(10)),
                     lambda x: NOT list_contains(coalesce(g.gone, []), {key}))), 0) AS dropped
          FROM {documents} d LEFT JOIN (
            SELECT source AS host, list(line) AS gone FROM (
              SELECT source, line, count(*) AS n FROM (
                SELECT source, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: {key}))) AS line
                FROM {documents} WHERE source IS NOT NULL AND text IS NOT NULL)
              WHERE line <> '' GROUP BY source, line)
            JOIN (SELECT source, count(*) AS pages FROM {documents} WHERE source IS NOT NULL GROUP BY source) USING (source)
            WHERE n >= {min_pages} AND n > CAST({ratio} AS DOUBLE) * pages
            GROUP BY source) g ON d.source = g.host)"""
