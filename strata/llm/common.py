"""Helpers shared by the operators: written intermediate tables, word hashes,
connected components.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir``
(``strata.session.scratch_path``): a lost executor then costs the tasks it
ran, not the whole lineage, and a table that is read twice is computed once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import fs

# A word is a run of anything but these six bytes (a fixed rule of the contracts).
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of one Arrow batch: texts can be long, so batches are kept short.
BATCH_ROWS = 512
# Bytes hashed at once; bounds the temporary arrays of a task.
HASH_CHUNK = 1 << 17
# Rows of a batch worked on at once where each gives arrays many times its size.
PIECE_ROWS = 128

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            fs.delete(df.sparkSession, path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it: no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that tasks exchange with Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def in_pieces(it: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, for arrays that take many times a batch."""
    for batch in it:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def clean_select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, cast; clashing extra columns stay out of the way."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser over unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {False: _byte_values(False), True: _byte_values(True)}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def _grow_powers(n: int) -> None:
    global _powers, _inverse_powers
    if len(_powers) >= n:
        return
    size = max(n, HASH_CHUNK + 4096)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        step = np.full(size, _BASE, dtype=np.uint64)
        step[0] = 1
        _powers = np.cumprod(step, dtype=np.uint64)
        step[1:] = inverse
        _inverse_powers = np.cumprod(step, dtype=np.uint64)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its row offsets (null: no bytes)."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or rows[-1] == rows[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[rows[0] : rows[-1]], rows - rows[0]


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows, and each row's offsets into them.

    A word's hash is a polynomial over its bytes modulo 2**64 (each byte first
    replaced by a random 64-bit value), taken from one running sum per chunk;
    chunks end between words, so a text of any length is hashed whole.
    """
    buf, rows = text_buffer(texts)
    n = len(buf)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(rows), dtype=np.int64)
    space = _IS_SPACE[buf]
    fresh = np.ones(n, dtype=bool)  # nothing of the same word stands before this byte
    fresh[1:] = space[:-1]
    fresh[rows[:-1][rows[:-1] < n]] = True
    starts = np.flatnonzero(fresh & ~space)
    last = np.ones(n, dtype=bool)
    last[:-1] = fresh[1:] | space[1:]
    ends = np.flatnonzero(last & ~space)  # inclusive
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(starts):
            base = starts[k]
            m = max(k + 1, int(np.searchsorted(ends, base + HASH_CHUNK)))
            stop = ends[m - 1] + 1
            _grow_powers(stop - base + 1)
            sums = np.zeros(stop - base + 1, dtype=np.uint64)
            np.cumsum(_VALUES[lower][buf[base:stop]] * _powers[: stop - base], out=sums[1:])
            s, e = starts[k:m] - base, ends[k:m] - base + 1
            out[k:m] = (sums[e] - sums[s]) * _inverse_powers[s] + (e - s).astype(np.uint64)
            k = m
    return mix64(out), np.searchsorted(starts, rows).astype(np.int64)


def shingle_sets(texts: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row, ascending, with row offsets.

    A row of fewer than k words but at least one gives one shingle, its whole
    word sequence; a row without words none.
    """
    words, offs = word_hashes(texts, lower)
    counts = np.diff(offs)
    rows = len(counts)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    row_of = np.repeat(np.arange(rows), n)
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    at = offs[:-1][row_of] + (np.arange(len(row_of)) - first[row_of])
    padded = np.concatenate((words, np.zeros(k, dtype=np.uint64)))
    have = np.minimum(counts, k)[row_of]
    total = np.zeros(len(row_of), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            part = padded[at + j] * np.uint64((0xA0761D6478BD642F + 2 * j * 0xE7037ED1A0B428DB) % (1 << 64) | 1)
            total = mix64(total + np.where(j < have, part, np.uint64(0)) + np.uint64(j + 1))
    if not len(total):
        return total, np.zeros(rows + 1, dtype=np.int64)
    order = np.lexsort((total, row_of))
    total, row_of = total[order], row_of[order]
    keep = np.ones(len(total), dtype=bool)
    keep[1:] = (total[1:] != total[:-1]) | (row_of[1:] != row_of[:-1])
    total, row_of = total[keep], row_of[keep]
    return total, np.searchsorted(row_of, np.arange(rows + 1)).astype(np.int64)


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Smallest reachable node of every node of an edge list ``(a, b)``.

    Hook and contract: each node points to its smallest neighbour, pointers
    are followed once, edges are rewritten to the nodes pointed to and loops
    dropped, until none is left. Every round is a few shuffles over a
    shrinking edge list, written to the shared folder; no component is ever
    held by one task or the driver. Returns ``(node, component)``.
    """
    edges = written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(),
        f"{name}-edges",
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(nodes.withColumn("component", F.col("node")), f"{name}-labels")
    while not edges.isEmpty():
        hook = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("p"))
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        before = (labels, edges)
        hook = written(
            hook.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p")), f"{name}-hook"
        )
        labels = written(
            labels.join(hook, labels.component == hook.u, "left").select(
                "node", F.coalesce("p", "component").alias("component")
            ),
            f"{name}-labels",
        )
        ha = hook.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        hb = hook.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        moved = (
            edges.join(ha, "a", "left")
            .join(hb, "b", "left")
            .select(F.coalesce("pa", "a").alias("x"), F.coalesce("pb", "b").alias("y"))
        )
        edges = written(
            moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(),
            f"{name}-edges",
        )
        forget(hook, *before)
    forget(edges)
    return labels


def n_words(text: Column) -> Column:
    """Words of a text (null: 0), JVM-side: pieces between space runs."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     "))
    return F.when(F.length(flat) == 0, F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, for range reads in tasks."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path)
