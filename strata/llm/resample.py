"""Importance resampling towards a target distribution over hashed n-grams.

Two passes over the texts. In each, a task joins the texts of an Arrow batch
with a separator, finds all words in one regular-expression pass, and gives
every word its document by searching the documents' offsets; runs of words
that cross a document are masked out. The first pass counts hashed runs of
both tables, task by task, and Spark sums the buckets; the log-ratio of a
bucket (a table of fixed size) is its gain. The second pass sums the gains of
each document. Gumbel noise of a keyed hash turns the highest scores into a
draw without replacement.

A run's bucket is the CRC-32 of its bytes. CRCs of runs come from those of the
batch's distinct words: appending k bytes acts on a CRC as a linear map that
depends on k alone, kept as four tables of 256 entries.

The ranks need no global sort in one task: rows are dealt by range of (score,
id), ranges are counted, and only the ranges that the draw reaches are ordered.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import clean_select, short_batches, written

BUCKETS = 10_000
RUN = 3  # words of the longest feature
SEPARATOR = b"\x00"  # no word holds it
# Fixed value of the contract, on the bytes of a text in lower case: letters,
# digits and all bytes of code points above 127.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SLICE = 1 << 19  # words hashed at once; bounds the temporary arrays of a task


def _crc_of_byte() -> np.ndarray:
    """What the register becomes for each value of its low byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


def _moved(tables: np.ndarray, crc: np.ndarray, which: np.ndarray | int = 0) -> np.ndarray:
    """CRCs after the appended zero bytes that ``tables[which]`` stand for."""
    return (
        tables[which, 0, crc & 255]
        ^ tables[which, 1, (crc >> np.uint32(8)) & 255]
        ^ tables[which, 2, (crc >> np.uint32(16)) & 255]
        ^ tables[which, 3, crc >> np.uint32(24)]
    )


@lru_cache(maxsize=4096)
def _append(length: int) -> np.ndarray:
    """Tables of the map that ``length`` appended bytes apply to a CRC."""
    if length <= 1:
        each = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
        return each if length == 0 else _crc_of_byte()[each & 255] ^ (each >> np.uint32(8))
    half = _append(length // 2)
    out = _moved(half[None], half)
    return _moved(_append(1)[None], out) if length % 2 else out


class Runs:
    """Words of a batch of texts, and the buckets of their runs."""

    def __init__(self, texts: pa.Array):
        parts = [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]
        self.rows = len(parts)
        joined = SEPARATOR.join(parts).lower()  # bytes: lowers A-Z alone
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]]) if parts else np.zeros(0, np.int64)
        spans = np.fromiter(
            itertools.chain.from_iterable(m.span() for m in WORDS.finditer(joined)), dtype=np.int64
        ).reshape(-1, 2)
        self.doc = np.searchsorted(starts, spans[:, 0], side="right") - 1
        self.words = np.bincount(self.doc, minlength=self.rows)
        inside = np.zeros(len(joined) + 1, dtype=np.int8)
        inside[spans[:, 0]] += 1
        inside[spans[:, 1]] -= 1
        data = np.frombuffer(joined, dtype=np.uint8)[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(spans[:, 1] - spans[:, 0])))
        binary = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(spans), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        ).dictionary_encode()
        self.code = binary.indices.to_numpy(zero_copy_only=False)
        distinct = binary.dictionary.to_pylist()
        crcs = [zlib.crc32(w) for w in distinct]
        self.crc = np.array(crcs, dtype=np.uint32)
        self.spaced = np.array([zlib.crc32(b" ", c) for c in crcs], dtype=np.uint32)
        lengths = np.array([len(w) for w in distinct], dtype=np.int64)
        sizes, self.size_of = np.unique(lengths, return_inverse=True)
        none = np.zeros((0, 4, 256), dtype=np.uint32)
        self.by_word = np.stack([_append(int(n)) for n in sizes]) if len(sizes) else none
        self.by_spaced = np.stack([_append(int(n) + 1) for n in sizes]) if len(sizes) else none

    def features(self, buckets: int, longest: int = RUN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Document and bucket of every run of 1 to ``longest`` words."""
        for a in range(0, len(self.code), SLICE):
            b = min(a + SLICE, len(self.code))
            c = self.code[a:b]
            yield self.doc[a:b], self.crc[c] % np.uint32(buckets)
            before = self.spaced[c]  # CRC of the words so far and a space
            for k in range(1, longest):
                m = min(b, len(self.code) - k) - a  # runs that start in this slice and end in the batch
                if m <= 0:
                    break
                nxt = self.code[a + k : a + k + m]
                size = self.size_of[nxt]
                run = _moved(self.by_word, before[:m], size) ^ self.crc[nxt]
                whole = self.doc[a : a + m] == self.doc[a + k : a + k + m]
                yield self.doc[a : a + m][whole], run[whole] % np.uint32(buckets)
                before = _moved(self.by_spaced, before[:m], size) ^ self.spaced[nxt]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = RUN) -> np.ndarray:
    """Runs of words of the column ``text`` in every bucket."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in it:
            for _, found in Runs(batch.column(0)).features(buckets, longest):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = clean_select(texts, {"text": "string"}).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # as many rows as buckets
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log-ratio of each bucket, in thousandths, rounded down."""
    size = len(source)
    s, t = float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(b) + 1) * (s + size) / ((float(a) + 1) * (t + size))))
            for a, b in zip(source.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    buckets: int = BUCKETS,
    longest: int = RUN,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` for every row of
    ``docs`` (``doc_id, text``), drawn towards the texts of ``target``
    (``text``): ``rank`` is 1, 2, ... over the ``percent`` % of the rows with
    ``least_words`` words or more that score highest (the share rounded down),
    ties by smaller id, and null elsewhere.

    Null and empty texts hold no feature: weight 0, never drawn. Every row is
    counted, scored and ranked by itself, repeated rows too; rows of the same
    score and id rank in order of their features, and equal rows in any order.
    A null id is hashed as the empty string and ranks behind equal scores. An
    empty ``docs`` gives no rows, an empty ``target`` gains from smoothing
    alone. Texts of any length are used whole. Extra columns are ignored.
    """
    spark = docs.sparkSession
    short_batches(spark)
    gain = spark.sparkContext.broadcast(
        gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    )

    def weigh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            runs = Runs(batch.column(1))
            n = np.zeros(runs.rows, dtype=np.int64)
            weight = np.zeros(runs.rows, dtype=np.int64)
            for doc, found in runs.features(buckets, longest):
                n += np.bincount(doc, minlength=runs.rows)
                # sums of whole numbers far below 2**53: exact in doubles
                weight += np.bincount(doc, weights=gain.value[found], minlength=runs.rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(weight), pa.array(runs.words)],
                names=["doc_id", "n_features", "weight", "n_words"],
            )

    rows = clean_select(docs, {"doc_id": "long", "text": "string"})
    weighed = rows.mapInArrow(weigh, "doc_id long, n_features long, weight long, n_words long")
    scored = written(
        weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "resample-scored",
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    fit = scored.where(F.col("n_words") >= least_words)
    ranged = written(
        fit.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resample-ranged"
    )
    ahead, before = 0, []
    for part, n in sorted(ranged.groupBy("part").count().collect()):  # one row per shuffle partition
        before.append((part, ahead))
        ahead += n
    drawn = percent * ahead // 100
    reached = [(part, n) for part, n in before if n < drawn]
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    no_rank = F.lit(None).cast("long").alias("rank")
    last = max((part for part, _ in reached), default=-1)
    others = scored.where(F.col("n_words") < least_words).drop("row").union(
        ranged.where(F.col("part") > last).drop("row", "part")
    )
    others = others.withColumn("rank", no_rank).select(*columns)
    if not reached:
        return others
    ahead_of = spark.createDataFrame(reached, "part int, ahead long")
    placed = ranged.where(F.col("part") <= last).join(F.broadcast(ahead_of), "part")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("ahead")
    placed = placed.withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.select(*columns).union(others)
