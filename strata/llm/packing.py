"""Best-fit packing of documents into sequences, improved by local search.

Documents are tokenized where they lie; only piece lengths and checksums move.
Pieces that fill a sequence are sequences of their own. The others are dealt
evenly over groups of bounded size; each group is packed best-fit decreasing
and then searched locally: the emptiest bin gives documents to fuller bins by
moving one, exchanging one for one or two for one, always so that the sum of
squared fills grows, until it is empty or nothing improves. Bins that stay
visibly underfull in their groups are opened again and packed together in the
same way, so the groups' remainders do not add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import clean_select, short_batches, written
from strata.llm.tokens import CAPACITY, END_ID, default_tokenizer, pieces

GROUP_PIECES = 16384  # pieces packed together in one task
REOPEN_BELOW = 0.97  # bins filled less than this share meet those of other groups

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each into the fullest bin that takes it.

    Open bins are kept by free space; the set of free spaces in use is one
    integer, whose lowest bit at or above a length is the best fit.
    """
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = used >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                used &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > n:
            free[room - n].append(b)
            used |= 1 << (room - n)
    return bins


def _offers(own: list[int], lengths: np.ndarray) -> list[list[int]]:
    """One or two documents of a bin, one choice for every total length, which
    alone decides what an exchange brings."""
    by_length = {int(lengths[i]): i for i in reversed(own)}
    twice = {int(n): [i for i in own if lengths[i] == n][:2] for n in by_length}
    totals: dict[int, list[int]] = {n: [i] for n, i in by_length.items()}
    several = sorted(by_length)
    for k, a in enumerate(several):
        if len(twice[a]) == 2:
            totals.setdefault(2 * a, twice[a])
        for b in several[k + 1 :]:
            totals.setdefault(a + b, [by_length[a], by_length[b]])
    return [totals[n] for n in sorted(totals)]


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty bins by exchanges that raise the sum of squared fills.

    The emptiest bin is tried first. One that cannot be emptied is left as the
    exchanges made it, and the next one is tried; the search ends at the least
    number of bins that can hold the total, or after a round over all underfull
    bins that empties none."""
    bins = [list(b) for b in bins]
    of = np.empty(len(lengths), dtype=np.int64)
    fill = np.zeros(len(bins), dtype=np.int64)
    for k, b in enumerate(bins):
        of[b] = k
        fill[k] = lengths[b].sum()
    alive = np.ones(len(bins), dtype=bool)
    least = -(-int(lengths.sum()) // capacity)

    def put(i: int, to: int) -> None:
        bins[of[i]].remove(i)
        fill[of[i]] -= lengths[i]
        of[i] = to
        bins[to].append(i)
        fill[to] += lengths[i]

    failed = np.zeros(len(bins), dtype=bool)  # in this round
    while alive.sum() > least:
        open_bins = np.flatnonzero(alive & ~failed & (fill < capacity))
        if not len(open_bins):
            break
        j = int(open_bins[np.argmin(fill[open_bins])])
        while bins[j]:
            gap = np.where(alive, capacity - fill, 0)
            gap[j] = 0
            gap[fill < fill[j]] = 0  # growth of the squared fill: only into fuller bins
            if not gap.any():
                break
            best: tuple[int, list[int], int | None, int] | None = None
            for i in sorted(bins[j], key=lambda i: -lengths[i]):  # move
                fits = np.flatnonzero(gap >= lengths[i])
                if len(fits):
                    best = (int(lengths[i]), [i], None, int(fits[np.argmin(gap[fits])]))
                    break
            if best is None:  # one for one, then two for one, with documents of bins that have room
                others = np.flatnonzero(gap[of] > 0)
                room, size = gap[of[others]], lengths[others]
                for offer in _offers(bins[j], lengths):
                    gain = int(lengths[offer].sum()) - size
                    ok = (gain > 0) & (gain <= room)
                    if ok.any():
                        x = int(np.argmax(np.where(ok, gain, 0)))
                        if best is None or gain[x] > best[0]:
                            best = (int(gain[x]), offer, int(others[x]), int(of[others[x]]))
            if best is None:
                break
            _, offer, back, to = best
            if back is not None:
                put(back, j)
            for i in offer:
                put(i, to)
        if bins[j]:
            failed[j] = True
        else:
            alive[j] = False
            failed[:] = False
    return [b for k, b in enumerate(bins) if alive[k] and b]


def _pack_partition(capacity: int):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(it)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        if not len(rows):
            return
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = rows["length"].to_numpy(dtype=np.int64)
        bins = local_search(best_fit_decreasing(lengths, capacity), lengths, capacity)
        rows["bin"], rows["offset"], rows["fill"] = 0, 0, 0
        at, off, fill = (np.empty(len(rows), dtype=np.int64) for _ in range(3))
        for k, b in enumerate(bins):
            ends = np.cumsum(lengths[b])
            at[b], off[b], fill[b] = k, ends - lengths[b], ends[-1]
        yield rows.assign(bin=at, offset=off, fill=fill)

    return run


def _packed(rows: DataFrame, capacity: int, group: int, name: str) -> DataFrame:
    groups = max(1, -(-rows.count() // group))
    spread = rows.repartition(groups).withColumn("group", F.spark_partition_id().cast("long"))
    schema = f"{_PIECES}, group long, bin long, offset long, fill long"
    return written(spread.mapInPandas(_pack_partition(capacity), schema), name)


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: where it starts, its length and
    the crc32 of its ids (unsigned, little-endian 32-bit)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = [
                (doc, k, start, len(ids), zlib.crc32(ids.tobytes()))
                for doc, k, start, ids in pieces(batch, tokenizer, capacity, end_id)
            ]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    short_batches(docs.sparkSession)
    return clean_select(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, _PIECES)


def best_fit_pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group: int = GROUP_PIECES,
) -> DataFrame:
    """Every piece of every row of ``docs`` (``doc_id, text``) with its place:
    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null or empty text is a document of one closing id. Only documents over
    the capacity are cut. Repeated rows and null ids are documents of their
    own; extra columns are ignored; an empty table gives an empty one.
    """
    tokenizer = tokenizer or default_tokenizer()
    rows = written(tokenized_pieces(docs, tokenizer, capacity, end_id), "pack-pieces")
    first = _packed(rows.where(F.col("length") < capacity), capacity, group, "pack-first")
    again = F.col("fill") < REOPEN_BELOW * capacity
    names = [f.strip().split()[0] for f in _PIECES.split(",")]
    second = _packed(first.where(again).select(names), capacity, group, "pack-second")

    def placed(df: DataFrame, sequence, offset, kind: int) -> DataFrame:
        return df.select(*names, (sequence * 3 + kind).alias("sequence_id"), offset.alias("offset"))

    # a group may hold more than ``group`` pieces, so its bins get 32 bits
    number = F.shiftleft("group", 32) + F.col("bin")
    whole = rows.where(F.col("length") == capacity)
    return (
        placed(whole, F.monotonically_increasing_id(), F.lit(0).cast("long"), 0)
        .union(placed(first.where(~again), number, F.col("offset"), 1))
        .union(placed(second, number, F.col("offset"), 2))
    )
