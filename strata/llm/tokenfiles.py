"""Packed token-id files: best-fit-decreasing with a segment tree.

Each task tokenizes the documents it reads, cuts overlong ones without losing
an id, and packs a window of bounded size: pieces longest first, each into the
open row with the least sufficient free space. The open rows are counted in a
segment tree over free space, so the search takes log2(capacity) steps. The
window is written to the shared folder as a matrix of ids (little-endian,
16 bits when the vocabulary allows); nothing is shuffled.

A second matrix of the same shape holds the position ids: they start at 0
again in every segment, and padding has 0.

The manifest, a Parquet table, has one row per matrix row: both files, row, the
cumulative segment lengths (0, l1, l1 + l2, ..), where positions start again
and the segments' documents; places after the last segment are padding. Files get names of their own per attempt
and only manifests of finished tasks are kept, so a task that is run again
after a lost executor leaves at most an unreferenced file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import clean_select, file_system, short_batches, written
from strata.llm.tokens import CAPACITY, END_ID, default_tokenizer, pieces
from strata.session import scratch_path

WINDOW_TOKENS = 1 << 22  # ids packed and written together by a task
_MANIFEST = (
    "file string, positions string, row long, cu_seqlens array<int>, resets array<int>,"
    " doc_ids array<long>, pieces array<int>, starts array<long>"
)
_SCHEMA = pa.schema(
    [
        ("file", pa.string()), ("positions", pa.string()), ("row", pa.int64()), ("cu_seqlens", pa.list_(pa.int32())),
        ("resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
    ]
)


class FreeSpaceTree:
    """Open rows by free space: least free space of at least n, in log steps."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._step(free, 1)

    def _step(self, free: int, by: int) -> None:
        node = self.size + free
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free space, row) of the best fit, taken out; None if none fits."""
        node = self.size + need
        while not self.count[node]:
            while node & 1:  # no right neighbour below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not self.count[node]:
                node += 1
        free = node - self.size
        self._step(free, -1)
        return free, self.rows[free].pop()


def pack_rows(lengths: list[int], capacity: int) -> list[list[int]]:
    tree, rows = FreeSpaceTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found:
            free, row = found
        else:
            free, row = capacity, len(rows)
            rows.append([])
        rows[row].append(i)
        if free > lengths[i]:
            tree.add(free - lengths[i], row)
    return rows


def write_packed(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    folder: str | None = None,
    wide: bool = False,
    window: int = WINDOW_TOKENS,
) -> DataFrame:
    """Write all rows of ``docs`` (``doc_id, text``) and return the manifest.

    Null or empty text: one closing id. Repeated rows and null ids are
    documents of their own; extra columns are ignored; an empty table gives
    an empty manifest. ``wide``: 32-bit ids.
    """
    spark = docs.sparkSession
    short_batches(spark)
    tokenizer = tokenizer or default_tokenizer()
    folder = folder or scratch_path(spark, "token-files")
    dtype = np.dtype("<u4" if wide else "<u2")

    def flush(held: list) -> pa.RecordBatch:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        stamp = uuid.uuid4().hex
        name, places = f"ids-{stamp}.bin", f"positions-{stamp}.bin"
        out = []
        with fs.open_output_stream(f"{root}/{name}") as f, fs.open_output_stream(f"{root}/{places}") as g:
            for r, items in enumerate(pack_rows([len(x[3]) for x in held], capacity)):
                line = np.full(capacity, end_id, dtype=dtype)
                ends = [0]
                for i in items:
                    ids = held[i][3]
                    line[ends[-1] : ends[-1] + len(ids)] = ids
                    ends.append(ends[-1] + len(ids))
                f.write(line.tobytes())
                g.write(position_ids(ends, capacity).astype(dtype).tobytes())
                out.append(
                    {"file": f"{folder}/{name}", "positions": f"{folder}/{places}", "row": r, "cu_seqlens": ends,
                     "resets": ends[:-1], "doc_ids": [held[i][0] for i in items],
                     "pieces": [held[i][1] for i in items], "starts": [held[i][2] for i in items]}
                )
        return pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for batch in it:
            for piece in pieces(batch, tokenizer, capacity, end_id):
                held.append(piece)
                tokens += len(piece[3])
                if tokens >= window:
                    yield flush(held)
                    held, tokens = [], 0
        if held:
            yield flush(held)

    rows = clean_select(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, _MANIFEST)
    return written(rows, "token-manifest")


def read_packed(manifest: DataFrame, capacity: int = CAPACITY, wide: bool = False) -> DataFrame:
    """The segments of all files, read back by row: ``file, row, segment,
    doc_id, piece, start, offset, length, ids_crc32`` (of 32-bit ids) and
    ``reset``, the place where the positions read start at 0 and count to the
    segment's end; files whose positions don't are damaged and raise."""
    dtype = np.dtype("<u4" if wide else "<u2")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f, g = None, None, None
        size = capacity * dtype.itemsize
        for batch in it:
            out = []
            for m in batch.to_pylist():
                if m["file"] != name:
                    name = m["file"]
                    fs, path = file_system(name)
                    f = fs.open_input_file(path)
                    fs, path = file_system(m["positions"])
                    g = fs.open_input_file(path)
                line = np.frombuffer(f.read_at(size, m["row"] * size), dtype=dtype)
                places = np.frombuffer(g.read_at(size, m["row"] * size), dtype=dtype)
                if not np.array_equal(places, position_ids(m["cu_seqlens"], capacity)):
                    raise ValueError(f"damaged positions: {m['positions']}, row {m['row']}")
                for k, (a, b) in enumerate(zip(m["cu_seqlens"], m["cu_seqlens"][1:])):
                    out.append(
                        {"file": name.rsplit("/", 1)[1], "row": m["row"], "segment": k, "doc_id": m["doc_ids"][k],
                         "piece": m["pieces"][k], "start": m["starts"][k], "offset": a, "length": b - a,
                         "ids_crc32": zlib.crc32(line[a:b].astype("<u4").tobytes()), "reset": m["resets"][k]}
                    )
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("file", pa.string()), ("row", pa.int64()), ("segment", pa.int32()), ("doc_id", pa.int64()),
                 ("piece", pa.int32()), ("start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
                 ("ids_crc32", pa.int64()), ("reset", pa.int32())]))

    short_batches(manifest.sparkSession)
    return manifest.mapInArrow(
        run,
        "file string, row long, segment int, doc_id long, piece int, start long, offset long, length long, ids_crc32 long, reset int",
    )


def position_ids(cu_seqlens: list[int], capacity: int) -> np.ndarray:
    """Positions of a row's places: from 0 in every segment, 0 in padding."""
    ends = np.array(cu_seqlens, dtype=np.int64)
    out = np.arange(capacity) - np.repeat(ends, np.diff(np.append(ends, capacity)))
    out[ends[-1] :] = 0
    return out
