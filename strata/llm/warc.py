"""WARC archives with a two-level capture index.

Archives: every task writes the records of its rows, each a gzip member of its
own, and returns where they lie. Records of equal payloads are stored once
(response), the others refer to it (revisit). File names are unique per
attempt and only finished tasks' records are listed, so a lost executor costs
its tasks and leaves at most an unlisted file.

Index: the archives are read back; captures are sorted by the reversed host
and path of their URL over range partitions, each of which writes its sorted
keys as compressed blocks into one file. The directory, a table, has one row
per block: its first and last key and its byte range. Lookups sort the wanted
keys over range partitions; a task loads only the slice of the directory
between its keys, finds the block by binary search, reads the block's range
and then the ranges of the records in the archives.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import file_system, short_batches, written
from strata.session import scratch_path

MIN_REVISIT_BYTES = 100  # smaller payloads are always stored
BLOCK_KEYS = 512  # captures of a compressed index block
PART_KEYS = 1 << 18  # captures of an index file, about
FILE_BYTES = 256 << 20  # an archive file is closed beyond this
WARC_DATE = "2024-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query; null: '-'."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)(?::([0-9]*))?([^#]*)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    port = F.regexp_extract(url, pattern, 2)
    path = F.regexp_extract(url, pattern, 3)
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    shown = F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port))
    key = F.concat(labels, shown, F.lit(")"), F.when(path == "", "/").otherwise(path))
    return F.coalesce(F.when(url.rlike(pattern), F.regexp_replace(key, r"\s", "%20")), F.regexp_replace(url, r"\s", "%20"), F.lit("-"))


def capture_key(url: Column, page_id: Column) -> Column:
    """Index key: sort key, capture time, page."""
    return F.concat(surt(url), F.lit(" " + "".join(c for c in WARC_DATE if c.isdigit()) + " "), F.coalesce(page_id.cast("string"), F.lit("null")))


def with_revisits(pages: DataFrame) -> DataFrame:
    """``key, page_id, url, payload, digest, first``: the smallest id of equal
    payloads, null where the payload is single or too small to refer to."""
    rows = pages.select(
        F.col("`page_id`").cast("long").alias("page_id"),
        F.col("`url`").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("`html`").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
    shared = large.groupBy(F.col("digest").alias("_d")).agg(F.count("*").alias("_n"), F.min("page_id").alias("first")).where("_n > 1")
    joined = rows.join(shared.drop("_n"), F.col("digest") == F.col("_d"), "left").drop("_d")
    return joined.withColumn("key", capture_key(F.col("url"), F.col("page_id")))


def _head(version: str, fields: list[tuple[str, str]]) -> bytes:
    return "".join([version, "\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode()


def record_id(page_id: int | str, digest: str, revisit: bool) -> str:
    """Id of a record. What a revisit refers to follows from the page and payload,
    so it is known without the other record; rows repeated whole share it."""
    name = f"{page_id}|{digest}|{'revisit' if revisit else 'response'}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16])}>"


def record(key: str, page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, with the full length."""
    revisit = first is not None and page_id != first
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key if page_id is None else page_id, digest, revisit)),
        ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Capture-Key", key),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(first, digest, False)),
            ("X-Refers-To-Page-Id", str(first)),
        ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Fields, full payload length and stored payload of a record."""
    end = data.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:] if ": " in line)
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return fields, int(http["Content-Length"]), block[cut + 4 :]


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id, url, html``); the
    files written: ``file, bytes, records``."""
    spark = pages.sparkSession
    short_batches(spark)
    folder = folder or scratch_path(spark, "warc")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        out, name, size, n = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "bytes": size, "records": n}])

        for batch in it:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, size, n = f"archive-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = _gzip(record(row["key"], row["page_id"], row["url"], row["payload"], row["digest"], row["first"]))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield listed()
        if out is not None:
            out.close()
            yield listed()

    rows = with_revisits(pages).select("key", "page_id", "url", "payload", "digest", "first")
    return written(rows.mapInArrow(run, "file string, bytes long, records long"), "warc-files")


def read_captures(files: DataFrame) -> DataFrame:
    """The captures of archives, in file order: ``key, file, offset, length``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column(0).to_pylist():
                fs, local = file_system(path)
                out = []
                with fs.open_input_stream(local, compression=None) as f:
                    at, held = 0, b""
                    while held or (held := f.read(1 << 20)):
                        z, start, head = zlib.decompressobj(31), at, b""
                        while not z.eof:
                            if not held and not (held := f.read(1 << 20)):
                                raise EOFError(f"{path}: record at {start} is cut off")
                            piece = z.decompress(held)
                            if len(head) < 65536:
                                head += piece
                            at += len(held) - len(z.unused_data)
                            held = z.unused_data
                        fields = dict(x.split(": ", 1) for x in head[: head.index(b"\r\n\r\n")].decode().split("\r\n")[1:])
                        out.append({"key": fields["X-Capture-Key"], "file": path, "offset": start, "length": at - start})
                        if len(out) >= 4096:
                            yield pa.RecordBatch.from_pylist(out)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out)

    spread = files.select("file").repartition(max(1, files.count()))
    return spread.mapInArrow(run, "key string, file string, offset long, length long")


_DIRECTORY = pa.schema(
    [("first_key", pa.string()), ("last_key", pa.string()), ("block_file", pa.string()), ("block_offset", pa.int64()),
     ("block_length", pa.int64()), ("keys", pa.int64())]
)


def build_index(captures: DataFrame, folder: str | None = None) -> str:
    """Write sorted compressed blocks; returns the path of their directory."""
    spark = captures.sparkSession
    folder = folder or scratch_path(spark, "capture-index")
    captures = written(captures, "captures")
    parts = max(1, -(-captures.count() // PART_KEYS), spark.sparkContext.defaultParallelism)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        name = f"{folder}/blocks-{uuid.uuid4().hex}.gz"
        out, at, held, rows = None, 0, [], []

        def flush() -> None:
            nonlocal out, at, held
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(file_system(name)[1], compression=None)
            lines = "".join(f"{r['key']}\t{r['file']}\t{r['offset']}\t{r['length']}\n" for r in held)
            data = _gzip(lines.encode())
            out.write(data)
            rows.append({"first_key": held[0]["key"], "last_key": held[-1]["key"], "block_file": name, "block_offset": at,
                         "block_length": len(data), "keys": len(held)})
            at, held = at + len(data), []

        for batch in it:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) >= BLOCK_KEYS:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(rows, schema=_DIRECTORY)

    ordered = captures.repartitionByRange(parts, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    path = scratch_path(spark, "capture-directory")
    ordered.mapInArrow(
        run, "first_key string, last_key string, block_file string, block_offset long, block_length long, keys long"
    ).write.parquet(path)
    return path


def lookup(keys: DataFrame, directory: str) -> DataFrame:
    """All captures of the keys (column ``key``), read from the archives:
    ``key, page_id, payload_bytes, payload_digest, record_type, refers_to, payload``.

    payload is null for a revisit. Keys that were not captured give no row;
    a repeated key gives its captures once.
    """

    def read(path: str, offset: int, length: int, opened: dict) -> bytes:
        if path not in opened:
            if len(opened) > 64:
                opened.pop(next(iter(opened))).close()
            fs, local = file_system(path)
            opened[path] = fs.open_input_file(local)
        return zlib.decompress(opened[path].read_at(length, offset), 31)

    def found(fields: dict[str, str], n: int, payload: bytes) -> dict:
        stored = fields["WARC-Type"] == "response"
        digest = hashlib.sha256(payload).hexdigest() if stored else fields["WARC-Payload-Digest"].split(":", 1)[1]
        if stored and (len(payload) != n or f"sha256:{digest}" != fields["WARC-Payload-Digest"]):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        return {
            "key": fields["X-Capture-Key"], "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
            "payload_bytes": n, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": int(fields["X-Refers-To-Page-Id"]) if not stored else None, "payload": payload if stored else None,
        }

    schema = pa.schema(
        [("key", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        fs, local = file_system(directory)
        listed = None
        for batch in it:
            wanted = batch.column(0).to_pylist()
            if not wanted:
                continue
            listed = listed or ds.dataset(local, filesystem=fs, format="parquet")  # once a task
            inside = (pc.field("last_key") >= wanted[0]) & (pc.field("first_key") <= wanted[-1])
            blocks = listed.to_table(filter=inside).sort_by(
                [("first_key", "ascending"), ("last_key", "ascending")]
            )
            firsts, lasts = blocks.column("first_key").to_pylist(), blocks.column("last_key").to_pylist()
            per_block: dict[int, set[str]] = {}
            for key in wanted:
                k = bisect.bisect_right(firsts, key) - 1
                while k >= 0 and lasts[k] >= key:  # a key may run over several blocks
                    per_block.setdefault(k, set()).add(key)
                    k -= 1
            spots = []
            for k, keys_in in per_block.items():
                b = blocks.slice(k, 1).to_pylist()[0]
                for line in read(b["block_file"], b["block_offset"], b["block_length"], opened).decode().split("\n")[:-1]:
                    key, path, offset, length = line.rsplit("\t", 3)
                    if key in keys_in:
                        spots.append((path, int(offset), int(length)))
            out, size = [], 0
            for path, offset, length in sorted(spots):
                out.append(found(*parse(read(path, offset, length, opened))))
                size += len(out[-1]["payload"] or b"")
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    spark = keys.sparkSession
    parts = spark.sparkContext.defaultParallelism * 4
    ordered = keys.select("key").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(
        run,
        "key string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages``, index the archives, and look every page up again.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``. Null html is an empty payload, null url the key
    '-'. Of equal payloads of 100 bytes or more the smallest page_id is the
    response; rows that repeat that id and payload are responses too; a null
    page_id refers to the others or, if there is no other, is a response.
    Extra columns are ignored; an empty table gives an empty one.
    """
    files = write_archives(pages)
    directory = build_index(read_captures(files))
    keys = pages.select(capture_key(F.col("`url`").cast("string"), F.col("`page_id`").cast("long")).alias("key"))
    if files.isEmpty():
        return pages.sparkSession.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    return lookup(keys, directory).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
