"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Exact up to collisions of 64-bit shingle hashes. Steps, each a Spark job over
tables in the shared folder:

1. Frequencies. Every task counts its shingles into hashed cells; Spark sums
   the cells. The finished table, one byte per cell on a log scale, has a
   fixed size and is what tasks receive. Shingles are ordered by
   (cell frequency, hash): one total order for all documents, rare ones first,
   so the filters below lose nothing whatever the frequencies are.
2. Classes. Documents with the same shingle set are one node, keyed by a
   64-bit set hash and the set size; copies are never joined.
3. Prefixes. A set of n shingles shows its first ``n - ceil(t * n) + 1``; two
   sets of Jaccard t or more share one of them. Prefix rows meet by shingle. A
   shingle that two sets show is one pair: the length and positional filter
   decide on it where the rows are counted, before any pair is made.
4. Star rounds. In each shingle's group every set of another component is
   compared with one centre (length, positional and suffix filter, then the
   texts), and the links found are contracted: a round costs as many comparisons
   as there are rows. The first centre is the group's smallest set, later ones
   are drawn anew in every round, so a family of near copies that do not all
   reach one centre grows together from several. A group's centre then leaves
   it, as all its pairs are decided; groups left with one component or without
   an early row are done.
5. Residual round. What is left in a group are pairs of different components;
   sets outside a group's largest component meet the group's other components
   in a join whose condition holds the filters, so only pairs that pass them
   become rows, and those at their first common shingle; these are verified in
   the same way. No pair is lost: a pair is skipped only if it was compared
   before, or both sets already are in one component.
6. Components of all links.

A hot shingle, set or document meets others only in joins that adaptive
execution splits, never in a group that one task must hold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import clean_select, components, forget, fresh, in_pieces, shingle_sets, short_batches, written

CELL_BITS = 24  # frequency cells of one table: 16 MB, whatever the corpus
TABLES = 1  # with more, a shingle's frequency is the least of its cells
_CHUNK_BITS = 16  # cells of one shuffled block
HIST = 16  # parts of the suffix filter
BITS = 256  # parity bits of a set
MARKS = 1 << 27  # bits of a table of wanted keys at most: 16 MB, whatever the corpus
KEY_BITS = 128  # of such a table for each wanted key, up to there
ROUNDS = 2  # star rounds at most; the residual round takes all that is left
HEAD = 32  # first shingles by which a pair knows an earlier common one


def _cells(shingles: np.ndarray, which: int) -> np.ndarray:
    at = (shingles >> np.uint64(64 - CELL_BITS * (which + 1))) & np.uint64((1 << CELL_BITS) - 1)
    return at.astype(np.int64) + (which << CELL_BITS)


def shingle_frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """Log-scaled corpus frequency of every cell, one byte each."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TABLES << CELL_BITS, dtype=np.uint32)
        for batch in in_pieces(it):
            found, _ = shingle_sets(batch.column(0), words)
            for which in range(TABLES):
                cells, n = np.unique(_cells(found, which), return_counts=True)
                total[cells] += n.astype(np.uint32)
        blocks = total.reshape(-1, 1 << _CHUNK_BITS)
        used = np.flatnonzero(blocks.any(axis=1))
        for k in used.tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([zlib.compress(blocks[k].tobytes(), 1)], pa.binary())],
                names=["chunk", "cells"],
            )

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in it:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = np.frombuffer(zlib.decompress(raw.as_py()), dtype=np.uint32)
                sums[k] = sums[k] + block if k in sums else block.astype(np.uint64)
        for k, block in sums.items():
            level = np.minimum(np.round(8 * np.log2(1 + block.astype(np.float64))), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())],
                names=["chunk", "cells"],
            )

    spark = docs.sparkSession
    text = clean_select(docs, {"text": "string"})
    counted = text.mapInArrow(count, "chunk int, cells binary")
    summed = counted.repartition("chunk").mapInArrow(add, "chunk int, cells binary")
    short_batches(spark)
    table = np.zeros(TABLES << CELL_BITS, dtype=np.uint8)
    for k, raw in summed.collect():  # the fixed tables: TABLES * 2**CELL_BITS bytes at most
        table[k << _CHUNK_BITS : (k + 1) << _CHUNK_BITS] = np.frombuffer(zlib.decompress(bytes(raw)), dtype=np.uint8)
    return table


def _set_key(sets: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit hash of each sorted set."""
    with np.errstate(over="ignore"):
        rank = np.arange(len(sets)) - np.repeat(offs[:-1], np.diff(offs))
        part = (sets ^ np.uint64(0x9E3779B97F4A7C15)) * (np.uint64(2) * rank.astype(np.uint64) + np.uint64(1))
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(32)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
        return (sums[offs[1:]] - sums[offs[:-1]]).astype(np.int64)


def _overlap(total: Column, num: int, den: int) -> Column:
    """Least intersection of two sets with ``total`` elements together."""
    return F.ceil(F.lit(num) * total / F.lit(num + den))


def document_sets(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``doc_id, h, n, prefix, hist, bits``: set key, set size, first shingles
    of the global order (8 bytes each), shingle counts by hash range, and the
    parity of the counts by another range. A written table: the frequencies
    are dropped on the driver and the executors once it is there."""
    table = docs.sparkSession.sparkContext.broadcast(shingle_frequencies(docs, words))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(it):
            sets, offs = shingle_sets(batch.column(1), words)
            n = np.diff(offs)
            rows = len(n)
            key = _set_key(sets, offs) if len(sets) else np.zeros(rows, np.int64)
            of = np.repeat(np.arange(rows), n)
            level = np.minimum.reduce([table.value[_cells(sets, which)] for which in range(TABLES)])
            order = np.lexsort((sets, level, of))
            ranked = sets[order]
            length = np.where(n > 0, n - -(-num * n // den) + 1, 0)
            prefix = [ranked[a : a + k].tobytes() for a, k in zip(offs[:-1].tolist(), length.tolist())]
            part = np.bincount(of * HIST + (sets >> np.uint64(60)).astype(np.int64), minlength=rows * HIST)
            hist = pa.ListArray.from_arrays(
                pa.array(np.arange(rows + 1, dtype=np.int32) * HIST), pa.array(part.astype(np.int32))
            )
            odd = np.bincount(of * BITS + (sets & np.uint64(BITS - 1)).astype(np.int64), minlength=rows * BITS) & 1
            bits = pa.ListArray.from_arrays(
                pa.array(np.arange(rows + 1, dtype=np.int32) * (BITS // 64)),
                pa.array(np.packbits(odd.astype(np.uint8)).view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key), pa.array(n.astype(np.int32)), pa.array(prefix, pa.binary()), hist, bits],
                names=["doc_id", "h", "n", "prefix", "hist", "bits"],
            )

    rows = clean_select(docs, {"doc_id": "long", "text": "string"})
    out = written(
        rows.mapInArrow(run, "doc_id long, h long, n int, prefix binary, hist array<int>, bits array<long>"), "join-sets"
    )
    table.destroy()
    return out


def _prefix_rows(reps: DataFrame, head: int = 0) -> DataFrame:
    """``tok, h, n, pos, early`` of every prefix shingle; with ``head`` also the
    set's first shingles before this one, that many at most.

    The smaller set of a pair must show the first common shingle early: a
    group without such a row holds no pair."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(it):
            raw = batch.column(2)
            k = np.array([len(x.as_py()) // 8 for x in raw], dtype=np.int64)
            tok = np.frombuffer(b"".join(x.as_py() for x in raw), dtype=np.int64)
            at = np.repeat(np.arange(len(k)), k)
            first = np.repeat(np.cumsum(k) - k, k)
            pos = np.arange(len(tok)) - first
            which = pa.array(at)
            columns = {"tok": pa.array(tok), "h": batch.column(0).take(which), "n": batch.column(1).take(which),
                       "pos": pa.array(pos.astype(np.int32)), "early": batch.column(3).take(which)}
            columns["early"] = pc.less_equal(columns["pos"], columns["early"])
            if head:
                size = np.minimum(pos, head)
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
                inner = np.repeat(first, size) + np.arange(ends[-1]) - np.repeat(ends[:-1], size)
                columns["head"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tok[inner]))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "tok long, h long, n int, pos int, early boolean" + (", head array<long>" if head else "")
    return reps.select("h", "n", "prefix", "early").mapInArrow(run, schema)


def _fits(small: Column, large: Column, left: Column, num: int, den: int) -> Column:
    """Length and positional filters on a pair's smaller and larger set and on
    the fewest shingles that one of them has left.

    Before a pair's first common shingle neither side has a common one, so from
    there on both must still hold the overlap needed. Rows of later common
    shingles may fail; the first one's row does not."""
    return (small * den >= large * num) & (left >= _overlap(small + large, num, den))


def _reach(a: str, b: str, num: int, den: int) -> Column:
    """The same on columns ``<a>n, <a>pos`` and those of b."""
    n, m = F.col(a + "n"), F.col(b + "n")
    left = F.least(n - F.col(a + "pos"), m - F.col(b + "pos"))
    return _fits(F.least(n, m), F.greatest(n, m), left, num, den)


def _shared(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``tok`` of the shingles that may hold a pair that links: shown by several
    sets, one of them early; if by two only, they pass the filters."""
    groups = rows.groupBy("tok").agg(
        F.count("*").alias("k"), F.max("early").alias("e"), F.min("n").alias("small"), F.max("n").alias("large"),
        F.min(F.col("n") - F.col("pos")).alias("left"),
    )
    pair = _fits(F.col("small"), F.col("large"), F.col("left"), num, den)
    return groups.where("k > 1 and e").where((F.col("k") > 2) | pair).select("tok")


def _same_bits(a: str, b: str, num: int, den: int) -> Column:
    """Suffix filter: the parity bits of two sets differ in at most as many
    places as the sets differ in elements; sets that link differ in few."""
    total = F.col(a + "n") + F.col(b + "n")
    x, y = F.col(a + "bits"), F.col(b + "bits")
    flips = sum((F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(1, BITS // 64)), F.bit_count(x[0].bitwiseXOR(y[0])))
    return flips <= total - 2 * _overlap(total, num, den)


def _same_shape(a: str, b: str, num: int, den: int) -> Column:
    """The same by the counts of elements per hash range."""
    total = F.col(a + "n") + F.col(b + "n")
    gaps = F.zip_with(F.col(a + "hist"), F.col(b + "hist"), lambda x, y: F.abs(x - y))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x) <= total - 2 * _overlap(total, num, den)


def _marks(most: int) -> int:
    """Bits of the table of ``most`` wanted keys: a power of two, one block at least."""
    return min(MARKS, max(1 << 15, 1 << (KEY_BITS * most).bit_length()))


def _split(rows: DataFrame, key: str, wanted: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key hashes to a bit that a key of ``wanted`` set (all rows
    with a wanted key and few others), and the other rows, told apart before
    anything is shuffled. ``wanted`` has ``most`` keys or fewer: the bitmaps
    that driver and executors hold follow it up to a fixed size; on a corpus
    that fills them more rows count as wanted."""
    block, bits = fresh(rows, "_block"), fresh(rows, "_bits")
    marks = F.lit(_marks(most))
    bit = F.pmod(F.xxhash64(F.col(wanted.columns[0])), marks)
    bitmaps = wanted.groupBy(F.bitmap_bucket_number(bit).alias(block)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias(bits)
    )
    at = F.pmod(F.xxhash64(F.col(f"`{key}`")), marks)
    met = rows.withColumn(block, F.bitmap_bucket_number(at)).join(F.broadcast(bitmaps), block, "left")
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    names = [F.col(f"`{c}`") for c in rows.columns]
    return met.where(hit).select(*names), met.where(~hit).select(*names)


def _shaped(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Those distinct pairs that pass both suffix filters."""
    shape = reps.select("h", "n", "hist", "bits")
    side = lambda s: shape.select(*[F.col(c).alias(s + c) for c in shape.columns])
    met = pairs.join(side("a"), ["ah", "an"]).join(side("b"), ["bh", "bn"])
    return met.where(_same_bits("a", "b", num, den) & _same_shape("a", "b", num, den)).select("ah", "an", "bh", "bn")


def _verified(pairs: DataFrame, docs: DataFrame, most: int, reps: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Those pairs of the sets of ``most`` documents at most whose whole texts reach the threshold."""
    ends = pairs.select(F.col("ah").alias("h"), F.col("an").alias("n")).union(pairs.select("bh", "bn")).distinct()
    need = ends.join(reps.select("h", "n", "doc_id"), ["h", "n"])

    def keyed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(it):
            sets, offs = shingle_sets(batch.column(1), words)
            key = _set_key(sets, offs) if len(sets) else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key), pa.array(np.diff(offs).astype(np.int32)), batch.column(1)],
                names=["doc_id", "h", "n", "text"],
            )

    # the class representative's text; its id alone picks the row, its set key confirms it
    wanted = need.select(F.col("doc_id").alias("rep")).distinct()
    picked = _split(clean_select(docs, {"doc_id": "long", "text": "string"}), "doc_id", wanted, most)[0].alias("d").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("rep"))  # distinct ids; a semi join would be pushed below the marks
    ).select("doc_id", "text")
    texts = picked.mapInArrow(keyed, "doc_id long, h long, n int, text string").alias("t")
    same = (F.col("t.h") == F.col("r.h")) & (F.col("t.n") == F.col("r.n")) & F.col("t.doc_id").eqNullSafe(F.col("r.doc_id"))
    texts = written(
        texts.join(need.alias("r"), same, "left_semi").select("h", "n", "text").dropDuplicates(["h", "n"]), "join-texts"
    )

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(it):
            sa, oa = shingle_sets(batch.column(4), words)
            sb, ob = shingle_sets(batch.column(5), words)
            na, nb = np.diff(oa), np.diff(ob)
            # both sides' shingles per pair, sorted: an equal neighbour is a common one
            of = np.concatenate((np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)))
            both = np.concatenate((sa, sb))
            order = np.lexsort((both, of))
            both, of = both[order], of[order]
            twin = (both[1:] == both[:-1]) & (of[1:] == of[:-1])
            common = np.bincount(of[1:][twin], minlength=len(na))
            ok = den * common >= num * (na + nb - common)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(keep) for i in range(4)], names=["ah", "an", "bh", "bn"]
            )

    ta = texts.select(F.col("h").alias("ah"), F.col("n").alias("an"), F.col("text").alias("ta"))
    tb = texts.select(F.col("h").alias("bh"), F.col("n").alias("bn"), F.col("text").alias("tb"))
    joined = pairs.join(tb, ["bh", "bn"]).join(ta, ["ah", "an"])
    reached = joined.select("ah", "an", "bh", "bn", "ta", "tb").mapInArrow(compare, "ah long, an int, bh long, bn int")
    reached = written(reached, "join-links")
    forget(texts)
    return reached


def _node(h: str, n: str) -> Column:
    return F.struct(F.col(h).alias("h"), F.col(n).alias("n"))


def _ordered_pair() -> list[Column]:
    """A pair's columns, the smaller node first."""
    swap = _node("ah", "an") <= _node("bh", "bn")
    pick = lambda a, b: F.when(swap, F.col(a)).otherwise(F.col(b))
    return [pick("ah", "bh").alias("ah"), pick("an", "bn").alias("an"), pick("bh", "ah").alias("bh"), pick("bn", "an").alias("bn")]


def _unseen(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    for seen in tried:
        pairs = pairs.join(seen, ["ah", "an", "bh", "bn"], "left_anti")
    return pairs


def _edges(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out.select(_node("ah", "an").alias("a"), _node("bh", "bn").alias("b"))


def _still_open(rows: DataFrame, part: DataFrame | None, most: int) -> DataFrame:
    """Rows of the groups, ``most`` at most, that still hold two components and
    an early row, with their own component."""
    named = rows.select("tok", "h", "n", "pos", "early", "comp")
    if part is not None:
        named = named.drop("comp").withColumn("node", _node("h", "n")).join(part, "node", "left")
        named = named.select("tok", "h", "n", "pos", "early", F.coalesce("component", "node").alias("comp"))
    groups = named.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("early").alias("e"))
    mixed = groups.where("lo <> hi and e").select("tok")
    return written(_split(named, "tok", mixed, most)[0].join(mixed, "tok"), "join-groups")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``
    (``doc_id, text``): documents link when ``den * intersection >= num *
    union`` of their distinct ``words``-word shingles; component_id is the
    smallest id reachable by links, itself included.

    ASCII letters are compared in lower case. Null or empty texts and texts
    without words have no shingles and link with nothing: their component is
    their own id. Rows with the same set are linked whatever their id; null
    ids take part and count as no id (null only if a component has no other).
    Extra columns are ignored.
    """
    spark = docs.sparkSession
    short_batches(spark)
    found = document_sets(docs, words, num, den)
    total = found.count()  # no table of documents that are told apart below has more keys
    full = found.where("n > 0").withColumn("key", F.xxhash64("h", "n"))
    # one row per class of copies: only sets that occur more than once move
    copied = written(
        full.groupBy("h", "n").agg(F.count("*").alias("k")).where("k > 1").select(F.xxhash64("h", "n").alias("key")), "join-copied"
    )
    several, single = _split(full, "key", copied, total)
    shape = ["h", "n", "doc_id", "prefix", "hist", "bits"]
    several = several.groupBy("h", "n").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("prefix", "hist", "bits")])
    early = (F.col("n") - _overlap(F.col("n") + F.col("n"), num, den)).cast("int").alias("early")
    # written, as a dozen queries read it: else each tells the copies apart again
    reps = written(single.select(*shape).union(several.select(*shape)).select(*shape, early), "join-reps")

    # most shingles stand in one prefix only: they are told apart by narrow
    # counts, so that only shared ones meet in wider rows
    rows = _prefix_rows(reps)
    repeated = written(_shared(rows, num, den), "join-toks")
    groups = repeated.count()
    kept = written(_split(rows, "tok", repeated, groups)[0].join(repeated, "tok"), "join-kept")
    open_rows = kept.withColumn("comp", _node("h", "n"))
    tried, links, part = [], [], None
    pair = ["ah", "an", "bh", "bn"]
    for turn in range(ROUNDS):
        drawn = F.xxhash64("h", "n", "tok", F.lit(turn)) if turn else F.lit(0).cast("long")
        centre = open_rows.where("early").groupBy("tok").agg(F.min(F.struct(drawn.alias("d"), "h", "n", "pos", "comp")).alias("c"))
        # all pairs of a centre are decided in this round: it leaves its group
        others = open_rows.join(centre, "tok").where((F.col("h") != F.col("c.h")) | (F.col("n") != F.col("c.n")))
        star = others.where(F.col("comp") != F.col("c.comp")).select(
            F.col("c.h").alias("ah"), F.col("c.n").alias("an"), F.col("c.pos").alias("apos"),
            F.col("h").alias("bh"), F.col("n").alias("bn"), F.col("pos").alias("bpos"),
        )
        star = star.where(_reach("a", "b", num, den)).select(*_ordered_pair()).distinct()
        fresh_pairs = written(_shaped(_unseen(star, tried), reps, num, den), "join-star")
        tried.append(fresh_pairs)
        reached = None if fresh_pairs.isEmpty() else _verified(fresh_pairs, docs, total, reps, words, num, den)
        old = [open_rows]
        if reached is not None and not reached.isEmpty():
            links.append(reached)
            old += [part] if part is not None else []
            part = components(_edges(links), "join-cc")
        open_rows = _still_open(others, part, groups)
        forget(*old)
        if open_rows.isEmpty():  # every pair is decided
            break

    # residual: pairs across components within a shingle's group
    if part is None:
        part = components(_edges([spark.createDataFrame([], "ah long, an int, bh long, bn int")]), "join-cc")
    whole = _split(_prefix_rows(reps, HEAD).select("tok", "h", "n", "head"), "tok", open_rows.select("tok").distinct(), groups)[0]
    whole = whole.join(open_rows, ["tok", "h", "n"])
    whole = whole.join(reps.select("h", "n", "bits"), ["h", "n"])
    major = (
        open_rows.groupBy("tok", "comp").agg(F.count("*").alias("k"))
        .groupBy("tok").agg(F.max(F.struct("k", "comp")).alias("m")).select("tok", F.col("m.comp").alias("major"))
    )
    whole = written(whole.join(major, "tok"), "join-open")
    minor = whole.where("comp <> major")
    same_group = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.comp") != F.col("y.comp"))
    swap = _node("x.h", "x.n") < _node("y.h", "y.n")
    once = (F.col("y.comp") == F.col("x.major")) | swap
    first = ~F.arrays_overlap("x.head", "y.head")

    def paired(x: DataFrame, y: DataFrame) -> DataFrame:
        near = _reach("x.", "y.", num, den) & _same_bits("x.", "y.", num, den)
        return x.alias("x").join(y.alias("y"), same_group & once & near & first).select(
            F.col("x.h").alias("ah"), F.col("x.n").alias("an"), F.col("y.h").alias("bh"), F.col("y.n").alias("bn")
        ).select(*_ordered_pair())

    if not whole.isEmpty():
        left = paired(minor.where("early"), whole).union(paired(minor.where("not early"), whole.where("early"))).distinct()
        left = written(_shaped(_unseen(left, tried), reps, num, den), "join-rest")
        tried.append(left)
        if not left.isEmpty():
            links.append(_verified(left, docs, total, reps, words, num, den))
            forget(part)
            part = components(_edges(links), "join-cc2")
    forget(whole, kept, repeated, open_rows, *tried)

    classes = reps.select("h", "n", "doc_id", _node("h", "n").alias("node")).join(part, "node", "left")
    classes = classes.select("h", "n", "doc_id", F.coalesce("component", "node").alias("comp"))
    least = classes.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    classes = classes.join(least, "comp").select("h", "n", "component_id")
    linked = full.select("doc_id", "h", "n").join(classes, ["h", "n"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    alone = found.where("n = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.union(alone)


def one_per_component(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` less near copies: of each component the row with
    the smallest id stays. Rows without shingles and rows without an id (which
    name no document) all stay. Of repeated rows of the same id one stays."""
    found = written(jaccard_components(docs, words, num, den), "join-components")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct()
    twice = found.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    decided = written(
        gone.withColumn("gone", F.lit(True)).join(twice.select(F.col("doc_id").alias("id"), F.lit(True).alias("twice")), "id", "full"),
        "join-decided",
    )
    # rows that nothing is said about stay where they are
    names = docs.columns
    own = [F.col(f"d.`{c}`").alias(c) for c in names]
    maybe, sure = _split(docs, "doc_id", decided.select("id"), found.count())
    met = maybe.alias("d").join(decided.alias("s"), F.col("d.`doc_id`") == F.col("s.id"), "left").where("s.gone is null")
    once = met.where("s.twice is null").select(*own)
    place = fresh(docs, "_place")
    by_row = Window.partitionBy("s.id").orderBy(*[F.col(f"d.`{c}`") for c in names])
    again = met.where("s.twice is not null").select(*own, F.row_number().over(by_row).alias(place)).where(F.col(place) == 1)
    return sure.union(once).union(again.select(*[F.col(f"`{c}`") for c in names]))
