"""Toxicity by class-conditional Kneser-Ney models over byte n-grams.

Two interpolated Kneser-Ney models, one of the toxic and one of the ordinary
labelled documents, share one backoff distribution: the continuation counts
(distinct contexts) of the shorter n-grams over both classes, each order
interpolated with the next shorter one down to equal bytes. A rare
expression thus gets nearly the same probability from both models and says
little; only n-grams that one class prefers move the score. A document's
figure is the difference of its two log-likelihoods, divided by its length.

Counts are taken over *all* labelled training rows: each task counts its own
n-grams, Spark sums them, so what is gathered grows with the labelled text.
The finished model stays in Spark. What the driver and the scoring tasks
receive is a table over ``2**CELL_BITS`` hashed n-grams, a fixed size that no
corpus exceeds: a cell holds its most frequent n-gram, which one that is, and
whether there are others. The others are a table of their own. An n-gram that
may be among them is left open by the scoring task and joined with that table,
so every n-gram is scored by its own ratio, and by backoff only if never seen.

The labelled rows are split into two halves by a hash of the id. Each half's
model scores the other half, and the decision point (best F1) and slope come
from those scores, so they are not fitted to text the model has seen. A
document's final figure is the mean of both models.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import clean_select, mix64, short_batches, text_buffer, written

ORDER = 4  # bytes of an n-gram
CELL_BITS = 22  # hashed n-grams and contexts sent to the tasks: 13 bytes each, 110 MB at most
DISCOUNT = 0.9
PRIOR = 1.0  # weight of the shared backoff in every context
LOWER = 128.0  # the same within the shared orders: a context of few n-grams says little
PAD_BYTES = 200  # added to the length, so that a few bytes decide nothing
BINS = 4096  # of the calibration histogram
_CHUNK = 1 << 18  # bytes worked on at once: their n-grams, sorts and cells take 100 bytes each for a while
_HELD = 1 << 19  # n-grams that a counting task holds before it sums or returns them, 40 bytes each

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def _grams(buf: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The n-gram ending at each byte; a row starts after blanks."""
    low = _LOWER[buf]
    out = low.copy()
    start = np.repeat(rows[:-1], np.diff(rows))
    into = np.arange(len(buf)) - start
    for j in range(1, ORDER):
        before = np.full(len(buf), 32, dtype=np.uint64)
        before[j:] = low[:-j]
        before[into < j] = 32
        out |= before << np.uint64(8 * j)
    return out


def _cell(grams: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    return (mix64(grams) >> np.uint64(64 - bits)).astype(np.int64)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole rows in runs of about _CHUNK bytes: first row, bytes, offsets."""
    buf, rows = text_buffer(texts)
    i = 0
    while i < len(rows) - 1:
        j = max(i + 1, int(np.searchsorted(rows, rows[i] + _CHUNK, side="right")) - 1)
        yield i, buf[rows[i] : rows[j]], rows[i : j + 1] - rows[i]
        i = j


def _count_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams and their counts in (toxic, half) order 00 01 10 11. A task holds
    about _HELD of them, whatever it reads: what is more is returned as it comes,
    so an n-gram may come several times."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge() -> None:
        grams, counts = (np.concatenate(x) for x in zip(*held))
        u, inv = np.unique(grams, return_inverse=True)
        held[:] = [(u, np.stack([np.bincount(inv, weights=counts[:, k], minlength=len(u)) for k in range(4)], axis=1))]

    def emptied() -> Iterator[pa.RecordBatch]:
        u, c = held.pop()
        for i in range(0, len(u), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(u[part].astype(np.int64))] + [pa.array(c[part, k].astype(np.int64)) for k in range(4)],
                names=["g", "o0", "o1", "t0", "t1"],
            )

    for batch in it:
        kind = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, buf, rows in _pieces(batch.column(0)):
            g = _grams(buf, rows)
            if not len(g):
                continue
            own = np.repeat(kind[i : i + len(rows) - 1], np.diff(rows))
            u, inv = np.unique(g, return_inverse=True)
            held.append((u, np.bincount(inv * 4 + own, minlength=4 * len(u)).reshape(-1, 4).astype(np.float64)))
            if sum(len(x) for x, _ in held) > _HELD:
                merge()
                if len(held[0][0]) > _HELD // 2:
                    yield from emptied()
    if held:
        merge()
        yield from emptied()


def _weight(prefix: str = "") -> Column:
    """How often an n-gram stands in all labelled texts."""
    return sum((F.col(prefix + c) for c in ("o1", "t0", "t1")), F.col(prefix + "o0"))


def _with_cells(rows: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """``cell, g, w, r0, r1`` of n-grams without their cells."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cell = _cell(batch.column(0).to_numpy().astype(np.uint64), bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", *batch.schema.names])

    return rows.mapInArrow(run, "cell int, g long, w long, r0 float, r1 float")


def _best(found: DataFrame) -> DataFrame:
    best = found.groupBy("cell").agg(F.max(F.struct("w", "g", "r0", "r1")).alias("b"), (F.count("*") > 1).alias("more"))
    return best.select("cell", "b.g", "b.r0", "b.r1", "more")


def _by_cell(rows: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """``cell, g, r0, r1, more``: each cell's most frequent n-gram, its ratios
    and whether the cell has others. At most ``2**bits`` rows leave Spark,
    whatever the labelled corpus, and reruns keep the same n-gram where several
    share a cell."""
    return _best(_with_cells(rows, bits))


def _others(found: DataFrame) -> DataFrame:
    """``g, r0, r1`` of the n-grams that are not their cell's most frequent."""
    best = _best(found).where("more").select("cell", F.col("g").alias("kept"))
    return found.join(best.hint("merge"), "cell").where("g <> kept").select("g", "r0", "r1")


def _lower_orders(grams: DataFrame) -> DataFrame | None:
    """``lo, shared``: Kneser-Ney probability of a trigram's last byte after its
    first two, from distinct n-grams; None without any."""
    low = lambda c, n: F.col(c).bitwiseAND(F.lit((1 << 8 * n) - 1))
    tri = grams.groupBy("lo").agg(F.count("*").alias("n"))
    bi = tri.groupBy(low("lo", 2).alias("b")).agg(F.count("*").alias("n"))
    uni = bi.groupBy(low("b", 1).alias("u")).agg(F.count("*").alias("n"))
    every, kinds = uni.agg(F.sum("n"), F.count("*")).first()
    if not kinds:
        return None

    def order(rows: DataFrame, key: str, shorter: DataFrame, n: int) -> DataFrame:
        """Interpolated with the next shorter order (``key`` cut to n bytes)."""
        rows = rows.withColumn("ctx", F.shiftrightunsigned(key, 8))
        per = rows.groupBy("ctx").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        back = DISCOUNT * F.col("kinds") + LOWER
        p = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + back * F.col("p")) / (F.col("all") + LOWER)
        shorter = shorter.select(F.col(shorter.columns[0]).alias("short"), "p")
        return rows.join(per, "ctx").withColumn("short", low(key, n)).join(shorter, "short").select(key, p.alias("p"))

    p1 = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + (DISCOUNT * kinds + LOWER) / 256.0) / (every + LOWER)
    p1 = uni.select("u", p1.alias("p"))
    return order(tri, "lo", order(bi, "b", p1, 1), 2).withColumnRenamed("p", "shared")


def fit(docs: DataFrame, labels: DataFrame, bits: int = CELL_BITS) -> dict[str, Any] | None:
    """Model from labelled documents: per half, the log ratio of every n-gram
    (``g``) and of every context (``h``) for n-grams never seen; those that lead
    one of ``2**bits`` cells as arrays, the ``others`` as tables.

    ``labels`` has ``doc_id, toxic``; a document with several labels counts as
    toxic if one says so; null labels are ignored. Returns None unless both
    halves hold both classes.
    """
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2))
    labels = (
        clean_select(labels, {"doc_id": "long", "toxic": "int"})
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    text = clean_select(docs, {"doc_id": "long", "text": "string"}).where("text is not null and text <> ''")
    # labels have no bound, so they are never broadcast: one plan at every size
    kinds = text.join(labels.hint("merge"), "doc_id").select("text", (F.col("toxic") * 2 + half).cast("int").alias("kind"))
    counts = written(
        kinds.mapInArrow(_count_batches, "g long, o0 long, o1 long, t0 long, t1 long")
        .groupBy("g")
        .agg(*[F.sum(c).alias(c) for c in ("o0", "o1", "t0", "t1")]),
        "kn-counts",
    )
    # contexts (first bytes) and the shorter n-gram (last bytes)
    g = F.col("g")
    grams = counts.withColumns({"h": F.shiftrightunsigned(g, 8), "lo": g.bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1))})
    shared = _lower_orders(grams)
    if shared is None:
        return None
    per_h = grams.groupBy("h").agg(
        *[F.sum(c).alias(f"n_{c}") for c in ("o0", "o1", "t0", "t1")],
        *[F.count_if(F.col(c) > 0).alias(f"d_{c}") for c in ("o0", "o1", "t0", "t1")],
    )

    def ratio(c: str, seen: bool):
        def p(name: str):
            own = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) if seen else F.lit(0.0)
            back = F.col(f"d_{name}") * DISCOUNT + PRIOR
            shared = F.col("shared") if seen else F.lit(1.0)
            return (own + back * shared) / (F.col(f"n_{name}") + PRIOR)

        return F.log(p(f"t{c}") / p(f"o{c}")).cast("float")

    model = (
        grams.join(per_h, "h")
        .join(shared, "lo")
        .select("g", _weight().alias("w"), ratio("0", True).alias("r0"), ratio("1", True).alias("r1"))
    )
    unseen = per_h.select(
        F.col("h").alias("g"), _weight("n_").alias("w"), ratio("0", False).alias("r0"), ratio("1", False).alias("r1")
    )
    out: dict[str, Any] = {"bits": bits, "others": {}}
    for key, table in (("g", model), ("h", unseen)):
        found = written(_with_cells(table, bits), f"kn-{key}")
        rows = _best(found).toArrow()
        out[key] = rows.column("g").to_numpy().astype(np.uint32)
        out[f"{key}x"] = rows.column("more").to_numpy(zero_copy_only=False)
        for c in ("0", "1"):
            out[key + c] = rows.column(f"r{c}").to_numpy()
        out["others"][key] = _others(found)
    sums = per_h.agg(*[F.sum(f"n_{c}") for c in ("o0", "o1", "t0", "t1")]).first()
    return out if all(s for s in sums) else None


def dense(model: dict[str, Any]) -> dict[str, np.ndarray]:
    """The model by cell; only its filled cells are sent to the tasks."""
    bits = model["bits"]
    out: dict[str, np.ndarray] = {}
    for key in ("g", "h"):
        at = _cell(model[key].astype(np.uint64), bits)
        for name, empty in ((key, 0), (f"{key}x", False), (f"{key}0", np.nan), (f"{key}1", np.nan)):
            out[name] = np.full(1 << bits, empty, dtype=model[name].dtype)
            out[name][at] = model[name]
    return out


# An n-gram of a text that its task can't decide: how often it stands there, what
# it counts for if it is none of the others, and its context if that is open, too.
_OPEN = pa.struct([("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("b0", pa.float32()), ("b1", pa.float32())])


def _left_open(
    m: dict[str, np.ndarray], grams: np.ndarray, own: np.ndarray, rows: int, bits: int
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ratios of n-grams that are not found by themselves in their cells
    (0 where still open), and the open ones, distinct per row, as lists."""
    cell = _cell(grams, bits)
    before = grams >> np.uint64(8)
    ctx = _cell(before, bits)
    known = ~np.isnan(m["h0"][ctx]) & (m["h"][ctx] == before)
    base = [np.where(known, m[f"h{k}"][ctx], np.float32(0.0)) for k in (0, 1)]  # both classes fall to the shared order
    maybe, maybe_ctx = m["gx"][cell], m["hx"][ctx] & ~known
    at = np.flatnonzero(maybe | maybe_ctx)
    pairs, first, n = np.unique((own[at].astype(np.uint64) << np.uint64(32)) | grams[at], return_index=True, return_counts=True)
    one = at[first]
    none = -1 - grams[one].astype(np.int64)  # no key of the other tables, and not one for all
    fields = [
        pa.array(np.where(maybe[one], grams[one].astype(np.int64), none)),
        pa.array(np.where(maybe_ctx[one], before[one].astype(np.int64), none)),
        pa.array(n.astype(np.int64)), pa.array(base[0][one]), pa.array(base[1][one]),
    ]
    starts = np.searchsorted(pairs >> np.uint64(32), np.arange(rows + 1, dtype=np.uint64)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays(fields, fields=list(_OPEN)))
    for b in base:
        b[at] = 0.0
    return base[0], base[1], lists


def raw_scores(docs: DataFrame, model: dict[str, Any]) -> DataFrame:
    """Length-normalised log ratios of every row under both halves' models:
    ``doc_id, z0, z1`` (text null or empty: 0)."""
    others, bits = model["others"], model["bits"]
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "others"})

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = dense(shared.value)
        row = TaskContext.get().partitionId() << 40
        for batch in it:
            n = batch.num_rows
            z, size, left = np.zeros((2, n)), np.full(n, PAD_BYTES, dtype=np.int64), []
            for i, buf, rows in _pieces(batch.column(1)):
                grams = _grams(buf, rows)
                lens = np.diff(rows)
                size[i : i + len(lens)] += lens
                cell = _cell(grams, bits)
                own = np.repeat(np.arange(len(lens)), lens)
                new = np.isnan(m["g0"][cell]) | (m["g"][cell] != grams)
                *base, lists = _left_open(m, grams[new], own[new], len(lens), bits)
                left.append(lists)
                for k in (0, 1):
                    v = m[f"g{k}"][cell]
                    v[new] = base[k]
                    z[k, i : i + len(lens)] = np.bincount(own, weights=v, minlength=len(lens)) / (lens + PAD_BYTES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column(0), pa.array(z[0]), pa.array(z[1]), pa.array(size),
                 pa.concat_arrays(left) if left else pa.array([], pa.list_(_OPEN))],
                names=["row", "doc_id", "z0", "z1", "size", "open"],
            )
            row += n

    part = written(
        clean_select(docs, {"doc_id": "long", "text": "string"}).mapInArrow(
            score,
            "row long, doc_id long, z0 double, z1 double, size long, open array<struct<g: long, h: long, n: long, b0: float, b1: float>>",
        ),
        "kn-parts",
    )
    shared.destroy()  # the written parts need it no more
    # neither side has a bound, so none is broadcast; sums in decimals do not depend on their order
    each = part.select("row", F.inline("open"))
    for key in ("g", "h"):
        table = others[key].select(F.col("g").alias(key), F.col("r0").alias(f"{key}0"), F.col("r1").alias(f"{key}1"))
        each = each.join(table.hint("merge"), key, "left")
    value = lambda k: (F.coalesce(f"g{k}", f"h{k}", f"b{k}").cast("decimal(20,12)") * F.col("n").cast("decimal(10,0)"))
    more = each.groupBy("row").agg(F.sum(value(0)).alias("m0"), F.sum(value(1)).alias("m1"))
    z = lambda k: (F.col(f"z{k}") + F.coalesce(F.col(f"m{k}").cast("double"), F.lit(0.0)) / F.col("size")).alias(f"z{k}")
    return part.drop("open").join(more.hint("merge"), "row", "left").select("doc_id", z(0), z(1))


def _decision(scored: DataFrame, labels: DataFrame) -> tuple[float, float]:
    """Decision point of best F1 and slope, from each half under the other's model."""
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2))
    known = clean_select(labels, {"doc_id": "long", "toxic": "int"}).where("toxic is not null")
    cross = scored.join(known, "doc_id").select(
        F.when(half == 0, F.col("z1")).otherwise(F.col("z0")).alias("z"), (F.col("toxic") == 1).cast("int").alias("y")
    )
    low, high = cross.agg(F.min("z"), F.max("z")).first()
    if low is None or not high > low:
        return 0.0, 1.0
    width = (high - low) / BINS
    bins = (
        cross.groupBy(F.least(F.floor((F.col("z") - low) / width), F.lit(BINS - 1)).cast("int").alias("b"))
        .agg(F.sum("y").alias("t"), F.count("*").alias("n"))
        .collect()  # BINS rows at most
    )
    pos, every = np.zeros(BINS), np.zeros(BINS)
    for b, t, n in bins:
        pos[b], every[b] = t, n
    tp, said = pos[::-1].cumsum()[::-1], every[::-1].cumsum()[::-1]
    f1 = 2 * tp / np.maximum(said + pos.sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    cut = low + width * float(best.mean())
    mean = (pos * (low + width * (np.arange(BINS) + 0.5))).sum() / max(pos.sum(), 1)
    return cut, max(abs(mean - cut) / 3, 1e-6)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    score is in 0..1, 0.5 at the decision point; predicted is 1 from there on.
    Null or empty text is scored as a text without evidence. Only ``labels``
    rows passed in are learnt from. Without both classes in the labels nothing
    can be learnt: score 0, predicted 0. Repeated rows are scored each; extra
    columns are ignored.
    """
    short_batches(docs.sparkSession)
    model = fit(docs, labels)
    if model is None:
        return clean_select(docs, {"doc_id": "long"}).select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scored = written(raw_scores(docs, model), "kn-scores")
    cut, slope = _decision(scored, labels)
    z = (F.col("z0") + F.col("z1")) / 2
    score = 1 / (1 + F.exp(F.greatest(F.lit(-500.0), (F.lit(cut) - z) / slope)))
    return scored.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train_labels(labels: DataFrame) -> DataFrame:
    """Label rows outside the held-out fold (crc32 of the id as text, modulo 5)."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


