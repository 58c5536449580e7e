"""Hard negatives by bounds along a spanning tree of the anchors.

For an anchor a with parent p in the tree, a candidate c of norm |c| scores
within ``score(p, c) - |a - p| |c|`` and ``score(p, c) + |a - p| |c|``. A task
holds a batch of candidates and walks the tree from its root: every anchor
takes its interval from its parent, and only candidates whose interval meets
the anchor's window are scored, which makes their interval a point for the
children. Scores are exact inner products of whole numbers; the interval only
decides what need not be scored.

Anchors are taken in groups of bounded size (one broadcast each), a group in
blocks of neighbours by label with one minimum spanning tree per block; the
candidates are never moved. Per group there are four passes over the table of
integer vectors:

1. a hashed share of the rows gives each anchor a lower limit for the score of
   its last positive,
2. all rows give the positives, with windows from that limit upwards,
3. the share of the rows gives each positive a lower limit for its last
   negative within its window,
4. all rows give the negatives within window and limit.

A task keeps its best few per anchor, and its limits rise as it reads. The
limits come from a share of the table, not from a fixed number of rows, so what
the tasks emit for one anchor stays the same however large the table is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import short_batches, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # a negative's score, in per cent of its positive's
GROUP = 1 << 15  # anchors of one pass, about
BLOCK = 512  # anchors of one tree
SHARE = 16  # one of so many rows sets the limits
BATCH = 4096  # candidates walked down the trees at once
EXACT = 1 << 53  # doubles add whole numbers exactly below this
ANY = 1 << 62  # beyond every score, which stay below it in size


@dataclass
class Tree:
    """A block of anchors in an order in which parents come first."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of some vectors, grown from the first: the order
    in which they join, each one's parent (a place in that order; the first
    one's is -1) and the length of the edge to it."""
    n = len(v)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    if n == 0:
        return order, parent, edge
    points = v.astype(np.float64)
    near = np.linalg.norm(points - points[0], axis=1)
    via = np.zeros(n, np.int64)  # place of the nearest vector that joined
    near[0] = np.inf
    joined = np.zeros(n, bool)
    joined[0] = True
    for k in range(1, n):
        at = int(np.argmin(near))
        order[k], parent[k], edge[k] = at, via[at], near[at]
        joined[at] = True
        gap = np.linalg.norm(points - points[at], axis=1)
        closer = (gap < near) & ~joined
        via[closer], near[closer] = k, gap[closer]
        near[at] = np.inf
    return order, parent, edge


def grow_trees(anchors: pa.Table, dims: int, exact: bool, block: int = BLOCK) -> list[Tree]:
    """The trees of a group of anchors (``row, vec_id, label, v``)."""
    row, vec_id, label = (anchors.column(c).to_numpy() for c in ("row", "vec_id", "label"))
    v = _matrix(anchors.column("v").combine_chunks(), dims, exact)
    by_label = np.lexsort((row, label))
    trees = []
    for a in range(0, len(by_label), block):
        mine = by_label[a : a + block]
        order, parent, edge = spanning_tree(v[mine])
        mine = mine[order]
        trees.append(Tree(row[mine], vec_id[mine], label[mine], v[mine], parent, edge))
    return trees


def _matrix(lists: pa.Array, dims: int, exact: bool) -> np.ndarray:
    """A list column as a matrix; components that a vector lacks are zero."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), dims), dtype=np.float64 if exact else np.int64)
    if len(flat):
        of = np.repeat(np.arange(len(n)), n)
        out[of, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


class Best:
    """The ``keep`` best (score, id) entries per slot: highest score first,
    ties by smaller id."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.score: list[np.ndarray] = [np.zeros(0, np.int64)] * slots
        self.vec_id: list[np.ndarray] = [np.zeros(0, np.int64)] * slots

    def add(self, slot: int, score: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(score):
            return
        score, vec_id = np.concatenate((self.score[slot], score)), np.concatenate((self.vec_id[slot], vec_id))
        first = np.lexsort((vec_id, -score))[: self.keep]
        self.score[slot], self.vec_id[slot] = score[first], vec_id[first]

    def limit(self, slot: int, given: int) -> int:
        """What a score must reach to matter for this slot."""
        mine = self.score[slot]
        return max(given, int(mine[-1])) if len(mine) == self.keep else given


def walk(
    tree: Tree, c: np.ndarray, same: bool, label: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor by anchor, the candidates ``c`` of its label (``same``) or of
    another one that may score between ``low`` and ``high``, and their scores."""
    norm = np.sqrt((c.astype(np.float64) ** 2).sum(axis=1))
    margin = 1.0 if c.dtype == np.float64 else 8192.0  # beyond what rounding of the bounds can lose
    lower = np.empty((len(tree.row), len(c)))
    upper = np.empty((len(tree.row), len(c)))
    for k in range(len(tree.row)):
        if tree.parent[k] < 0:
            lower[k], upper[k] = -np.inf, np.inf
            need = np.ones(len(c), bool)
        else:
            slack = norm * (tree.edge[k] * (1 + 1e-9)) + margin
            np.subtract(lower[tree.parent[k]], slack, out=lower[k])
            np.add(upper[tree.parent[k]], slack, out=upper[k])
            if low[k] > high[k]:
                continue
            need = (upper[k] >= low[k]) & (lower[k] <= high[k])
            need &= (label == tree.label[k]) == same
        at = np.flatnonzero(need)
        if not len(at):
            continue
        score = (c if len(at) == len(c) else c[at]) @ tree.v[k]
        lower[k, at] = upper[k, at] = score
        fit = (score >= low[k]) & (score <= high[k]) & ((label[at] == tree.label[k]) == same)
        if fit.any():
            yield k, at[fit], score[fit].astype(np.int64)


def _windows(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with ``low * p <= 100 * s <= high * p``: least, largest
    (without a product that a long cannot hold)."""
    hundreds, rest = scores // 100, scores % 100
    return low * hundreds - (-low * rest) // 100, high * hundreds + (high * rest) // 100


def _candidates(batch: pa.RecordBatch, dims: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vec_id, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    return vec_id, label, _matrix(batch.column(2), dims, exact)


def _positives(rows: DataFrame, trees, limits, dims: int, exact: bool, keep: int) -> DataFrame:
    """``anchor, score, vec_id``: each task's best rows of the anchor's label."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0] + [len(t.row) for t in trees.value])
        best = Best(int(base[-1]), keep)
        for batch in it:
            vec_id, label, c = _candidates(batch, dims, exact)
            for t, tree in enumerate(trees.value):
                slots = base[t] + np.arange(len(tree.row))
                low = np.array([best.limit(s, limits.value.get(int(r), -ANY)) for s, r in zip(slots, tree.row)], dtype=np.int64)
                for k, at, score in walk(tree, c, True, label, low, np.full(len(low), ANY)):
                    other = vec_id[at] != tree.vec_id[k]
                    best.add(int(slots[k]), score[other], vec_id[at][other])
        anchor = np.concatenate([t.row for t in trees.value])
        yield from _emitted(best, {"anchor": anchor})

    return rows.select("vec_id", "label", "v").mapInArrow(run, "anchor long, score long, vec_id long")


def _negatives(rows: DataFrame, trees, positives, limits, dims: int, exact: bool, keep: int, low: int, high: int) -> DataFrame:
    """``anchor, place, score, vec_id``: each task's best rows of other labels
    within the window of each positive (``positives``: anchor row to its
    positives' scores, best first)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, place, least, most = [], [], [], []
        slots: list[list[np.ndarray]] = []  # per tree and anchor, its slots
        for tree in trees.value:
            slots.append([])
            for r in tree.row.tolist():
                of, to = _windows(positives.value.get(r, np.zeros(0, np.int64)), low, high)
                slots[-1].append(np.arange(len(anchor), len(anchor) + len(of)))
                anchor += [r] * len(of)
                place += range(len(of))
                least += np.maximum(of, np.array([limits.value.get((r, j), -ANY) for j in range(len(of))], dtype=np.int64)).tolist()
                most += to.tolist()
        best = Best(len(anchor), keep)
        for batch in it:
            vec_id, label, c = _candidates(batch, dims, exact)
            for tree, mine in zip(trees.value, slots):
                wanted = [[(best.limit(s, least[s]), most[s]) for s in own.tolist()] for own in mine]
                wanted = [[w for w in own if w[0] <= w[1]] for own in wanted]
                bottom = np.array([min((a for a, _ in own), default=ANY) for own in wanted], dtype=np.int64)
                top = np.array([max((b for _, b in own), default=-ANY) for own in wanted], dtype=np.int64)
                for k, at, score in walk(tree, c, False, label, bottom, top):
                    other = vec_id[at] != tree.vec_id[k]
                    score, ids = score[other], vec_id[at][other]
                    for s in mine[k].tolist():
                        fit = (score >= best.limit(s, least[s])) & (score <= most[s])
                        best.add(s, score[fit], ids[fit])
        yield from _emitted(best, {"anchor": np.array(anchor, np.int64), "place": np.array(place, np.int32)})

    return rows.select("vec_id", "label", "v").mapInArrow(run, "anchor long, place int, score long, vec_id long")


def _emitted(best: Best, keys: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = np.array([len(s) for s in best.score], dtype=np.int64)
    if not n.sum():
        return
    slot = np.repeat(np.arange(len(n)), n)
    columns = {name: key[slot] for name, key in keys.items()}
    columns |= {"score": np.concatenate(best.score), "vec_id": np.concatenate(best.vec_id)}
    yield pa.RecordBatch.from_pydict({name: pa.array(x) for name, x in columns.items()})


def _first(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    df: DataFrame,
    anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    group: int = GROUP,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` over ``df`` (``vec_id, embedding, label``).

    Components become ``floor(scale * x)``; a score is the inner product, a
    whole number; higher ones come first, ties by smaller id. Anchors are the
    rows that ``anchor`` selects (default: id divisible by 100); an anchor's
    positives are the first rows of its label with another id, its negatives,
    per positive, the first rows of other labels whose score lies between
    ``low`` and ``high`` per cent of the positive's (both included).

    Null or empty ids, labels and vectors, and vectors with a null or
    non-finite component, take no part. A vector shorter than the longest one
    (an empty one too) has zeros in its missing components. Every row counts by itself: a repeated
    row is another candidate, and a repeated anchor gives its rows again. An
    anchor without positives, and a positive whose window is empty (one with a
    negative score), give no rows; an empty table gives none. Scores beyond a
    long raise ValueError. Extra columns are ignored.
    """
    spark = df.sparkSession
    short_batches(spark, BATCH)
    is_anchor = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    v = F.col("`embedding`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(
        F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").cast("long").alias("label"), v.alias("v"), finite.alias("ok")
    ).where("vec_id is not null and label is not null and v is not null and ok")
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    rows = written(
        rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("v")), "neg-rows"
    )
    largest = F.greatest(F.array_max("v"), -F.array_min("v"))
    dims, peak, anchors = rows.agg(
        F.max(F.size("v")), F.max(largest), F.count_if(is_anchor)
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not anchors:
        return spark.createDataFrame([], schema)
    peak = int(peak or 0)
    if dims * peak**2 >= ANY:
        raise ValueError("scores of these vectors do not fit a long: divide the vectors, or take a smaller scale")
    exact = dims * peak**2 < EXACT
    groups = -(-anchors // group)
    share = rows.where(F.pmod(F.xxhash64("row"), F.lit(SHARE)) == 0)
    put = spark.sparkContext.broadcast
    parts = []
    for g in range(groups):
        chosen = rows.where(is_anchor & (F.pmod(F.xxhash64("row", F.lit("group")), F.lit(groups)) == g)).toArrow()
        if not chosen.num_rows:
            continue
        trees = put(grow_trees(chosen, dims, exact, block))
        ids = dict(zip(chosen.column("row").to_pylist(), chosen.column("vec_id").to_pylist()))
        # tables of at most ``positives`` rows per anchor of the group reach the driver
        drawn = _first(_positives(share, trees, put({}), dims, exact, positives), ["anchor"], positives)
        floor = {r.anchor: r.score for r in drawn.where(F.col("rank") == positives).collect()}
        near = _first(_positives(rows, trees, put(floor), dims, exact, positives), ["anchor"], positives).collect()
        mates: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(near, key=lambda r: (r.anchor, r["rank"])):
            mates.setdefault(r.anchor, []).append((r.score, r.vec_id))
        scores = put({a: np.array([s for s, _ in m], dtype=np.int64) for a, m in mates.items()})
        window = (dims, exact, negatives, low, high)
        drawn = _first(_negatives(share, trees, scores, put({}), *window), ["anchor", "place"], negatives)
        floor = {(r.anchor, r.place): r.score for r in drawn.where(F.col("rank") == negatives).collect()}
        found = _first(_negatives(rows, trees, scores, put(floor), *window), ["anchor", "place"], negatives)
        pairs = spark.createDataFrame(
            [(a, j, ids[a], p, s) for a, m in mates.items() for j, (s, p) in enumerate(m)],
            "anchor long, place int, anchor_id long, positive_id long, positive_score long",
        )
        parts.append(
            written(
                found.join(F.broadcast(pairs), ["anchor", "place"]).select(
                    "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
                ),
                "neg-found",
            )
        )
    out = spark.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def oracle(table: str) -> str:
    """The same in SQL, for vectors of one length."""
    return f"""
      WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor({SCALE} * x::DOUBLE) for x in embedding] AS v
        FROM {table}
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
      a AS (SELECT row_number() OVER () AS a, * FROM e WHERE vec_id % 100 = 0),
      s AS (
        SELECT a.a, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
               CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
        FROM a JOIN e c ON a.vec_id <> c.vec_id),
      p AS (
        SELECT a, anchor_id, vec_id, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
        FROM s WHERE same QUALIFY place <= {POSITIVES}),
      n AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
               s.score AS negative_score,
               row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
        FROM p JOIN s ON p.a = s.a AND NOT s.same
          AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
      SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
