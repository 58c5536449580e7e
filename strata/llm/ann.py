"""Nearest neighbours by a forest of random-projection trees.

Each tree splits a sample by random hyperplanes between two sample points, at
the median, until a leaf is small. The fitted forest has a fixed bound (at
most SAMPLE points per tree); every vector is then sent down every tree and
indexed under its leaf. A query walks all trees through one shared priority
queue, always opening the node whose worst split margin is best, until the
leaves taken hold enough vectors of all trees together. How many are enough is
measured on the table itself: the exact neighbours of CALIBRATE queries are
found by brute force, and the search goes as far as RECALL of them need (at
least SEARCH_VECTORS). Queries meet the vectors of their leaves in blocks of
bounded size; the exact distances of the candidates decide. The first leaf of
each tree goes ahead: the distances found there bound what the other leaves
may still return, so what a query gathers does not grow with the leaves read.

Equal vectors are one point of the index: it keeps its TOP + 1 smallest ids,
more can never be among the nearest. So a vector that a third of all rows
share neither fills a leaf nor gathers in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import short_batches, written

TOP = 10
TREES = 12
SAMPLE = 1 << 16  # points that the forest is fitted on, at most
LEAF = 64  # sample points of a leaf, at most
SEARCH_VECTORS = 6000  # index entries looked at per query, over all trees, at least
CALIBRATE = 256  # queries whose exact neighbours say how many entries it takes
RECALL = 0.95  # share of those neighbours that the search has to reach
BLOCK = 2048  # vectors of one block of a leaf
SEED = 7


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v`` (double) of the vectors that take part."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


class Forest:
    """Arrays per tree: split normals and offsets, children, leaf numbers."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int):
        self.trees = []
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            normals, offsets, kids = [], [], []
            leaves = 0
            stack = [(np.arange(len(sample)), -1, 0)]
            root = 0
            while stack:
                rows, parent, side = stack.pop()
                if len(rows) <= leaf:
                    me, leaves = -1 - leaves, leaves + 1
                else:
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    normal = a - b
                    if not normal.any():
                        normal = rng.standard_normal(sample.shape[1])
                    normal = normal / np.linalg.norm(normal)
                    along = sample[rows] @ normal
                    cut = float(np.median(along))
                    left = along < cut
                    if left.all() or not left.any():
                        left = rng.random(len(rows)) < 0.5
                    me = len(normals)
                    normals.append(normal)
                    offsets.append(cut)
                    kids.append([0, 0])
                    stack += [(rows[left], me, 0), (rows[~left], me, 1)]
                if parent >= 0:
                    kids[parent][side] = me
                else:
                    root = me
            dim = sample.shape[1]
            self.trees.append(
                (np.array(normals).reshape(-1, dim).astype(np.float32), np.array(offsets), np.array(kids, dtype=np.int64).reshape(-1, 2), root, leaves)
            )

    def leaves(self, t: int, vectors: np.ndarray) -> np.ndarray:
        normals, offsets, kids, root, _ = self.trees[t]
        at = np.full(len(vectors), root, dtype=np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", vectors[inner].astype(np.float32), normals[node]) >= offsets[node]).astype(np.int64)
            at[inner] = kids[node, side]
        return -1 - at

    def walk(self, q: np.ndarray, counts: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """All leaves with entries, best margin first: tree, leaf, entries."""
        q = q.astype(np.float32)
        queue = [(-np.inf, t, tree[3]) for t, tree in enumerate(self.trees)]
        heapq.heapify(queue)
        while queue:
            worst, t, node = heapq.heappop(queue)
            if node < 0:
                if n := int(counts[t][-1 - node]):
                    yield t, -1 - node, n
                continue
            normals, offsets, kids, _, _ = self.trees[t]
            margin = float(normals[node] @ q - offsets[node])
            # the priority is the larger of the losses met on the way
            heapq.heappush(queue, (max(worst, margin), t, int(kids[node, 0])))
            heapq.heappush(queue, (max(worst, -margin), t, int(kids[node, 1])))

    def search(self, q: np.ndarray, counts: list[np.ndarray], want: int) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) by best margin until ``want`` entries."""
        found, have = [], 0
        for t, leaf, n in self.walk(q, counts):
            found.append((t, leaf))
            have += n
            if have >= want:
                break
        return found

    def needs(self, q: np.ndarray, counts: list[np.ndarray], homes: list[list[int]]) -> list[int]:
        """Entries that ``search`` must want to reach each of some vectors,
        given the leaf of every tree that holds it."""
        waiting: dict[tuple[int, int], list[int]] = {}
        for i, home in enumerate(homes):
            for t, leaf in enumerate(home):
                waiting.setdefault((t, leaf), []).append(i)
        need: dict[int, int] = {}
        have = 0
        for t, leaf, n in self.walk(q, counts):
            for i in waiting.get((t, leaf), ()):
                need.setdefault(i, have + 1)
            if len(need) == len(homes):
                break
            have += n
        return list(need.values())


def _points(vectors: DataFrame, top: int) -> DataFrame:
    """Distinct vectors ``point, v, ids`` with their top + 1 smallest ids."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = vectors.distinct().withColumn("_r", rank).where(F.col("_r") <= top + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("point"), F.col("v"), "ids"
    )


def _effort(points: DataFrame, queries: DataFrame, shared, counts: list[np.ndarray], top: int, seed: int) -> int:
    """Index entries a query has to look at so that RECALL of the exact
    nearest other points of a fixed number of queries are among them."""
    drawn = queries.select("v").distinct().orderBy(F.xxhash64("v", F.lit(seed))).limit(CALIBRATE).collect()
    if not drawn:
        return 0
    asked = np.array([r[0] for r in drawn], dtype=np.float64)

    def exact(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = np.full((len(asked), 0), np.inf)
        homes = np.zeros((len(asked), 0, len(shared.value.trees)), dtype=np.int64)
        for part in it:
            m = np.stack(part["v"].to_numpy())
            d = (asked**2).sum(axis=1)[:, None] + (m**2).sum(axis=1) - 2 * (asked @ m.T)
            near = np.argsort(d, axis=1, kind="stable")[:, : top + 1]
            d = np.take_along_axis(d, near, axis=1)
            mine, at = np.unique(near, return_inverse=True)
            leaf = np.stack([shared.value.leaves(t, m[mine]) for t in range(len(shared.value.trees))], axis=1)
            # the point itself is no neighbour: every other point differs from it
            d[(m[near] == asked[:, None, :]).all(axis=2)] = np.inf
            score = np.concatenate((score, d), axis=1)
            homes = np.concatenate((homes, leaf[at.reshape(near.shape)]), axis=1)
            best = np.argsort(score, axis=1, kind="stable")[:, :top]
            score = np.take_along_axis(score, best, axis=1)
            homes = np.take_along_axis(homes, best[:, :, None], axis=1)
        q, k = np.nonzero(np.isfinite(score))
        yield pd.DataFrame({"q": q, "score": score[q, k], "homes": pd.Series(list(homes[q, k]), dtype=object)})

    found = points.select("v").mapInPandas(exact, "q int, score double, homes array<long>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "homes"))
    homes: dict[int, list[list[int]]] = {}
    for r in found.withColumn("_r", rank).where(F.col("_r") <= top).collect():  # CALIBRATE * top rows
        homes.setdefault(r["q"], []).append(r["homes"])
    needs = sorted(n for q, near in homes.items() for n in shared.value.needs(asked[q], counts, near))
    return needs[min(len(needs) - 1, int(RECALL * len(needs)))] if needs else 0


def nearest(
    df: DataFrame,
    query: Column | None = None,
    top: int = TOP,
    trees: int = TREES,
    sample: int = SAMPLE,
    search_vectors: int = SEARCH_VECTORS,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` over ``df`` (``vec_id, embedding``).

    Queries are the rows that ``query`` selects (default: id divisible by
    100); candidates are all rows but the query's own. score is the Euclidean
    distance in doubles; ties go to the smaller id; with fewer than ``top``
    candidates all are returned. Null, zero and non-finite vectors, vectors
    with a null component and rows without an id take no part, nor do vectors
    of another length than the most common one (ties: the shorter). Repeated
    rows count once; an id with several vectors counts with each. Extra
    columns are ignored.
    """
    spark = df.sparkSession
    short_batches(spark, 2048)
    query = F.col("vec_id") % 100 == 0 if query is None else query
    rows = valid_vectors(df)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    rows = written(rows.where(F.size("v") == sizes[0]["d"]), "ann-vectors")
    points = written(_points(rows, top), "ann-points")
    # a documented bound: SAMPLE distinct vectors, drawn by a keyed hash
    total = points.count()
    share = min(1.0, sample / max(total, 1))
    drawn = points.where(F.pmod(F.xxhash64("point", F.lit(seed)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    fitted = np.array([r[0] for r in drawn.select("v").limit(sample).collect()], dtype=np.float64)
    forest = Forest(fitted, trees, LEAF, seed)
    shared = spark.sparkContext.broadcast(forest)

    def index(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            m = np.stack(part["v"].to_numpy())
            for t in range(trees):
                yield pd.DataFrame({"tree": t, "leaf": shared.value.leaves(t, m), "point": part["point"]})

    entries = written(
        points.select("point", "v").mapInPandas(index, "tree int, leaf long, point long"), "ann-entries"
    )
    counts = [np.zeros(tree[4], dtype=np.int64) for tree in forest.trees]
    for t, leaf, n in entries.groupBy("tree", "leaf").count().collect():  # as many as the forest has leaves
        counts[t][leaf] = n
    known = spark.sparkContext.broadcast(counts)

    queries = rows.where(query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    want = max(search_vectors, _effort(points, queries, shared, counts, top, seed))

    def probe(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            out = []
            for q, v in zip(part["query_id"], part["v"]):
                homes: set[int] = set()
                for t, leaf in shared.value.search(np.asarray(v), known.value, want):
                    out.append((q, t, leaf, int(-(-known.value[t][leaf] // BLOCK)), t not in homes))
                    homes.add(t)
            if out:
                yield pd.DataFrame(out, columns=["query_id", "tree", "leaf", "blocks", "home"])

    spread = queries.repartition(spark.sparkContext.defaultParallelism * 4, "query_id")
    probes = written(
        spread.mapInPandas(probe, "query_id long, tree int, leaf long, blocks int, home boolean"), "ann-probes"
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # as many rows as the forest has leaves
    sizes = entries.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    hit = entries.join(F.broadcast(sizes), ["tree", "leaf"]).join(points.select("point", "v"), "point")
    hit = hit.withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))

    def rank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not (len(left) and len(right)):
            return pd.DataFrame({"query_id": [], "point": [], "score": []})
        right = right.sort_values("point")  # stable sorts then settle ties by id
        m, ids = np.stack(right["v"].to_numpy()), right["point"].to_numpy()
        asked, names, bound = np.stack(left["v"].to_numpy()), left["query_id"].to_numpy(), left["bound"].to_numpy()
        step = max(1, (1 << 21) // m.size)  # queries at once: bounds the temporary arrays
        out = []
        for k in range(0, len(asked), step):
            d = np.sqrt(((m - asked[k : k + step, None, :]) ** 2).sum(axis=2))
            best = np.argsort(d, axis=1, kind="stable")[:, : top + 1]
            d = np.take_along_axis(d, best, axis=1)
            q, j = np.nonzero(d <= bound[k : k + step, None])
            out.append((names[k : k + step][q], ids[best[q, j]], d[q, j]))
        return pd.DataFrame(dict(zip(("query_id", "point", "score"), map(np.concatenate, zip(*out)))))

    keys = ["tree", "leaf", "block"]

    def candidates(asked: DataFrame) -> DataFrame:
        pairs = asked.groupBy(*keys).cogroup(hit.groupBy(*keys)).applyInPandas(rank, "query_id long, point long, score double")
        return pairs.groupBy("query_id", "point").agg(F.min("score").alias("score"))

    vectors = queries.withColumn("bound", F.lit(float("inf")))
    by_query = Window.partitionBy("query_id").orderBy("score", "point")
    near = written(
        candidates(probes.where("home").join(vectors, "query_id"))
        .withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= top + 1),
        "ann-near",
    )
    # an id with several vectors asks with each: the bound is of all its points
    bounds = near.where(F.col("r") == top + 1).select("query_id", F.col("score").alias("reached"))
    several = queries.groupBy("query_id").count().where("count > 1").select("query_id", F.lit(True).alias("several"))
    bounded = queries.join(bounds, "query_id", "left").join(several, "query_id", "left").select(
        "query_id", "v", F.when(F.col("several"), float("inf")).otherwise(F.coalesce("reached", F.lit(float("inf")))).alias("bound")
    )
    further = candidates(probes.where("not home").join(bounded, "query_id"))
    found = near.select("query_id", "point", "score").union(further).groupBy("query_id", "point").agg(F.min("score").alias("score"))
    by_point = Window.partitionBy("query_id").orderBy("score", "point")
    close = found.withColumn("_r", F.row_number().over(by_point)).where(F.col("_r") <= top + 1)
    named = close.join(points.select("point", "ids"), "point").select("query_id", "score", F.explode("ids").alias("vec_id"))
    named = named.where("vec_id <> query_id").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score"
    )
