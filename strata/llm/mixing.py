"""Mixing sources to target weights by a hypergeometric splitting tree.

1. Targets. Sources share all words by weight; no target exceeds MAX_EPOCHS
   times its source, the excess goes to the others by weight (solved at once:
   sorted by cap over weight, a prefix is capped and the rest share).
2. Blocks. Every document falls into a block of its source by a keyed hash,
   so a block is a random part of the source and blocks are disjoint.
3. Draw. A source gives ``floor(target / size)`` whole passes and, for the
   rest, blocks in permuted order until the target is met; the last block and
   its last document are cut, so the words taken are the target to the word.
4. Splitting tree. The drawn blocks of all sources are the exact quotas.
   Each node halves its quota vector among its children: units are taken in
   turn, each going left with probability (left places) / (units left), which
   draws the halves from the multivariate hypergeometric distribution with
   the totals kept exactly. After log2(shards) levels each shard holds a
   random share of every source, with its unit count fixed.
5. A source's permuted blocks are dealt to shards by these counts and each
   shard is shuffled locally: every task sorts the documents it holds of a
   shard by a keyed hash of document and pass, and writes them in that order.

DataFrame functions only. Texts never move: only ids and sizes are shuffled,
and every group is a (source, block), so a source with a third of all rows is
spread over its blocks. How often and where a document goes depends on its
block alone, but for the one block per source that the target cuts, so texts
meet the table of blocks (at most MAX_BLOCKS a source, small enough to be
broadcast), and only documents of cut blocks, one in some thousands, are joined
one by one. Sources are components of a mixture: their table (one
row each) is handled whole, documents never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import n_words, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SHARDS = 8  # a power of two, at least
SHARD_WORDS = 1 << 27  # words of one shard, about; larger mixes have more shards
BLOCK_DOCS = 1024  # documents in a block of a source that has all documents
MAX_BLOCKS = 4096  # blocks of a source: keeps their table small; beyond, blocks hold more documents
SEED = 20240229


def _unit(*cols: Column) -> Column:
    """Keyed hash of the columns, 0..1."""
    return F.pmod(F.xxhash64(*cols, F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, n`` (one row per source, null is a source) with ``weight`` and ``target``.

    Weights repeat over the sources by code point, null last.
    """
    # the source table: one row per mixture component
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    ranked = sizes.withColumn("weight", weight).withColumn("cap", cap)
    whole = Window.partitionBy(F.lit(0))
    by_cap = whole.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole).cast("double")
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    shared = ranked.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the level of the first source that is not capped holds for all after it
    final = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(whole)
    return (
        shared.withColumn("_final", final["level"])
        .withColumn("target", F.least("cap", F.coalesce(F.col("_final") * F.col("weight"), F.col("cap"))))
        .drop("cap", "level", "capped", "_final")
    )


def _split(quotas: Column, node: Column) -> Column:
    """Left half of a quota array, drawn without replacement."""
    units = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    state = F.struct(
        units.alias("left_over"), F.floor(units / 2).cast("long").alias("places"),
        F.array().cast("array<long>").alias("out"),
    )

    def source(s: Column, q: Column) -> Column:
        first = F.struct(s["left_over"].alias("n"), s["places"].alias("m"), F.lit(0).cast("long").alias("x"))

        def one(a: Column, i: Column) -> Column:
            goes = (_unit(node, F.size(s["out"]), i) * a["n"] < a["m"]).cast("long")
            return F.struct((a["n"] - 1).alias("n"), (a["m"] - goes).alias("m"), (a["x"] + goes).alias("x"))

        drawn = F.when(q > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(q, F.lit(1).cast("long"))), first, one)).otherwise(first)
        return F.struct(
            drawn["n"].alias("left_over"), drawn["m"].alias("places"),
            F.concat(s["out"], F.array(drawn["x"])).alias("out"),
        )

    return F.aggregate(quotas, state, source, lambda s: s["out"])


def shard_quotas(sources: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(s, quota)`` split over shards: ``(s, upto)``, upto[i] = units of the
    source in shards 0..i. ``s`` numbers the sources."""
    listed = F.sort_array(F.collect_list(F.struct("s", "quota")))
    nodes = sources.agg(listed.alias("_l")).select(
        F.lit(1).cast("long").alias("node"),
        F.transform("_l", lambda x: x["s"]).alias("ss"),
        F.transform("_l", lambda x: x["quota"]).alias("quotas"),
    )
    for level in range(shards.bit_length() - 1):
        halves = nodes.withColumn("_left", _split(F.col("quotas"), F.col("node")))
        child = lambda at, q: F.struct((F.col("node") * 2 + at).alias("node"), q.alias("quotas"))
        right = F.zip_with("quotas", "_left", lambda q, x: q - x)
        nodes = written(
            halves.select("ss", F.explode(F.array(child(0, F.col("_left")), child(1, right))).alias("c")).select(
                F.col("c.node").alias("node"), "ss", F.col("c.quotas").alias("quotas")
            ),
            f"mix-level{level}",
        )
    leaves = nodes.select("node", F.explode(F.arrays_zip("ss", "quotas")).alias("z"))
    counts = leaves.groupBy(F.col("z.ss").alias("s")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("node", F.col("z.quotas").alias("q")))), lambda x: x["q"]).alias("q")
    )
    running = F.aggregate(
        "q", F.array().cast("array<long>"),
        lambda a, x: F.concat(a, F.array(x + F.when(F.size(a) > 0, F.try_element_at(a, F.lit(-1))).otherwise(F.lit(0)))),
    )
    return counts.select("s", running.alias("upto"))


def _block(doc_id: Column, body: Column, blocks: int) -> Column:
    return F.floor(_unit(doc_id, body) * blocks).cast("int")


def _plan(docs: DataFrame, weights: tuple[float, ...], max_epochs: int, shards: int | None, block_docs: int) -> tuple[DataFrame, DataFrame, int]:
    """Ids and sizes of all documents, what every block gives (``_source,
    _block``, targets, passes), and the number of blocks."""
    base = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"),
        F.col("`source`").cast("string").alias("source"),
        n_words(F.col("`text`").cast("string")).alias("size"),
        F.xxhash64(F.col("`text`").cast("string")).alias("body"),
    )
    base = written(base, "mix-sizes")
    blocks_of = min(max(1, -(-base.count() // block_docs)), MAX_BLOCKS)
    base = base.withColumn("block", _block(F.col("doc_id"), F.col("body"), blocks_of))
    blocks = written(
        base.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks"
    )
    per_source = blocks.groupBy("source").agg(F.sum("words").alias("source_size"), F.count("*").alias("n"))
    if shards is None:
        words = blocks.agg(F.sum("words")).first()[0] or 0
        shards = max(SHARDS, 1 << max(0, (words // SHARD_WORDS).bit_length()))
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    targets = written(
        source_targets(per_source, weights, max_epochs)
        .withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("epochs", epochs)
        .withColumn("rest", goal - F.col("epochs") * F.col("source_size")),
        "mix-targets",
    )
    placed = blocks.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        "b.source", "b.block", "b.words", "t.s", "t.source_size", "t.target", "t.n", "t.epochs", "t.rest"
    )
    # permuted blocks of a source: MAX_BLOCKS rows at most
    order = Window.partitionBy("s").orderBy(_unit(F.col("s"), F.col("block"), F.lit("order")), "block")
    ahead = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "part", F.greatest(F.lit(0), F.least("words", F.col("rest") - ahead))
    )
    placed = written(placed, "mix-placed")
    quotas = placed.groupBy("s").agg(
        (F.max("n") * F.max("epochs") + F.count_if(F.col("part") > 0)).alias("quota")
    )
    upto = shard_quotas(quotas, shards)
    unit = lambda e: (e * F.col("n") + F.col("rank")).cast("long")

    def piece(e: Column) -> Column:
        e = e.cast("long")
        shard = F.size(F.filter("upto", lambda x: x <= unit(e)))
        return F.struct(e.alias("pass"), shard.alias("shard"))

    dealt = placed.join(upto, "s").select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "source_size", "target", "epochs", "part", "words",
        F.when(F.col("epochs") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("epochs") - 1, F.lit(0).cast("long"))), piece))
        .otherwise(F.array().cast("array<struct<pass:bigint,shard:int>>")).alias("full"),
        piece(F.col("epochs")).alias("last"),
    )
    return base, written(dealt, "mix-dealt"), blocks_of


def _cut_within(base: DataFrame) -> DataFrame:
    """Words of a block ahead of each of its documents, in permuted order; the
    document that meets the target is cut."""
    within = Window.partitionBy("source", "block").orderBy(
        _unit(F.col("doc_id"), F.col("body"), F.lit("within")), "doc_id", "body"
    ).rowsBetween(Window.unboundedPreceding, -1)
    return base.withColumn("_ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))


def _same_block() -> Column:
    return F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))


def _place(x: Column, doc_id: Column, body: Column) -> Column:
    """Where a document stands in its shard: a keyed hash of it and its pass."""
    return F.xxhash64(doc_id, body, x["pass"], F.lit(SEED))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    shards: int | None = None,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """What the mix takes of every row of ``docs`` (``doc_id, text, source``).

    Returns one row per row: ``doc_id, source, size, source_size, target,
    taken, body`` (hash of the text) and ``passes``, an array of ``(pass,
    shard, place, words)``: in that shard, at the rank that ``place`` gives,
    the first ``words`` words of the text. Null text: size 0. A null source
    is a source. Repeated rows are documents of their own. Extra columns are
    ignored. Reruns give the same rows. ``shards`` must be a power of two;
    without it their number follows the words of ``docs``.
    """
    base, dealt, _ = _plan(docs, weights, max_epochs, shards, block_docs)
    joined = _cut_within(base).join(dealt, _same_block())
    rest = F.greatest(F.lit(0), F.least("size", F.col("part") - F.col("_ahead")))
    as_row = lambda x, words: F.struct(
        x["pass"].alias("pass"), x["shard"].alias("shard"),
        _place(x, F.col("doc_id"), F.col("body")).alias("place"), words.cast("long").alias("words"),
    )
    return joined.withColumn("_rest", rest).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("epochs") + F.col("_rest")).cast("long").alias("taken"), "body",
        F.filter(
            F.concat(
                F.transform("full", lambda x: as_row(x, F.col("size"))),
                F.array(as_row(F.col("last"), F.col("_rest"))),
            ),
            lambda x: x["words"] > 0,
        ).alias("passes"),
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its first ``words`` words, spacing kept."""
    piece = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(piece, F.lit(1), F.greatest(words, F.lit(0)).cast("int")), "")


def mixed_rows(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    shards: int | None = None,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """The documents as ``mix`` takes them: one row per pass over a document,
    each task's rows shard by shard, shuffled within each.

    Columns of ``docs`` (which must have ``doc_id, text, source``; ``n_chars``
    follows the text) and ``mix_shard, mix_place`` (in place of columns of that
    name): written by shard and sorted by place, a task's file of a shard is a
    shuffled run. The cut document of a source holds its first words only;
    documents without words are not taken. Of repeated rows of one id and text
    that include the cut one, each holds the most words any of them does."""
    base, dealt, blocks_of = _plan(docs, weights, max_epochs, shards, block_docs)
    names = [c for c in docs.columns if c not in ("mix_shard", "mix_place")]
    text, doc_id = F.col("`text`").cast("string"), F.col("`doc_id`").cast("long")
    body = F.xxhash64(text)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col("`source`").cast("string").alias("source"),
        doc_id.alias("id"), body.alias("body"), _block(doc_id, body, blocks_of).alias("block"),
    ).where(F.coalesce(F.col("doc.text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    met = rows.join(dealt, _same_block())
    cut = (F.col("part") > 0) & (F.col("part") < F.col("words"))
    taken = F.concat("full", F.when(F.col("part") > 0, F.array("last")).otherwise(F.array().cast("array<struct<pass:bigint,shard:int>>")))
    uncut = met.where(~cut).select("doc", "id", "body", F.lit(None).cast("long").alias("most"), F.explode(taken).alias("x"))
    # documents of cut blocks: all of a full pass, and of the last one what the target leaves
    ends = _cut_within(base.join(dealt.where(cut).select("_source", "_block", "part"), _same_block()))
    ends = ends.withColumn("rest", F.greatest(F.lit(0), F.least("size", F.col("part") - F.col("_ahead"))))
    ends = ends.groupBy("doc_id", "body").agg(F.max("rest").alias("most"), F.first("size").alias("size"))
    ends = ends.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "most", "size")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    at_end = met.where(cut).join(ends, same)
    whole = F.lit(None).cast("long")
    passes = F.concat(
        F.transform("full", lambda x: F.struct(whole.alias("most"), x.alias("x"))),
        F.array(F.struct(F.when(F.col("most") < F.col("size"), F.col("most")).alias("most"), F.col("last").alias("x"))),
    )
    at_end = at_end.select("doc", "id", "body", F.explode(passes).alias("p")).select("doc", "id", "body", "p.most", "p.x")
    out = uncut.union(at_end.where("most is null or most > 0"))
    own = F.col("doc.`text`")
    own = F.when(F.col("most").isNotNull(), first_words(own, F.col("most"))).otherwise(own)
    out = out.select(
        *[own.alias(c) if c == "text" else F.length(own).cast("long").alias(c) if c == "n_chars" else F.col(f"doc.`{c}`").alias(c) for c in names],
        F.col("x.shard").alias("mix_shard"), _place(F.col("x"), F.col("id"), F.col("body")).alias("mix_place"),
    )
    return out.sortWithinPartitions("mix_shard", "mix_place")
