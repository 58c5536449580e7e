"""SpotSigs fingerprints: chains of content words after common-word anchors.

A text's spots are its common words (of four languages), its start, its line
starts and the marks that end words or cells, so that lists and tables, which
have hardly any common words, have spots too. The signature at a spot is the chain of the next CHAIN words
that are not common; a fingerprint is the set of a text's signatures. Edits
in one place leave the chains elsewhere alone.

Two fingerprints are compared by Jaccard similarity. Sets whose lengths are
too far apart can't be similar, so ``similar_pairs`` first deals sets to
partitions of set length whose bounds grow by 1 / threshold: only equal and
neighbouring partitions can hold similar sets. Within these, sets meet by
their rarest signatures (as many as the threshold allows to miss, plus one).

DataFrame functions only, all JVM-side: texts are normalised by regular
expressions and chains are cut out by one pattern with a lookahead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

CHAIN = 2
# Common words of English, German, French and Spanish.
ANCHORS = (
    "the a an and of to in is was for on that with as be by at are it this from or have not but had he she they "
    "der die das und den dem des ein eine von zu ist mit sich auf im nicht es als auch "
    "le la les un une du et est dans pour par sur que qui au aux il elle pas "
    "el los las de del y en para se con por una lo su al"
).split()
_LONGEST_FIRST = sorted(set(ANCHORS), key=lambda w: (-len(w), w))


def _normal(text: Column) -> Column:
    """Words in lower case, one blank between, '#' for every spot."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, r"[\r\n]+|[^\p{L}\p{N}\s]+(?=\s|$)", " \u0001 ")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\u0001]+", " ")
    t = F.concat(F.lit(" # "), F.translate(t, "\u0001", "#"), F.lit(" "))
    t = F.regexp_replace(t, r"(?<= )(?:" + "|".join(_LONGEST_FIRST) + r")(?= )", "#")
    return F.regexp_replace(t, r"[ ]+", " ")


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit signatures of a text. A chain that the end of
    the text cuts short still counts; a text of common words only has none."""
    word = r"(?: #)* [^# ]+"
    spot = r"#(?=(" + word + r"(?:" + word + r"){0," + str(chain - 1) + r"}))"
    chains = F.regexp_extract_all(_normal(text), F.lit(spot), F.lit(1))
    return F.array_sort(
        F.array_distinct(F.transform(chains, lambda c: F.hash(F.regexp_replace(c, "[# ]+", " "))))
    )


def fingerprint(sigs: Column) -> Column:
    """Printable form: eight hexadecimal digits per signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without looking where the
    lengths alone rule the threshold out. Two empty sets are alike."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    jaccard = common / (F.size(a) + F.size(b) - common)
    return F.when(large == 0, 1.0).when((small == 0) | (small < threshold * large), 0.0).otherwise(jaccard)


def length_partition(size: Column, threshold: float) -> Column:
    """Number of the set-length partition: bounds grow by 1 / threshold."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.log(F.lit(1 / threshold))).cast("int")


def similar_pairs(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``a, b, likeness`` of the pairs of distinct signature sets that reach
    the threshold; a and b are the smallest ids of their sets, a < b.

    Rows with equal sets are one class and not paired; empty sets pair with
    nothing; rows without an id are left out. Extra columns are ignored.
    """
    sets = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), signatures(F.col(f"`{text}`").cast("string")).alias("s"))
    sets = written(sets.where("id is not null and size(s) > 0").groupBy("s").agg(F.min("id").alias("id")), "spot-sets")
    sigs = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("g"))
    often = sigs.groupBy("g").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("f", "g"))
    shown = sigs.join(often, "g").withColumn("_r", rank).where(F.col("_r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    shown = written(shown.select("g", "id", "n", length_partition(F.col("n"), threshold).alias("part")), "spot-index")
    x, y = shown.alias("x"), shown.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1))).alias("y")
    near = (F.col("x.g") == F.col("y.g")) & (F.col("x.part") == F.col("y.part"))
    close = F.least("x.n", "y.n") >= F.lit(threshold) * F.greatest("x.n", "y.n")
    pairs = x.join(y, near & close & (F.col("x.id") != F.col("y.id"))).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()
    sa, sb = (sets.select(F.col("id").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    scored = pairs.join(sa, "a").join(sb, "b").select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness"))
    return scored.where(F.col("likeness") >= threshold)


def with_next(docs: DataFrame, columns: list[str], parts: int, made: Mapping[str, Column] | None = None) -> DataFrame:
    """``docs`` (``doc_id, text`` and ``columns``) with ``next`` and
    ``next_<column>``: those of the next row by (doc_id, text hash), nulls
    last; the last row's next is the first. ``made`` are columns computed from
    a row, once it is known which rows are wanted.

    Ranges of ids are windows of their own. Each range also gets the first
    rows of the next range that has rows, so no window spans the table.
    """
    spread = [i / parts for i in range(1, parts)]
    bounds = (docs.agg(F.percentile_approx("doc_id", spread, 10000)).first()[0] or []) if spread else []
    bounds = sorted(set(bounds))
    # null ids come last, in ranges of the text hash that orders them
    range_of_hash = F.floor((F.col("_tie") / float(1 << 64) + 0.5) * parts)
    range_of_id = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1) + range_of_hash).otherwise(range_of_id).cast("int")
    rows = docs.withColumn("_tie", F.xxhash64("text")).withColumn("_part", part)
    # the first row of every range: as many as there are ranges
    firsts = rows.groupBy("_part").agg(F.min(F.struct("doc_id", "_tie")).alias("f")).orderBy("_part").collect()
    if not firsts:
        found = docs.withColumns(dict(made or {}))
        return found.withColumns({"next": F.lit(None).cast("string")} | {f"next_{c}": F.col(c) for c in columns})
    marks = docs.sparkSession.createDataFrame(
        [(firsts[k - 1]["_part"], f["f"]["doc_id"], f["f"]["_tie"], int(k == 0)) for k, f in enumerate(firsts)],
        "_to int, _id long, _hash long, _wrap int",
    )
    heads = rows.join(F.broadcast(marks), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_hash")))
    heads = heads.drop("_part", "_id", "_hash").withColumnRenamed("_to", "_part")
    both = rows.withColumn("_wrap", F.lit(-1)).unionByName(heads).withColumns(dict(made or {}))
    order = Window.partitionBy("_part").orderBy(F.col("_wrap") >= 0, F.col("_wrap"), F.col("doc_id").asc_nulls_last(), "_tie")
    out = both.withColumns(
        {"next": F.lead("text").over(order)} | {f"next_{c}": F.lead(c).over(order) for c in columns}
    )
    return out.where("_wrap < 0").drop("_part", "_tie", "_wrap")


def edited_text(text: Column, other: Column) -> Column:
    """The last floor(n/4) code points replaced by the first as many (or all)
    of another text."""
    n = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(other, F.lit(1), n))


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every row of ``docs`` (``doc_id, text``), of its edited
    text, and their likeness: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, length_partition``.

    Null text is empty. A single row is its own next. Rows are ordered by id,
    then text; null ids come last. Extra columns are ignored.
    """
    rows = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"), F.coalesce(F.col("`text`").cast("string"), F.lit("")).alias("text")
    )
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paired = with_next(rows, ["sigs"], min(4 * parts, 1000), {"sigs": signatures(F.col("text"))})
    own = paired.withColumn("edited", edited_text(F.col("text"), F.col("next")))
    own = own.withColumn("esigs", signatures(F.col("edited")))
    return own.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("esigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("esigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_partition(F.size("sigs"), 0.8).alias("length_partition"),
    )
