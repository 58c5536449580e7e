"""Corpus pipeline: toxicity, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and
returns a DataFrame; ``run`` writes every stage's rows as Parquet in the
shared folder and hands the table read back to the next stage. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import linededup, mixing, ngramjoin, packing, toxicity
from strata.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity models reject go; null ids are scored by nobody
    and stay. Learnt from the label rows outside the held-out fold."""
    labels = toxicity.train_labels(table(spark, sf_dir, "labels"))
    bad = toxicity.toxicity(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("bad")).distinct().alias("b")
    return docs.alias("d").join(bad, F.col("d.doc_id") == F.col("b.bad"), "left_anti")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text."""
    out = linededup.drop_site_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (5 words, 0.8)."""
    return ngramjoin.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them; each task's rows
    shard by shard, shuffled within each."""
    return mixing.mixed_rows(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_pack", pack),
]

# Models, keyed permutations and tokenizer ids are beyond SQL: each stage is
# tested against a plain version on a small fixture instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
