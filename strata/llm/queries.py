"""The operators over the test tables, with production parameters.

One query per operator: it reads its whole table, goes through the operator
and derives the columns of its contract. ``ORACLES`` holds DuckDB SQL where
SQL can express the result; the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    ann, hardneg, hostgraph, linededup, mixing, ngramjoin, packing, pii, resample, spotsigs, tokenfiles, toxicity, warc,
)
from strata.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines (source is the host)."""
    return linededup.drop_site_lines(table(spark, sf_dir, "documents"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC files and looked up again through the index."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets reach 0.9."""
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", F.to_json("passes").alias("passes"))


def op5_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    return packing.best_fit_pack(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as packed id matrices, their segments read back."""
    return tokenfiles.read_packed(tokenfiles.write_packed(table(spark, sf_dir, "documents")))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and likenesses."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt outside the held-out fold."""
    labels = toxicity.train_labels(table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced, under the session's key."""
    key = spark.conf.get("spark.strata.surrogateKey", "key of the test tables")
    return pii.replace_entities(table(spark, sf_dir, "documents"), key)


def op11_spanning_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, per positive; every seventh
    vector counts as of the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: rules, else the link graph of hosts."""
    return hostgraph.judge(table(spark, sf_dir, "pages"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored and drawn by their likeness to the benchmark's n-grams."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_warc_index, op3_ngram_jaccard, op4_mix_sources, op5_best_fit_pack,
        op6_token_files, op7_spotsigs, op8_toxicity, op9_projection_forest, op10_surrogates,
        op11_spanning_tree, op12_host_graph, op13_importance,
    )
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": linededup.oracle("documents"),
    "op2_warc_index": """
        WITH p AS (
          SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest FROM pages),
        g AS (
          SELECT digest, min(page_id) AS first FROM p WHERE octet_length(payload) >= 100
          GROUP BY digest HAVING count(*) > 1)
        SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
               CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN g USING (digest)""",
    "op11_spanning_tree": hardneg.oracle("embeddings"),
    "op12_host_graph": hostgraph.oracle("pages"),
}
