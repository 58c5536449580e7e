import pytest
from pyspark.sql import functions as F

from strata.operators import marts
from strata.session import PIPELINE_CONF, apply_pipeline_conf, scratch_path, shared_dir
from strata.sources import fs


def test_pipeline_settings_applied(spark):
    apply_pipeline_conf(spark)
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled"):
        assert spark.conf.get(key) == PIPELINE_CONF[key]


def test_scratch_lives_under_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured.rstrip("/") == base
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base + "/strata/x-") and a != b


def test_text_files_replace_and_read(spark, tmp_path):
    path = str(tmp_path / "d" / "_CURRENT")
    assert fs.read_text(spark, path) is None
    fs.write_text(spark, path, "v1")
    fs.write_text(spark, path, "v2")
    assert fs.read_text(spark, path) == "v2"
    assert fs.has_data(spark, str(tmp_path / "d")) is False  # names starting with _ are not data
    fs.rename(spark, str(tmp_path / "d"), str(tmp_path / "e" / "d"))
    assert fs.exists(spark, str(tmp_path / "e" / "d" / "_CURRENT"))
    fs.delete(spark, str(tmp_path / "e"))
    assert not fs.exists(spark, str(tmp_path / "e"))


ROWS = 1_500_000


def grouped(spark):
    """Keys and counts, as the uniqueness gates shuffle them (gate_unique)."""
    return spark.range(ROWS).selectExpr("id + 1 AS id").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def anti_joined(spark):
    """Keys against another table's keys (gate_other_table)."""
    return grouped(spark).join(spark.range(0, -ROWS, -1).distinct().hint("merge"), "id", "left_anti")


def dealt(spark):
    """Lines dealt by file and sorted (quarantine_raw_lines)."""
    rows = spark.range(ROWS).select(F.floor(F.col("id") / 10_000).alias("part"), F.concat("id", F.lit(",1,2.5,x,2024-01-01")).alias("value"))
    return rows.repartition("part").sortWithinPartitions("part", "value")


def sums(spark):
    """Sums per customer and month of many customers (orders_by_region)."""
    sales = spark.range(700_000).selectExpr("id", "id AS customer_id", "pmod(xxhash64(id), 100000) / 100D AS price", "date'2024-01-05' AS sale_date")
    customers = spark.range(700_000).selectExpr("id AS customer_id", "sha2(cast(id AS string), 256) AS uf")
    return marts.sales_summary(sales, customers, strategy="pre_aggregate", ordered=False)


@pytest.mark.parametrize("rows", [grouped, anti_joined, dealt, sums])
def test_a_task_reads_a_bounded_share_of_compact_rows(spark, rows):
    """Rows that compress well are not all merged into one task."""
    apply_pipeline_conf(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        most = rows(spark).groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert most[1] >= 700_000 and most[0] <= most[1] * 0.7
