"""Spark session settings and the shared working folder.

The pipeline relies on three session properties:

* UTC session time zone, so ``current_timestamp`` and date casts agree
  across executors in different zones;
* ANSI mode on (the 4.x default), so a bad number or date in a landing
  file fails the batch instead of turning into NULL;
* adaptive execution on, so join strategy, skew splits and shuffle
  partition counts are decided from runtime sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pipeline session needs; a cluster may add to them.
PIPELINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle output to the advisory size, not to the default
    # parallelism: small results (the gold mart) become few right-sized files
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # that size is counted as compressed: rows of keys and counts take ten
    # times as much and more in the hash table or sort of the task that reads them
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition directories are written whole (staged, then swapped in),
    # never merged into, so static overwrite is the only mode used.
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# Without these, casts and dates silently give other results.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(PIPELINE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_pipeline_conf(spark)
    return spark


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable pipeline settings to an existing session."""
    for key, value in PIPELINE_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a shared session: keep the cluster's value
            if key in REQUIRED and spark.conf.get(key, "").lower() != value.lower():
                raise


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach
    (HDFS, object store). Only when it is unset, as in local tests, a
    folder under the system temp directory is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the shared scratch folder."""
    leaf = "-".join(p for p in parts if p) or "scratch"
    return f"{shared_dir(spark)}/strata/{leaf}-{uuid.uuid4().hex[:12]}"
