"""SparkSession with the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the reports depend on for correct results (timezone, ANSI) and for
# scale (AQE re-plans joins and coalesces partitions at runtime, splits skewed
# partitions of sort-merge joins).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Suggested settings for a large cluster (applied with ``get_spark(profile="cluster")``;
# the submitter's own values win). Partitions start fine-grained and AQE merges
# them to ~256 MB; files are split at 256 MB; broadcast stays automatic (AQE
# measures each join side at runtime) and capped at 64 MB.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # deals are reduced to those of the anchor snapshot by a Bloom filter before they are exchanged
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1024 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(1024 * 1024 * 1024),
}

# session-start settings: no web UI (no port opened), no console progress bars
STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pipewright", extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with ``BASE_CONF`` applied.

    ``master``/``shuffle_partitions`` are only for local runs; on a cluster the
    submitter sets them and they are left alone here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**STATIC_CONF, **BASE_CONF}.items():
        b = b.config(k, v)
    if profile == "cluster":
        active = SparkSession.getActiveSession()
        for k, v in CLUSTER_CONF.items():
            if active is None or active.conf.get(k, None) is None:
                b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    if _is_local(spark) or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter names a shared folder; it is read, never
    replaced, and a missing setting is an error (a machine-local folder would
    not survive the loss of that machine). Only in local mode (tests) is a
    private folder created when the setting is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        d = tempfile.mkdtemp(prefix="pipewright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and go on from it.

    Later steps read the same rows whatever is recomputed, a lost executor costs
    no recomputation of what came before, and Spark knows the table's size."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# settings a query's *result* depends on; set on whatever session runs it
RESULT_CONF = {"spark.sql.session.timeZone": "UTC"}


def pin_result_settings(spark: SparkSession) -> None:
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
