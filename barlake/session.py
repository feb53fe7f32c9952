"""Spark session helpers: UTC clock, AQE, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every barlake job wants. Shuffle partitions are left to the caller
# (cluster default or test value); AQE coalesces small shuffles at runtime and
# splits skewed join partitions.
_JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpointed lineage cuts are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # AQE merges small shuffle partitions up to this size and splits skewed ones
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # the size check for sides that grow with the data (dimensions, key sets,
    # per-ticker summaries): AQE broadcasts one only when its measured size is
    # below this, otherwise the shuffle join stays
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}

# On a cluster, start shuffles wide and let AQE coalesce: AQE can merge small
# partitions but never split a 500 GB one (what 200 partitions of a 100 TB
# shuffle would be). Only applied when the submitter has not chosen a value.
CLUSTER_INITIAL_PARTITIONS = 16384


def build_session(
    master: str | None = None,
    app_name: str = "barlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the job settings above.

    ``master`` is only set when given, so on a cluster the submitter decides.
    The web UI stays off: jobs here are non-interactive.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in _JOB_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    if not spark.sparkContext.master.startswith("local") and not shuffle_partitions:
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(CLUSTER_INITIAL_PARTITIONS))
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All stored times are naive UTC; the session clock must agree."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read ``spark.checkpoint.dir`` from the session. Only when it is unset (a
    local test run) is a private folder created and registered, so a cluster
    never ends up writing to a machine-local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="barlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", local)
        spark.sparkContext.setCheckpointDir(local)
        return local
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def join_path(base: str, *parts: str) -> str:
    """Join URI or local path segments without touching the file system."""
    out = base.rstrip("/")
    for part in parts:
        out = f"{out}/{part.strip('/')}"
    return out if "://" in base else os.path.normpath(out)
