"""Spark session construction and session-scoped settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  ANSI stays on (Spark 4
# default); operators use try_* functions where the data can be dirty.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of lookups written per query are removed once their
    # frames are garbage-collected (they would otherwise accumulate)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    Without ``master`` it is spark-submit's or the configuration's, and
    ``local[*]`` where those name none: a master set here would override
    spark-submit's.  Shuffle partitions default to the core count for local
    runs; on a cluster set ``spark.sql.shuffle.partitions`` from the data
    size (roughly input bytes / 128 MB) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if _is_local(spark):
        cores = os.cpu_count() or 8
        # a root of many folders is listed by up to 10,000 tasks, which suits a cluster only
        defaults = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * cores)}
        if not shuffle_partitions:
            defaults["spark.sql.shuffle.partitions"] = str(cores)
        given = spark.sparkContext.getConf()
        for key, value in defaults.items():
            if not given.contains(key):
                spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  A scratch folder is
    set only when it is unset and the master is local (tests): on a cluster
    executors could not see it, so there an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint folder: two
    applications on one input never touch each other's tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlake-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (call it before
    ``spark.stop()``; what an application that died left is named after it)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
