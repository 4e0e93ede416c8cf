"""Session construction and the shared working folder.

The shared folder is the one named by ``spark.checkpoint.dir`` (HDFS / object
store), read from the running session. A session on a cluster must name one. Only
a ``local`` master, whose executors are the driver, may do without: it gets a
folder of its own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every towerlens job relies on: calendar parts, hour labels and
# event-time windows are UTC; AQE re-plans shuffles from runtime sizes.
# (Lake tables are always read with an explicit schema, so zero-padded text
# partition values never depend on partition type inference.)
_JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "towerlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the job settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_JOB_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = os.environ.get("TOWERLENS_DRIVER_MEMORY", "4g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session created elsewhere.

    Calendar parts, hour labels and event-time windows are defined in UTC.
    """
    for k, v in _JOB_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-visible working folder (``spark.checkpoint.dir``).

    Unset: a folder of its own under a ``local`` master, an error on a cluster
    (each executor would write to its own disk).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="towerlens-local-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared working folder (writers create it)."""
    return f"{shared_dir(spark)}/towerlens/{name}-{uuid.uuid4().hex[:12]}"
