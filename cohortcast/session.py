"""Spark session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run wants; a cluster's own spark-defaults win where set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app: str = "cohortcast", extra: dict | None = None) -> SparkSession:
    """A session with the settings above.  ``master=None`` leaves the master to
    spark-submit (cluster runs); tests and the benchmark pass ``local[N]``."""
    b = SparkSession.builder.appName(app)
    if master is not None:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only when the session has none and its master is local (tests) is a private
    one created; on a cluster, executors would not see it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cohortcast-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    p = f"{base}/{name}-{uuid.uuid4().hex}"
    if p.startswith("/"):
        os.makedirs(os.path.dirname(p), exist_ok=True)
    return p
