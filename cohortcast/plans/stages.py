"""Staged tables with a life cycle: named, replaced as a whole, dropped at the end.

A stage is a Parquet folder below the cluster's shared folder.  It is written
beside its place and moved there when it is complete, so a reader finds the old
version or the new one, and a failed write leaves the old one.  The version it
replaces is deleted then: a second run under the same name leaves one copy.

``Stages(spark, "monthly")`` names a run whose stages the next run of that name
replaces.  Without a name the stages belong to this object alone and go when it
is closed, or when the process ends.
"""

from __future__ import annotations

import atexit
import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortcast.session import shared_dir

_FOLDER = "stages"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class Stages:
    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark = spark
        self.named = name is not None
        self.root = f"{shared_dir(spark).rstrip('/')}/{_FOLDER}/{name or uuid.uuid4().hex}"
        if not self.named:
            atexit.register(self._drop_at_exit)

    def versions(self, stage: str) -> list[str]:
        """Complete versions of a stage, oldest first (one, but while it is replaced)."""
        fs, p = _fs(self.spark, f"{self.root}/{stage}")
        if not fs.exists(p):
            return []
        return sorted(f"{self.root}/{stage}/{s.getPath().getName()}" for s in fs.listStatus(p))

    def stages(self) -> list[str]:
        fs, p = _fs(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n for n in names if not n.startswith("."))

    def put(self, df: DataFrame, stage: str) -> DataFrame:
        """Writes ``df`` once as the stage's new version and reads it back."""
        old = self.versions(stage)
        version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        beside, place = f"{self.root}/.writing-{version}", f"{self.root}/{stage}/{version}"
        try:
            df.write.parquet(beside)
        except BaseException:
            delete(self.spark, beside)
            raise
        fs, to = _fs(self.spark, place)
        fs.mkdirs(to.getParent())
        if not fs.rename(_fs(self.spark, beside)[1], to):
            raise OSError(f"could not move {beside} to {place}")
        for path in old:
            delete(self.spark, path)
        return self.spark.read.schema(df.schema).parquet(place)

    def get(self, stage: str) -> DataFrame | None:
        """The stage as it stands, also one of an earlier run of this name."""
        found = self.versions(stage)
        return self.spark.read.parquet(found[-1]) if found else None

    def drop(self, stage: str | None = None) -> None:
        """Drops a stage, or all of them, if they are there."""
        delete(self.spark, f"{self.root}/{stage}" if stage else self.root)
        if stage is None:
            atexit.unregister(self._drop_at_exit)

    def _drop_at_exit(self) -> None:
        try:
            self.drop()
        except Exception as e:  # the session is gone: its folder is the cluster's to clear
            logging.getLogger(__name__).info("%s was not dropped: %s", self.root, e)

    def __enter__(self) -> "Stages":
        return self

    def __exit__(self, *exc) -> None:
        self.drop()
