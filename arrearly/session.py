"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Session settings the plans are written for. AQE re-plans joins at run time
# (broadcast only when a materialised side is measured below the threshold,
# split skewed partitions, coalesce small ones).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "arrearly", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables: the session's
    checkpoint directory. Where none is configured, a local run (one process)
    gets a scratch folder of its own, and a cluster an error: its executors
    would each write to their own disk."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="arrearly-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one output under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


# Shuffle files of a query go when it ends; without, when the driver's garbage collector finds the query.
SHUFFLE_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session's settings with ``conf`` for the queries run inside, as they were afterwards."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the run's own, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
