"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults of a session built here, where the environment has not set them.
_LOCAL_DEFAULTS = {"spark.ui.enabled": "false"}
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # state channel of transformWithState over a socket file, not TCP
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "trailmark", extra: dict | None = None) -> SparkSession:
    """Return the running session as it is, or build one with the library
    defaults for whatever the environment has not set.

    On a cluster pass nothing: the submitting environment owns master,
    memory and partition counts.  Tests pass ``local[N]`` and a small
    ``shuffle_partitions``; settings given here apply only to a session
    that this call builds.
    """
    spark = SparkSession.getActiveSession()
    if spark is None:
        SparkContext._ensure_initialized()
        present = SparkConf()  # what spark-submit and spark-defaults.conf have set
        asked = dict(extra or {})
        if master:
            asked["spark.master"] = master
        if shuffle_partitions:
            asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        where = asked.get("spark.master") or present.get("spark.master", "local[*]")
        defaults = _DEFAULTS | (_LOCAL_DEFAULTS if _is_local(where) else {})
        builder = SparkSession.builder.appName(app_name)
        settings = {k: v for k, v in defaults.items() if not present.contains(k)} | asked
        for k, v in settings.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """One process on this machine; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins.  Only when it is unset and the master is
    local (tests, laptops) a fresh local folder is created and registered;
    on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _is_local(sc.master):
            # a machine-local folder is not shared by the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        path = tempfile.mkdtemp(prefix="trailmark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "trailmark", name)


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and return a DataFrame
    reading it back: a DataFrame used by several branches of a plan is
    computed once, and its lineage is cut (lost executors re-read files
    instead of recomputing).  Reliable checkpoint, never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table or partition that the library itself has written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return [x.getPath().getName() for x in listed]


@contextmanager
def written_once(df) -> Iterator:
    """``df`` as a table in the shared folder for the time of the block, for
    work of one micro-batch: nothing of it is left behind."""
    spark = df.sparkSession
    path = scratch_path(spark, f"batch-{uuid.uuid4().hex}")
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        delete_path(spark, path)
