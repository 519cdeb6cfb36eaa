"""Session settings and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(shared storage every executor can reach). Only when the session has none and
runs in one process, as in local tests, do we create a local one and register
it; on any other master a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from . import storage

# Settings the engine relies on; applied only by ``build_session``.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the benchmark (the driver brings its own)."""
    builder = SparkSession.builder.master(master).appName("starmart")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (and so share local folders)."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starmart-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_root(spark: SparkSession) -> str:
    """Folder for derived tables: next to the checkpoints, on shared storage."""
    configured = session_conf(spark, "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/") + "/starmart"
    return os.path.dirname(checkpoint_root(spark).rstrip("/")) + "/starmart"


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """A folder that takes this thread's new scratch folders and is removed at the end.

    For jobs whose results are stored elsewhere when they end: frames over the removed folders can't be read any more.
    """
    folder = new_scratch_dir(spark, "run")
    open_ = _scopes.__dict__.setdefault("folders", [])
    open_.append(folder)
    try:
        yield folder
    finally:
        open_.pop()
        storage.remove(spark, folder)


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the scratch root, or in the thread's scratch scope (never reused)."""
    folders = getattr(_scopes, "folders", None)
    return f"{folders[-1] if folders else scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def session_conf(spark: SparkSession, key: str, default: str | None = None) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # unset key without default raises in some versions
        value = None
    if value is None:
        try:
            value = spark.sparkContext.getConf().get(key, None)
        except Exception:
            value = None
    return default if value is None else value


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of recomputing
    the plan) with a single job; ``DataFrame.checkpoint()`` runs the plan twice
    unless it is cached first.
    """
    spark = df.sparkSession
    path = new_scratch_dir(spark, f"stage-{label}")
    df.write.parquet(path)
    return spark.read.parquet(path)
