"""Session helpers: configuration a job should run with, and the shared
checkpoint folder.

Operators never depend on session settings for their results (epoch seconds
are computed time-zone free), so a caller's own session works unchanged.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "groundtrack",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with AQE on and the UI off.

    On a cluster ``master`` stays None so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # what the driver remembers of finished work; with the UI off nothing
        # reads it, and many small streaming jobs would fill a small heap
        "spark.ui.retainedJobs": "50", "spark.ui.retainedStages": "50", "spark.ui.retainedTasks": "2000",
        "spark.sql.ui.retainedExecutions": "20", "spark.sql.streaming.ui.retainedQueries": "5",
        "spark.sql.streaming.numRecentProgressUpdates": "20",
        # keyed state off the heap (``streaming.keyed`` needs it)
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to a shared (distributed) path and we use it as is.
    Only when it is unset in local mode (tests) do we pick a fresh scratch
    folder; unset on a cluster is an error, never a machine-local folder.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="groundtrack-ckpt-")   # local mode only (tests)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for one query / table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
