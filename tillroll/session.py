"""Session settings and the shared scratch location.

On a cluster the session is created by ``spark-submit``; ``configure``
only sets what the engine relies on (UTC day boundaries, AQE).  Scratch
data (durable checkpoints, round-trip files) always goes under the
cluster's ``spark.checkpoint.dir``; a private temporary directory is
chosen only when none is configured, which is the local/test case.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    # Dates are cut from timestamps: pin the day boundary.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to the advisory size rather than keeping
    # one per core: fewer, fuller tasks (the recommended setting on shared
    # clusters, where executors are not idle waiting for this job).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the cluster.

    Read from the session.  When it is unset, a local-mode session (tests,
    a single machine) gets a private temporary directory; a cluster session
    raises instead of silently using a folder only one machine can see."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            # a machine-local folder is invisible to other executors
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        # the setting itself cannot change in a running session
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete scratch data on whatever filesystem holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


__all__ = ["configure", "local_session", "checkpoint_root", "remove_path", "scratch_path"]
