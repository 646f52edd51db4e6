"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans; applied by `get_session` and checked in tests.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed tables rewrite only the buckets a batch touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass no master: the launcher decides. `shuffle_partitions`
    should be sized so one shuffle partition stays well under executor memory
    (AQE coalesces small ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for state, checkpoints and lineage cuts.

    Read from the session (`spark.checkpoint.dir`, as the cluster sets it).
    Only a local session may do without (a folder of this machine is then
    created and registered); elsewhere it has to be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # Later calls find it through getCheckpointDir().
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run of one job."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make `DataFrame.checkpoint()` write under the shared root."""
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root
