"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Only correctness-neutral settings and the ones the pipeline relies on.  Sizes such as
# shuffle partitions and executor memory belong to the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows bucketed by (id) are in place for a join on (store, id).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot leaves methods over 8000 bytes uncompiled; wide enrichments then run faster
    # as several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "shelfmark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``extra`` takes further settings with ``__`` in place of dots, for instance
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _local_dir() -> str:
    """A folder of this process, gone when it ends."""
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A temporary folder of the machine is used only in local mode with nothing set, and removed
    when the process ends.  What lies in a cluster's folder is left to its expiry rules.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a shared folder if the cluster named none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
