"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "pairloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster, pass your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("PAIRLOOM_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for tables written between jobs.

    It lies in the shared folder the cluster names in `spark.checkpoint.dir`, or
    else in the checkpoint folder of the context, so the loss of an executor or
    of a node loses nothing. Only under a local master, as in tests, a folder of
    this machine serves; elsewhere a missing setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        set_by_hand = spark.sparkContext._jsc.sc().getCheckpointDir()
        shared = set_by_hand.get() if set_by_hand.isDefined() else None
    if shared:
        return f"{shared.rstrip('/')}/pairloom-{uuid.uuid4().hex}"
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share"
        )
    return tempfile.mkdtemp(prefix="pairloom-")


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _file_system(spark, path)
    return files.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this package wrote between jobs, once nothing reads it."""
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a written folder; parents are created, an existing target is an error."""
    folder, files = _file_system(spark, target)
    if files.exists(folder):
        raise ValueError(f"{target} already exists")
    if folder.getParent() is not None:
        files.mkdirs(folder.getParent())
    if not files.rename(_file_system(spark, source)[0], folder):
        raise OSError(f"cannot rename {source} to {target}")
