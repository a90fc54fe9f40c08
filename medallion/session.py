"""Session defaults and the shared working folder.

:func:`build_session` sets the defaults once, when it creates a session.
Jobs and queries leave the settings of a session they are handed alone.
Intermediate tables and streaming checkpoints live under the folder the
cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


class NoSharedFolderError(RuntimeError):
    pass


def build_session(
    app_name: str = "medallion",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def one_machine(master: str) -> bool:
    """``local`` and ``local[...]``; ``local-cluster`` has executors with folders of their own."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession, folder: str | None = None) -> str:
    """The shared folder for intermediate tables and checkpoints.

    ``folder`` if given, else ``spark.checkpoint.dir``. A session on one
    machine may go without: its JVM's temporary folder serves, below the
    application's id. Elsewhere executors do not share such a folder, so a
    missing setting is an error.
    """
    sc = spark.sparkContext
    root = folder or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not one_machine(sc.master):
            raise NoSharedFolderError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        root = f"{sc._jvm.java.lang.System.getProperty('java.io.tmpdir')}/medallion-{sc.applicationId}"
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new, unique folder name below the shared folder for one run."""
    return f"{checkpoint_root(spark, folder)}/medallion/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own through the store's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
