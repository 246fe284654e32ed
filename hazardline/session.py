"""Session settings the library expects, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "hazardline", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor sees.

    Where that is unset, a local session (tests) gets a temporary folder and any other raises: an executor's own
    disk is no place for a table that others read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/hazardline-{name}-{uuid.uuid4().hex}"
