"""Session settings used by the tests and the benchmark."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "airway", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("AIRWAY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or where that is
    unset a folder below the warehouse. On a cluster a warehouse on the driver's own disk is
    refused: executors would write to theirs."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and urlparse(warehouse).scheme in ("", "file"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/airway-work".rstrip("/")
