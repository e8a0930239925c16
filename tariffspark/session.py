"""Session settings the engine relies on, and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def builder(app: str = "tariffspark") -> SparkSession.Builder:
    """UTC, ANSI and adaptive execution; everything else is the cluster's to set."""
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only without the setting, on one machine (tests), a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tariffspark-")
    return root.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
