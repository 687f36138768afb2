"""Session helper for tests, benchmarks and scripts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, memory: str = "6g", shuffle: int | None = None) -> SparkSession:
    """A local session with AQE on and UTC pinned; a cluster passes its own session instead."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "4"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName("platelake")
        .config("spark.sql.shuffle.partitions", str(shuffle or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a session's own files in the folder that driver and executors share; local sessions without one get a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="platelake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}/{name}"
