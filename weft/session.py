"""Session for tests and benchmarks; on a cluster the caller brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, partitions: int = 8, **more: str) -> SparkSession:
    """A local session with adaptive execution and UTC times. more: settings, "_" for "."."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("WEFT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in more.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
