"""Session helper: the settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "strataflow", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC time, ANSI and adaptive execution on; a cluster brings its own master and sizes."""
    n = cpus or os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
