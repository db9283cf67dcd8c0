"""Session helpers for local runs (tests, bench).  Library code never creates
a session; it uses the one it is given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "cordon") -> SparkSession:
    n = str(cpus)
    parts = shuffle_partitions or (8 if n == "*" else max(2, int(n)))
    return (SparkSession.builder
            .master(f"local[{n}]")
            .appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(parts))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", os.environ.get("CORDON_DRIVER_MEMORY", "8g"))
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())
