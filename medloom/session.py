"""Session set-up for local work; on a cluster the session comes from outside and is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "medloom", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use.

    UTC, adaptive execution and Arrow are the only settings that results depend on; the rest is sizing.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("MEDLOOM_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
