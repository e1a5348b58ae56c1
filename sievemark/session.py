"""Session settings that the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "sievemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": os.environ.get("SIEVEMARK_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
