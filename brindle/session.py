"""Session settings.

On a cluster the caller supplies the session; the library only needs adaptive
execution left on (Spark's default).  ``local_session`` serves tests and the
benchmark.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, splits skewed ones and
# turns a sort-merge join into a broadcast join once the real size is known.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "brindle", memory: str = "8g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**ADAPTIVE, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
