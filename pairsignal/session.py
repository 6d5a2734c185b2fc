"""A local session for tests and the bench.  On a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "pairsignal") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Small local shuffles keep one task per core.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
