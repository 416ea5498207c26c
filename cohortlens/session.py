"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Enough that a shuffle of some TB stays below a few hundred MB a task.
INITIAL_PARTITIONS = 8192


def builder(name: str = "cohortlens", partitions: int = INITIAL_PARTITIONS) -> SparkSession.Builder:
    """Cluster defaults; sizes (executors, memory) are left to spark-submit.

    AQE merges small shuffle partitions and splits skewed joins, but adds none: the
    initial number has to suit the full data, at about 256 MB of shuffle each.
    """
    return (SparkSession.builder.appName(name)
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.shuffle.partitions", str(partitions))
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
            .config("spark.sql.session.timeZone", "UTC")
            # Call-site capture costs milliseconds per column expression.
            .config("spark.python.sql.dataFrameDebugging.enabled", "false"))


def local(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """One-machine session for tests and the benchmark."""
    return (builder(partitions=cpus).master(f"local[{cpus}]")
            .config("spark.driver.memory", memory)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())
