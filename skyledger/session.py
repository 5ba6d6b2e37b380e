"""Session settings the jobs are designed for."""

from pyspark.sql import SparkSession

# Adaptive execution splits hot join and write partitions and merges small ones; the scan
# split is large because the queries read 2 to 5 of 29 columns, so a 128 MB split holds
# little to read.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session in one JVM, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyledger")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    # One local machine wants many small scan splits, not the cluster's large ones.
    for key, value in {**SETTINGS, "spark.sql.files.maxPartitionBytes": "128m", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
