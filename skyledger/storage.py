"""Where jobs keep files that every executor must be able to read."""

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder named in ``spark.checkpoint.dir``.

    Where that is unset, a sub-folder of ``spark.sql.warehouse.dir`` stands in: tables are
    written there, so every executor reaches it.
    """
    base = spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/skyledger/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host that Spark resolves it to, for readers and writers that do
    not know Spark's default file system. A local one is ``file:///...``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a new shared folder and read back, which cuts its lineage.

    Nothing reads the job's shuffle files after it, so they are deleted at its end.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # of the jobs that are started now
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def stored_counting(df: DataFrame, label: str, condition: Column | str) -> tuple[DataFrame, int]:
    """:func:`stored`, and how many rows meet the condition, in the same job."""
    seen, met = Observation(), F.expr(condition) if isinstance(condition, str) else condition
    back = stored(df.observe(seen, F.count_if(met).alias("n")), label)
    return back, seen.get["n"]


def forget(*frames: DataFrame) -> None:
    """Delete what :func:`stored` wrote for these frames. No frame that reads them may be used after."""
    for frame in frames:
        if path := getattr(frame, "_stored_at", None):
            place = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
