"""Top-k over a frame or within each group of it, and ranks over a whole frame."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.storage import stored


def top_k(frame: DataFrame, k: int, order: Sequence[Column], per: str | None = None) -> DataFrame:
    """The first ``k`` rows in ``order``, of the whole frame or of each value of ``per``.

    Spark cuts to ``k`` rows (per group) before the exchange in both forms, so no task
    receives more than ``k`` rows per group from each upstream task.
    """
    if per is None:
        return frame.orderBy(*order).limit(k)
    position = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return frame.withColumn("_position", position).where(F.col("_position") <= k).drop("_position")


def ranked(frame: DataFrame, by: Sequence[str], name: str = "rank", tasks: int | None = None) -> DataFrame:
    """``frame`` with the rank of each row over the whole frame: one more than the rows before it.

    ``by`` names columns, each ascending or, with a ``-`` in front, descending; nulls come last.
    Rows that are equal in them share a rank. No task sees all rows: the distinct values with their
    counts are dealt to ``tasks`` ranges, added up within each, and a range starts at the count of
    all before it, of which the driver fetches one number for each range. Rows then look their
    values up, so values that very many rows share are counted before they are exchanged.
    """
    columns = [c.removeprefix("-") for c in by]
    order = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in by]
    if name in frame.columns:
        raise ValueError(f"the frame has a column {name} already")
    tasks = tasks or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = frame.groupBy(*columns).agg(F.count("*").alias("_n"))
    # the ranges are drawn from a sample: written down, as a second run could draw others
    values = stored(counts.repartitionByRange(tasks, *order).withColumn("_range", F.spark_partition_id()), "ranked")
    before, starts = 0, []
    for number, n in sorted(values.groupBy("_range").agg(F.sum("_n").alias("n")).collect()):
        starts.append((number, before))
        before += n
    start = frame.sparkSession.createDataFrame(starts, "_range int, _start long")
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(start, "_range")
    values = values.select(*(F.col(c).alias(f"_of_{c}") for c in columns), (F.col("_start") + F.col("_before") + 1).alias(name))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return frame.join(values, same, "left").select(*frame.columns, name)
