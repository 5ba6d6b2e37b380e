"""Batch writers.

Both partitioned writers ask for a rebalance on the layout columns. Adaptive execution then
sizes the write tasks by bytes: a month or year holding a third of all rows is split over many
tasks, and small ones share a task, so files are neither huge nor tiny.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schema import MISSING


def consolidate_csv(flights: DataFrame, path: str, num_files: int | None = None) -> None:
    """Write all records as CSV with a header row; fails if ``path`` exists.

    ``num_files=1`` gives one file through one task, which only suits small data.
    """
    merged = flights if num_files is None else flights.coalesce(num_files)
    merged.write.option("header", True).option("nullValue", MISSING).csv(path)


def write_bucketed(
    flights: DataFrame, table: str, path: str | None = None, buckets: int = 12, replace: bool = False
) -> None:
    """Append to a parquet table partitioned by Year, bucketed and sorted by Month.

    With ``replace`` the years in ``flights`` take the place of the same years in the table, so
    a job that is run again does not double them; other years stay. The rebalance needs adaptive
    execution; without it a year's month goes to one task.

    ``path`` puts the table's files in a folder of your choice instead of the warehouse.
    """
    if replace and flights.sparkSession.catalog.tableExists(table):
        columns = flights.sparkSession.table(table).columns
        kept = flights.select(*columns).hint("rebalance", "Year", "Month")
        settings, key = flights.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = settings.get(key)
        settings.set(key, "dynamic")  # a table takes it from the session only
        try:
            kept.write.insertInto(table, overwrite=True)
        finally:
            settings.set(key, before)
        return
    writer = (
        flights.hint("rebalance", "Year", "Month")
        .write.format("parquet")
        .mode("append")
        .partitionBy("Year")
        .bucketBy(buckets, "Month")
        .sortBy("Month")
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# Years one write task keeps open files for at once; the rebalance gives a task few of them.
OPEN_YEARS = 16


def write_per_year(flights: DataFrame, path: str) -> None:
    """Write parquet with one sub-folder per year, keeping Year in the files as well.

    The rebalance can split a year only at the bounds of the tasks before it, which do not grow
    in number with the rows, so a write task's share grows with the table. The task therefore
    writes to a file per year as rows come, instead of sorting them all by year first.
    """
    settings = flights.sparkSession.conf
    wanted = {"spark.sql.optimizer.plannedWrite.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_YEARS)}
    before = {key: settings.get(key, None) for key in wanted}
    for key, value in wanted.items():
        settings.set(key, value)
    try:
        (
            flights.withColumn("part_year", F.col("Year"))
            .hint("rebalance", "part_year")
            .write.partitionBy("part_year")
            .parquet(path)
        )
    finally:
        for key, value in before.items():
            if value is None:
                settings.unset(key)
            else:
                settings.set(key, value)
