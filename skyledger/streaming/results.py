"""Per-batch sinks, and readers of the results they leave.

Each micro-batch is written to a folder of the attempt and counts from its commit on (see
``commits``). A batch that is run again, after a lost driver or executor, finds its commit or makes
it, so it counts once, and a reader never meets half of it. A folder belongs to the query, known by
its checkpoint, that first wrote to it; another one is refused, since its batches would stand among
those of an earlier run. The schema is kept with the folder, so that reads are typed from the start.
"""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from skyledger.streaming.commits import Commits
from skyledger.streaming.files import drop, folder_names

BatchFunction = Callable[[DataFrame, int], None]


def owner_of(spark: SparkSession) -> str:
    """The streaming query that runs the current batch function."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_counted(rows: DataFrame, folder: str, *partitions: str) -> int:
    """Write ``rows`` and say how many they are, in one job."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*partitions).parquet(folder)
    return seen.get["n"]


def results_sink(
    path: str, answer: Callable[[DataFrame], DataFrame], skip_empty: bool = False
) -> BatchFunction:
    """Write ``answer(batch)`` of every micro-batch under ``path`` and commit it.

    An empty batch leaves an empty result; with ``skip_empty`` it is not committed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = Commits(batch.sparkSession, path)
        log.claim(owner_of(batch.sparkSession))
        if log.entry(batch_id) is None:
            commit_rows(log, answer(batch), batch_id, skip_empty)

    return write


def commit_rows(log: Commits, rows: DataFrame, batch_id: int, skip_empty: bool = False) -> bool:
    """Write ``rows`` as a batch of the folder and commit them; False if another attempt did."""
    log.keep_schema(rows.schema)
    folder = f"data/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
    n = write_counted(rows, f"{log.path}/{folder}")
    return (n > 0 or not skip_empty) and log.publish(batch_id, {"folder": folder, "rows": n})


def console_sink(n: int = 10, order: Sequence[Column] = (), path: str | None = None) -> BatchFunction:
    """Show the first ``n`` rows of every micro-batch, untruncated; the first in ``order`` if given.

    With ``path`` what is shown is a results folder's batch first, so the batch is computed once
    and what the console showed can be read later.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        rows = batch.orderBy(*order) if order else batch
        if path is not None:
            results_sink(path, lambda _: rows.limit(n))(batch, batch_id)
            rows = batches_since(batch.sparkSession, path, batch_id - 1, batch_id).drop("batch_id")
            rows = rows.orderBy(*order) if order else rows
        rows.show(n, False)

    return show


def _typed(spark: SparkSession, log: Commits, folders: Sequence[str]) -> DataFrame:
    """The rows of committed folders with their ``batch_id``, typed even if there are none."""
    schema = log.schema() or StructType()
    full = StructType([*schema.fields]).add("batch_id", LongType())
    if not folders:
        return spark.createDataFrame([], full)
    found = StructType([*full.fields]).add("attempt", StringType())
    rows = spark.read.schema(found).option("basePath", f"{log.path}/data").parquet(*(f"{log.path}/{f}" for f in folders))
    return rows.drop("attempt")


def all_batches(spark: SparkSession, path: str) -> DataFrame:
    """The results of every batch so far, with their ``batch_id``."""
    return batches_since(spark, path)


def batches_since(spark: SparkSession, path: str, since: int | None = None, until: int | None = None) -> DataFrame:
    """The results of the batches after ``since``, up to ``until``, with their ``batch_id``. Only
    their folders are listed and read."""
    log = Commits(spark, path)
    return _typed(spark, log, [e["folder"] for e in log.entries(since, until).values() if e["rows"]])


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """The results of the newest batch that had any, known from its commit."""
    log = Commits(spark, path)
    for batch_id in reversed(log.ids()):
        if (entry := log.entry(batch_id))["rows"]:
            return _typed(spark, log, [entry["folder"]])
    return _typed(spark, log, [])


def latest_per_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key, from a stream that writes changed rows only. Reads the whole
    history; a keyed table (:mod:`skyledger.streaming.keyed`) keeps one row for each key instead."""
    results = all_batches(spark, path)
    if results.columns == ["batch_id"]:
        return results
    values = [c for c in results.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id")).alias("newest")
    return results.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Write the newest row of every key to the new folder ``target``, as the newest batch.

    Reading ``target`` gives what :func:`latest_per_key` gave on ``path``, without the history.
    """
    if ids := Commits(spark, path).ids():
        commit_rows(Commits(spark, target), latest_per_key(spark, path, keys), ids[-1])


def drop_lost_attempts(spark: SparkSession, path: str) -> int:
    """Delete what attempts without a commit left behind, and say how many there were. Batches
    that are not committed yet are left alone, as their attempts may be running."""
    log, gone = Commits(spark, path), 0
    for batch_id, entry in log.entries().items():
        folder = f"{path}/data/batch_id={batch_id}"
        for name in folder_names(spark, folder):
            if not entry["folder"].endswith(f"/{name}"):
                drop(spark, f"{folder}/{name}")
                gone += 1
    return gone
