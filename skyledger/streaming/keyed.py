"""Tables with one row for each key, kept up to date by batches of changes.

Keys are dealt over hash buckets, each a folder. A batch rewrites only the buckets it touches: their
rows and the new ones are merged, written beside the old folders, and take their place with the
commit, which lists the folder of every bucket. Readers take the newest commit and read each key
once, however many batches there were; a batch that runs again finds its commit and does nothing,
so that sums stay right. Folders that neither of the last two commits lists are deleted.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from skyledger.streaming.commits import Commits
from skyledger.streaming.files import drop, folder_names
from skyledger.streaming.results import BatchFunction, owner_of


def keyed_sink(path: str, keys: Sequence[str], add: bool = False, buckets: int = 16) -> BatchFunction:
    """Merge every micro-batch into the table at ``path``: its rows replace those of equal keys or,
    with ``add``, are added to them column by column. A batch has each key once.

    ``buckets`` is that of the first batch for good; a bucket should hold a few million keys.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        Commits(batch.sparkSession, path).claim(owner_of(batch.sparkSession))
        merge_rows(batch, path, keys, batch_id, add, buckets)

    return merge


def merge_rows(rows: DataFrame, path: str, keys: Sequence[str], batch_id: int, add: bool = False, buckets: int = 16) -> bool:
    """One batch of :func:`keyed_sink`; False if the batch had been merged before. Batches must come in
    order; one with a number below the newest has been merged or was left out, and is refused."""
    spark = rows.sparkSession
    log = Commits(spark, path)
    last = max(log.ids(), default=None)
    if last is not None and batch_id <= last:
        if log.entry(batch_id) is None:
            raise ValueError(f"batch {batch_id} comes after batch {last}")
        return False
    log.keep_schema(rows.schema)
    before = log.entry(last) if last is not None else {"buckets": buckets, "folders": {}}
    attempt = f"data/batch={batch_id}-{uuid.uuid4().hex}"
    values = [c for c in rows.columns if c not in keys]
    # the batch is read once: a second job over a stateful stream would compute its state twice
    bucket = F.pmod(F.xxhash64(*keys), F.lit(before["buckets"]))
    changed = f"{path}/{attempt}/changed"
    rows.withColumn("_bucket", bucket.cast("int")).write.partitionBy("_bucket").parquet(changed)
    touched = [name.partition("=")[2] for name in folder_names(spark, changed) if name.startswith("_bucket=")]
    schema = StructType([*rows.schema.fields]).add("_bucket", IntegerType())
    new = spark.read.schema(schema).parquet(changed).withColumn("_new", F.lit(1))
    old = [before["folders"][b] for b in touched if b in before["folders"]]
    if old:
        kept = StructType(rows.schema.fields)
        was = spark.read.schema(kept).parquet(*(f"{path}/{f}" for f in old))
        new = new.unionByName(was.withColumn("_bucket", bucket.cast("int")).withColumn("_new", F.lit(0)))
    if add:
        merged = new.groupBy("_bucket", *keys).agg(*(F.sum(v).cast(rows.schema[v].dataType).alias(v) for v in values))
    else:
        merged = new.groupBy("_bucket", *keys).agg(F.max_by(F.struct(*values), "_new").alias("_row")).select("_bucket", *keys, "_row.*")
    folder = f"{attempt}/rows"
    if touched:
        merged.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    folders = {**before["folders"], **{b: f"{folder}/_bucket={b}" for b in touched}}
    done = log.publish(batch_id, {"buckets": before["buckets"], "folders": folders})
    drop(spark, changed)
    if done and last is not None:
        _drop_old(log, {*folders.values(), *before["folders"].values()}, batch_id)
    return done


def _drop_old(log: Commits, listed: set[str], newest: int) -> None:
    """Delete folders of committed batches that are not ``listed``. Readers that began with the
    commit before the newest still find theirs."""
    for name in folder_names(log.spark, f"{log.path}/data"):
        if int(name.removeprefix("batch=").partition("-")[0]) >= newest:
            continue
        rows = f"data/{name}/rows"
        for bucket in folder_names(log.spark, f"{log.path}/{rows}"):
            if f"{rows}/{bucket}" not in listed:
                drop(log.spark, f"{log.path}/{rows}/{bucket}")
        if not folder_names(log.spark, f"{log.path}/{rows}"):
            drop(log.spark, f"{log.path}/data/{name}")


def keyed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows as of its newest commit, each key once; typed if there are none."""
    log = Commits(spark, path)
    ids = log.ids()
    schema = log.schema() or StructType()
    folders = log.entry(ids[-1])["folders"].values() if ids else []
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in folders))
