"""Batch and streaming readers. Flights have a fixed schema, so no file is read to infer it."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from skyledger.schema import AIRPORTS, FLIGHTS, MISSING


def read_flights_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Flight records from CSV files with a header row; ``path`` may be a glob or a folder.

    ``FAILFAST`` stops at a malformed number. ``PERMISSIVE`` turns it into null, which the
    queries would then count as a flight on time.
    """
    return (
        spark.read.schema(FLIGHTS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING)
        .option("mode", mode)
        .csv(path)
    )


class TooManyBadRecords(ValueError):
    """More records were malformed than the caller accepts."""


_RECORD = "_record"


def _fields(record: Column) -> Column:
    return F.from_csv(record, ", ".join(f"{f.name} string" for f in FLIGHTS.fields), {"mode": "PERMISSIVE"})


def _malformed(record: Column, fields: Column | None = None) -> Column:
    """What is wrong with a CSV line: the number of its fields, or the first that is no number.

    ``fields``: the line already split by :func:`_fields`; else it is split for each field asked."""
    fields = _fields(record) if fields is None else fields
    reason: Column = F.lit("fields")
    for field in reversed(FLIGHTS.fields):
        if isinstance(field.dataType, IntegerType):
            text = fields[field.name]
            wrong = text.isNotNull() & (text != MISSING) & (text != "") & text.try_cast("int").isNull()
            reason = F.when(wrong, field.name).otherwise(reason)
    commas = F.regexp_count(F.regexp_replace(record, '"[^"]*"', ""), F.lit(","))
    return F.when(commas != len(FLIGHTS.fields) - 1, "fields").otherwise(reason)


def _set_aside(bad: DataFrame) -> DataFrame:
    """``file, reason, record`` of malformed rows; each record is split once, not once per field."""
    split = bad.withColumn("_fields", _fields(F.col(_RECORD)))
    return split.select("file", _malformed(F.col(_RECORD), F.col("_fields")).alias("reason"), F.col(_RECORD).alias("record"))


def read_flights_checked(
    spark: SparkSession, path: str, quarantine: str, most: float = 0.001
) -> DataFrame:
    """The well-formed flight records of CSV files; the others are set aside.

    One pass over the files writes malformed records to the new folder ``quarantine``, as parquet with
    ``file``, ``reason`` (the first column that holds no number, or ``fields`` if there are too many
    or too few) and the ``record`` itself, and counts all. If more than the share ``most`` of
    them is malformed, the files are not what they should be, and :class:`TooManyBadRecords` is
    raised. Mend and reread what was set aside, or leave it: nothing is lost or counted as on time.
    """
    rows = (
        spark.read.schema(StructType([*FLIGHTS.fields]).add(_RECORD, StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        .csv(path)
    )
    seen = Observation()
    # a scan judges the fields that it is asked for, so it is asked for all, here and in what is returned
    every = F.pmod(F.xxhash64(*FLIGHTS.names), F.lit(2)) < 2
    counted = rows.withColumn("file", F.col("_metadata.file_path")).where(every).observe(
        seen, F.count(F.lit(1)).alias("n"), F.count(_RECORD).alias("bad")
    )
    bad = counted.where(F.col(_RECORD).isNotNull())
    _set_aside(bad).write.parquet(quarantine)
    found = seen.get
    if found["bad"] > most * found["n"]:
        raise TooManyBadRecords(f"{found['bad']} of {found['n']} records are malformed; see {quarantine}")
    return rows.where(F.col(_RECORD).isNull() & every).drop(_RECORD)


def read_flights_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Flight records from parquet files, or from the folder of a bucketed table.

    Read by folder, a table is scanned with as many tasks as it has splits. Read by name, a
    query grouping on its bucket column is planned with one task per bucket.
    """
    return spark.read.schema(FLIGHTS).parquet(*([path] if isinstance(path, str) else path))


def _fact(spark: SparkSession, table: str, name: str) -> str:
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return facts.where(F.col("col_name") == name).select("data_type").first()[0]


def read_flights_table(
    spark: SparkSession, table: str, months: Iterable[int] | None = None, split: bool = True
) -> DataFrame:
    """Flight records of a table known by name, of all months or of some.

    A bucket holds whole months, so the files of all other buckets are left unopened. With
    ``split`` files are read by splits, however few the buckets: a month with a third of all
    flights is spread over tasks, and what groups by month adds up their parts after an exchange
    of a few rows. Without, the scan keeps the buckets: one task for each, no exchange for groups by
    month, which suits months that one task can hold.
    """
    wanted = None if months is None else sorted(set(months))
    if not split:
        rows = spark.table(table)
        return rows if wanted is None else rows.where(F.col("Month").isin(wanted))
    reader = spark.read.schema(FLIGHTS)
    if wanted is not None:
        # files end in their bucket's number, the hash of the month modulo the number of buckets
        buckets = int(_fact(spark, table, "Num Buckets"))
        number = F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets))
        found = spark.createDataFrame([(m,) for m in wanted], "id int").select(number).distinct().collect() if wanted else []
        reader = reader.option("pathGlobFilter", "*_{" + ",".join(f"{r[0]:05d}" for r in found) + "}.c*" if found else "no file")
    rows = reader.parquet(_fact(spark, table, "Location"))
    return rows if wanted is None else rows.where(F.col("Month").isin(wanted))


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """The airports dimension from CSV with a header row: code and display name.

    The columns are found by name, as the file has others and their order is its own.
    """
    return spark.read.option("header", True).csv(path).select(*AIRPORTS.names)


def stream_flights(
    spark: SparkSession,
    path: str,
    max_files: int | None = 1,
    max_bytes: int | None = None,
    archive: str | None = None,
    max_age: str | None = None,
) -> DataFrame:
    """Parquet files as an unbounded stream, ``max_files`` new ones per micro-batch.

    ``max_bytes`` (a whole number; such as ``100 << 30``) sizes micro-batches by bytes instead,
    whatever the files' number. With neither a micro-batch takes all files that are new. Select the columns a
    query needs before handing the stream to a per-batch function: nothing is pruned after it.

    ``archive`` moves files there once a later batch has committed those that read them, so the
    landing folder stays short to list; it must not lie under ``path``. ``max_age`` (such as
    ``7d``) lets the query forget files that much older than the newest; older arrivals are not read.
    """
    reader = spark.readStream.schema(FLIGHTS)
    if max_bytes is not None:
        if not isinstance(max_bytes, int) or max_bytes < 1:
            raise ValueError(f"max_bytes must be a positive whole number, not {max_bytes!r}")
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_age is not None:
        reader = reader.option("maxFileAge", max_age)
    return reader.parquet(path)


def stream_new_contents(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``file, digest`` of parquet files that arrive under ``path``, each content once.

    The digest of every content seen is kept in the state store, so a file that is delivered again,
    under whatever name, is not named again. Files are read whole for it: they may have up to 2 GB.
    """
    layout = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(layout).option("pathGlobFilter", "*.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(path).select(F.col("path").alias("file"), F.sha2("content", 256).alias("digest"))
    return files.dropDuplicates(["digest"])


def on_new_flights(work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A batch function over :func:`stream_new_contents` that hands ``work`` the flights in a batch's
    files; batches without any new content are passed over. The driver holds their names only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        files = sorted(row.file for row in batch.select("file").collect())
        if files:
            work(read_flights_parquet(batch.sparkSession, files), batch_id)

    return write
