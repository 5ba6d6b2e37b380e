"""Every question, view, source and sink as a query over the given tables.

Doubles are rounded to nine decimals here, not in the operators, since two engines add in
different orders.
"""

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger import plans, sources, streaming
from skyledger.functions import with_is_delayed, with_penalty
from skyledger.plans.questions import QUESTIONS
from skyledger.schema import as_flights
from skyledger.storage import scratch_dir
from skyledger.workload.tables import COLUMNS, airports, flights

Query = Callable[[SparkSession, str], DataFrame]

# The carrier codes the workload's flights can have.
CARRIERS = [f"C{i}" for i in range(20)]
# The streamed roll-ups have at most a few thousand groups, at any scale of the tables.
STATE_PARTITIONS = 8


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, 9) for c in columns})


def _flights_for(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return flights(spark, sf_dir, QUESTIONS[name].columns)


# -- flags and roll-ups --------------------------------------------------------------------------


def delay_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each pair of flags occurs, with the delays behind it."""
    columns = ("ArrDelay", "DepDelay", "Cancelled")
    flagged = with_penalty(with_is_delayed(flights(spark, sf_dir, columns)))
    return flagged.groupBy("total_delay", "is_delayed", "penalty").agg(
        F.count("*").alias("n_flights")
    )


def carrier_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.carrier_monthly(_flights_for(spark, sf_dir, "carrier_punctuality"))


def monthly_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.monthly_penalties(_flights_for(spark, sf_dir, "worst_months"))


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.route_counts(_flights_for(spark, sf_dir, "busy_paths"))


# -- questions -----------------------------------------------------------------------------------


def _carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.carrier_punctuality(_flights_for(spark, sf_dir, "carrier_punctuality"))


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.worst_months(_flights_for(spark, sf_dir, "worst_months"))


def _busiest(spark: SparkSession, sf_dir: str, per: str | None) -> DataFrame:
    legs = _flights_for(spark, sf_dir, "busiest_airports")
    return ops.busiest_airports(legs, airports(spark, sf_dir), per=per)


def _paths(spark: SparkSession, sf_dir: str, per: str | None) -> DataFrame:
    legs = _flights_for(spark, sf_dir, "busy_paths")
    return ops.busy_paths(legs, airports(spark, sf_dir), per=per)


def carrier_punctuality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_carriers(spark, sf_dir), "punctuality")


def worst_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_months(spark, sf_dir), "non_punctuality")


def busiest_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _busiest(spark, sf_dir, None)


def busiest_airports_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _busiest(spark, sf_dir, "Year")


def busy_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, None)


def busy_paths_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, "Year")


def month_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.month_year_counts(flights(spark, sf_dir, ("Year", "Month")))


def month_year_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.month_year_counts_sql(flights(spark, sf_dir, ("Year", "Month")), "flights_counted")


# -- display views -------------------------------------------------------------------------------


def carrier_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(plans.carrier_view(_carriers(spark, sf_dir)), "value")


def carrier_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.carrier_matrix(carrier_view(spark, sf_dir), CARRIERS)


def months_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(plans.months_view(_months(spark, sf_dir)), "value", "heat_value")


def months_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.months_matrix(months_view(spark, sf_dir))


def airports_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.airports_view(_busiest(spark, sf_dir, "Year"))


def airports_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.airports_summary(airports_view(spark, sf_dir))


def paths_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.paths_view(_paths(spark, sf_dir, "Year"))


def records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.to_records_json(airports_view(spark, sf_dir))


# -- sources, sinks, ingest ----------------------------------------------------------------------


def flights_for_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.flights_for_year(flights(spark, sf_dir), 1998)


def _profile(frame: DataFrame) -> DataFrame:
    """What a stored copy must still hold, by month and carrier."""
    return frame.groupBy("Year", "Month", "UniqueCarrier").agg(
        F.count("*").alias("n_flights"),
        F.count("ArrDelay").alias("n_arrived"),
        F.sum("ArrDelay").alias("arr_minutes"),
        F.sum("DepDelay").alias("dep_minutes"),
        F.sum("Cancelled").alias("n_cancelled"),
        F.min("Origin").alias("first_origin"),
        F.max("Dest").alias("last_dest"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    sources.consolidate_csv(as_flights(flights(spark, sf_dir)), path)
    return _profile(sources.read_flights_csv(spark, path))


def _bucketed(spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS) -> str:
    path = scratch_dir(spark, "bucketed")
    table = "flights_" + path.rsplit("-", 1)[1]
    sources.write_bucketed(flights(spark, sf_dir, columns), table, path)
    # Only the catalog entry goes; the files are in a folder of their own.
    spark.sql(f"DROP TABLE {table}")
    return path


def bucketed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(sources.read_flights_parquet(spark, _bucketed(spark, sf_dir)))


def ingest_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to bucketed table, two years only."""
    csv, path = scratch_dir(spark, "csv"), scratch_dir(spark, "bucketed")
    sources.consolidate_csv(as_flights(flights(spark, sf_dir)), csv)
    table = "flights_" + path.rsplit("-", 1)[1]
    plans.ingest(spark, csv, table, years=(1998, 2000), path=path)
    spark.sql(f"DROP TABLE {table}")
    return _profile(sources.read_flights_parquet(spark, path))


def table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years ingested twice, the second time in their own place, and read by the table's name."""
    csv, path = scratch_dir(spark, "csv"), scratch_dir(spark, "bucketed")
    sources.consolidate_csv(as_flights(flights(spark, sf_dir)), csv)
    table = "flights_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        plans.ingest(spark, csv, table, years=(1998, 2000), path=path, replace=True)
    found = sources.read_flights_table(spark, table)
    spark.sql(f"DROP TABLE {table}")
    return _profile(found)


def airports_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airports from a CSV file with more columns, in another order."""
    path = scratch_dir(spark, "airports")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_regionkey")
    named = airports(spark, sf_dir).join(nation, F.col("iata") == F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    named.select("n_regionkey", "airport", "iata").write.option("header", True).csv(path)
    return sources.read_airports(spark, path)


def table_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of the bucketed table, of which only their buckets are read."""
    path = scratch_dir(spark, "bucketed")
    table = "flights_" + path.rsplit("-", 1)[1]
    sources.write_bucketed(as_flights(flights(spark, sf_dir)), table, path)
    found = sources.read_flights_table(spark, table, months=(2, 7))
    spark.sql(f"DROP TABLE {table}")
    return _profile(found)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights as CSV in which some delays and flags are words: what is read, and what is set aside
    for which reason, by year."""
    csv, aside = scratch_dir(spark, "csv"), scratch_dir(spark, "quarantine")
    rows = as_flights(flights(spark, sf_dir))
    words = {
        "ArrDelay": F.when(F.col("ArrDelay") == 40, "late").otherwise(F.col("ArrDelay").cast("string")),
        "Cancelled": F.when(F.col("DepDelay") == 20, "no").otherwise(F.col("Cancelled").cast("string")),
    }
    sources.consolidate_csv(rows.withColumns(words), csv)
    good = sources.read_flights_checked(spark, csv, aside, most=0.5)
    bad = spark.read.parquet(aside).select(F.split("record", ",")[0].cast("int").alias("Year"), "reason")
    both = good.select("Year", F.lit("none").alias("reason")).unionByName(bad)
    return both.groupBy("Year", "reason").agg(F.count("*").alias("n_records"))


# -- streams -------------------------------------------------------------------------------------


# Bytes per micro-batch, whatever the cluster: some minutes' work of a large one.
BATCH_BYTES = 100 << 30
# A delivery is a run of its own; more of them than this is a damaged date column.
MOST_YEARS = 200


def _stream_running(spark: SparkSession, sf_dir: str, name: str, per: str | None) -> DataFrame:
    landing, results = scratch_dir(spark, "landing"), scratch_dir(spark, "results")
    sources.write_per_year(_flights_for(spark, sf_dir, name), landing)
    streaming.run_running(
        name,
        sources.stream_flights(spark, f"{landing}/*/", max_bytes=BATCH_BYTES),
        results,
        scratch_dir(spark, "checkpoint"),
        airports(spark, sf_dir),
        per,
        STATE_PARTITIONS,
    )
    return streaming.latest_batch(spark, results).drop("batch_id")


def _years_delivered(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> Iterator[str]:
    """Deliver one year after the other to a landing folder, and name what a stream reads after each.

    The data is written once, a folder per year, and a year is delivered by a rename. The years come
    from the folders' names; more than ``MOST_YEARS`` are refused, as each is a run of its own.
    """
    waiting, landing = scratch_dir(spark, "waiting"), scratch_dir(spark, "landing")
    sources.write_per_year(flights(spark, sf_dir, columns), waiting)
    years = sorted(streaming.folder_names(spark, waiting))
    if len(years) > MOST_YEARS:
        raise ValueError(f"{len(years)} years to deliver; at most {MOST_YEARS} are")
    for year in years:
        streaming.deliver(spark, f"{waiting}/{year}", f"{landing}/{year}")
        yield f"{landing}/*/"


def _stream_by_year(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Answer for each year as it arrives. A delivery is one batch, however many files it holds."""
    results, checkpoint = scratch_dir(spark, "results"), scratch_dir(spark, "checkpoint")
    named = airports(spark, sf_dir)
    for landing in _years_delivered(spark, sf_dir, QUESTIONS[name].columns):
        stream = sources.stream_flights(spark, landing, max_files=None)
        streaming.run_per_batch(name, stream, results, checkpoint, named)
    return results


def stream_carrier_punctuality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_stream_running(spark, sf_dir, "carrier_punctuality", None), "punctuality")


def stream_worst_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_stream_running(spark, sf_dir, "worst_months", None), "non_punctuality")


def stream_busiest_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_running(spark, sf_dir, "busiest_airports", "Year")


def stream_busy_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_running(spark, sf_dir, "busy_paths", "Year")


def stream_month_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts over the files of the bucketed table."""
    results, checkpoint = scratch_dir(spark, "results"), scratch_dir(spark, "checkpoint")
    table = _bucketed(spark, sf_dir, ("Year", "Month"))
    table_files = sources.stream_flights(spark, table, max_bytes=BATCH_BYTES)
    streaming.count_months(table_files, results, checkpoint, STATE_PARTITIONS)
    return streaming.keyed_rows(spark, results)


def stream_month_year_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts in SQL over a temporary view of the stream."""
    landing, results = scratch_dir(spark, "landing"), scratch_dir(spark, "results")
    sources.write_per_year(flights(spark, sf_dir, ("Year", "Month")), landing)
    stream = sources.stream_flights(spark, f"{landing}/*/", max_bytes=BATCH_BYTES)
    view = "arriving_" + landing.rsplit("-", 1)[1]
    counts = ops.month_year_counts_sql(stream.select("Year", "Month"), view)
    streaming.drain(
        counts,
        streaming.keyed_sink(results, ["Month", "Year"]),
        scratch_dir(spark, "checkpoint"),
        state_partitions=STATE_PARTITIONS,
    )
    spark.catalog.dropTempView(view)
    return streaming.keyed_rows(spark, results)


def stream_until_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts by a query that waits for more until it is stopped."""
    landing, results = scratch_dir(spark, "landing"), scratch_dir(spark, "results")
    sources.write_per_year(flights(spark, sf_dir, ("Year", "Month")), landing)
    query = streaming.count_months(
        sources.stream_flights(spark, f"{landing}/*/", max_bytes=BATCH_BYTES),
        results,
        scratch_dir(spark, "checkpoint"),
        STATE_PARTITIONS,
        available_now=False,
        interval="1 second",
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return streaming.keyed_rows(spark, results)


def stream_contents_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every yearly folder is delivered twice, the second time under another name, and counts once."""
    landing, table = scratch_dir(spark, "landing"), scratch_dir(spark, "counts")
    sources.write_per_year(flights(spark, sf_dir, ("Year", "Month")), landing)
    checkpoint = scratch_dir(spark, "checkpoint")

    def count(rows: DataFrame, batch_id: int) -> None:
        streaming.merge_rows(ops.month_year_counts(rows), table, ["Month", "Year"], batch_id, add=True)

    for again in range(2):
        if again:
            for year in streaming.folder_names(spark, landing):
                streaming.copy(spark, f"{landing}/{year}", f"{landing}/again_{year}")
        stream = sources.stream_new_contents(spark, f"{landing}/*/")
        streaming.drain(stream, sources.on_new_flights(count), checkpoint, state_partitions=STATE_PARTITIONS)
    return streaming.keyed_rows(spark, table)


def stream_shown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the console shows of the running counts: the first ten rows of a batch."""
    landing, shown = scratch_dir(spark, "landing"), scratch_dir(spark, "shown")
    sources.write_per_year(flights(spark, sf_dir, ("Year", "Month")), landing)
    stream = sources.stream_flights(spark, f"{landing}/*/", max_files=None).select("Year", "Month")
    sink = streaming.console_sink(10, [F.asc("Year"), F.asc("Month")], shown)
    counts = ops.month_year_counts(stream)
    streaming.drain(counts, sink, scratch_dir(spark, "checkpoint"), state_partitions=STATE_PARTITIONS)
    return streaming.all_batches(spark, shown)


def stream_skipping_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty delivery, then all flights: the empty batch leaves no result."""
    landing, results = scratch_dir(spark, "landing"), scratch_dir(spark, "results")
    checkpoint, rows = scratch_dir(spark, "checkpoint"), _flights_for(spark, sf_dir, "worst_months")
    for name, part in (("0", rows.limit(0)), ("1", rows)):
        part.write.parquet(f"{landing}/{name}")
        stream = sources.stream_flights(spark, f"{landing}/*/", max_files=None)
        streaming.run_per_batch("worst_months", stream, results, checkpoint, skip_empty=True)
    return _rounded(streaming.all_batches(spark, results), "non_punctuality")


def stream_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heat map as it fills up: worst months of each delivered year."""
    months = streaming.all_batches(spark, _stream_by_year(spark, sf_dir, "worst_months"))
    return _rounded(months, "non_punctuality")


def stream_all_batches_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line chart as it grows: carriers of each delivered year."""
    carriers = streaming.all_batches(spark, _stream_by_year(spark, sf_dir, "carrier_punctuality"))
    return _rounded(carriers, "punctuality")


def stream_batches_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worst months of the years delivered after the second one."""
    months = streaming.batches_since(spark, _stream_by_year(spark, sf_dir, "worst_months"), since=1)
    return _rounded(months, "non_punctuality")


def stream_unread_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that takes the newest unread year until none is left, with the turn of each."""
    results, taken = _stream_by_year(spark, sf_dir, "worst_months"), []
    while (rows := streaming.take_unread(spark, results, "dashboard")) is not None:
        taken.append(rows.withColumn("turn", F.lit(len(taken)).cast("bigint")))
    return _rounded(reduce(DataFrame.unionByName, taken), "non_punctuality")


def stream_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars on show at the end: busiest airports of the year delivered last."""
    return streaming.latest_batch(spark, _stream_by_year(spark, sf_dir, "busiest_airports"))


def stream_latest_batch_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table on show at the end: busy paths of the year delivered last."""
    return streaming.latest_batch(spark, _stream_by_year(spark, sf_dir, "busy_paths"))


def _in_one_shape(spark: SparkSession, root: str) -> DataFrame:
    """The answers to all questions, batch by batch, as ``question, batch_id, Year, name, other, value``."""
    shapes = {
        "carrier_punctuality": ("UniqueCarrier", None, "punctuality"),
        "worst_months": ("Month", None, "non_punctuality"),
        "busiest_airports": ("airport", None, "total_count"),
        "busy_paths": ("Origin", "Dest", "total_flights"),
    }
    parts = []
    for question, (name, other, value) in shapes.items():
        parts.append(
            streaming.all_batches(spark, f"{root}/{question}").select(
                F.lit(question).alias("question"),
                "batch_id",
                "Year",
                F.col(name).cast("string").alias("name"),
                (F.col(other) if other else F.lit(None).cast("string")).alias("other"),
                F.round(F.col(value).cast("double"), 9).alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def stream_all_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four questions over one stream, a year at a time."""
    root, checkpoint = scratch_dir(spark, "questions"), scratch_dir(spark, "checkpoint")
    for landing in _years_delivered(spark, sf_dir, COLUMNS):
        stream = sources.stream_flights(spark, landing, max_files=None)
        streaming.run_all_questions(stream, root, checkpoint, airports(spark, sf_dir))
    return _in_one_shape(spark, root)


def stream_all_questions_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four questions for everything read so far, from roll-ups kept between batches."""
    landing, root = scratch_dir(spark, "landing"), scratch_dir(spark, "questions")
    sources.write_per_year(flights(spark, sf_dir), landing)
    checkpoint = scratch_dir(spark, "checkpoint")
    years = sorted(streaming.folder_names(spark, landing))
    for some in (years[:3], years[3:]):
        for year in some:
            streaming.deliver(spark, f"{landing}/{year}", f"{landing}-delivered/{year}")
        stream = sources.stream_flights(spark, f"{landing}-delivered/*/", max_files=None)
        streaming.run_all_questions(stream, root, checkpoint, airports(spark, sf_dir), "Year", running=True)
    return _in_one_shape(spark, root).where("batch_id = 1").drop("batch_id")


def _history(spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str]) -> DataFrame:
    """The roll-up of a question over all years, kept in a table and added to by two runs."""
    path, rows = scratch_dir(spark, "history"), _flights_for(spark, sf_dir, name)
    early = F.coalesce(F.col("Year") <= 1995, F.lit(False))
    for run, part in enumerate((early, ~early)):
        streaming.merge_rows(QUESTIONS[name].rollup(rows.where(part)), path, keys, run, add=True)
    return streaming.keyed_rows(spark, path)


def carrier_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most punctual carrier of all history first."""
    return plans.carrier_ranking(_history(spark, sf_dir, "carrier_punctuality", ["Year", "Month", "UniqueCarrier"]))


def month_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst month of all history first."""
    return plans.month_ranking(_history(spark, sf_dir, "worst_months", ["Year", "Month"]))


_ALL: Sequence[Query] = (
    delay_flags,
    carrier_monthly,
    monthly_penalties,
    route_counts,
    carrier_punctuality,
    worst_months,
    busiest_airports,
    busiest_airports_per_year,
    busy_paths,
    busy_paths_per_year,
    month_year_counts,
    month_year_counts_sql,
    carrier_view,
    carrier_matrix,
    months_view,
    months_matrix,
    airports_view,
    airports_summary,
    paths_view,
    records_json,
    flights_for_year,
    csv_roundtrip,
    bucketed_roundtrip,
    ingest_years,
    table_by_name,
    airports_csv,
    table_month,
    csv_quarantine,
    stream_carrier_punctuality,
    stream_worst_months,
    stream_busiest_airports,
    stream_busy_paths,
    stream_month_year_counts,
    stream_month_year_counts_sql,
    stream_until_stopped,
    stream_contents_once,
    stream_shown_rows,
    stream_skipping_empty,
    stream_all_batches,
    stream_all_batches_carriers,
    stream_batches_since,
    stream_unread_batches,
    stream_all_questions,
    stream_all_questions_running,
    carrier_ranking,
    month_ranking,
    stream_latest_batch,
    stream_latest_batch_paths,
)

QUERIES: dict[str, Query] = {query.__name__: query for query in _ALL}
