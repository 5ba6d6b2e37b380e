import time

import hand
import pytest
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger import sources, streaming
from skyledger.plans import QUESTIONS
from skyledger.schema import as_flights
from skyledger.workload.queries import BATCH_BYTES


@pytest.fixture(scope="module")
def flights(spark):
    return as_flights(hand.flights(spark)).cache()


@pytest.fixture(scope="module")
def airports(spark):
    return hand.airports(spark)


@pytest.fixture(scope="module")
def by_year(flights, tmp_path_factory):
    """One file per year."""
    path = str(tmp_path_factory.mktemp("by_year") / "data")
    sources.write_per_year(flights, path)
    return path + "/*/"


@pytest.fixture(scope="module")
def split_months(flights, tmp_path_factory):
    """Four files, with every month of the first year cut in two."""
    path = tmp_path_factory.mktemp("split_months")
    numbered = flights.coalesce(1).withColumn("n", F.monotonically_increasing_id())
    for part in range(4):
        piece = numbered.where(F.col("n") % 4 == part).drop("n").coalesce(1)
        piece.write.parquet(str(path / str(part)))
    return f"{path}/*/"


def folders(tmp_path):
    return str(tmp_path / "results"), str(tmp_path / "checkpoint")


def batch_rows(query):
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_a_year_per_batch_gives_the_per_year_answers(
    spark, flights, airports, by_year, tmp_path, name
):
    results, checkpoint = folders(tmp_path)
    stream = sources.stream_flights(spark, by_year)
    query = streaming.run_per_batch(name, stream, results, checkpoint, airports)
    # Every flight was read once, however many steps the answer has.
    assert sorted(batch_rows(query)) == [5, 7]
    got = streaming.all_batches(spark, results)
    assert got.select("batch_id").distinct().count() == 2
    want = hand.rows(QUESTIONS[name].answer(flights, airports, "Year"))
    assert hand.rows(got.drop("batch_id")) == want
    newest = streaming.latest_batch(spark, results)
    assert hand.rows(newest.select("batch_id").distinct()) == {(1,)}
    assert newest.count() < got.count()


def test_batches_that_split_a_month_change_per_batch_answers(
    spark, flights, split_months, tmp_path
):
    results, checkpoint = folders(tmp_path)
    stream = sources.stream_flights(spark, split_months)
    streaming.run_per_batch("worst_months", stream, results, checkpoint)
    got = streaming.all_batches(spark, results)
    assert got.count() > ops.worst_months(flights).count()


@pytest.mark.parametrize(
    ("name", "per"),
    [
        ("carrier_punctuality", None),
        ("worst_months", None),
        ("busiest_airports", None),
        ("busiest_airports", "Year"),
        ("busy_paths", None),
        ("busy_paths", "Year"),
    ],
)
def test_running_answers_do_not_depend_on_the_split(
    spark, flights, airports, by_year, split_months, tmp_path, name, per
):
    want = hand.rows(QUESTIONS[name].answer(flights, airports, per))
    for label, path, batches in (("y", by_year, 2), ("m", split_months, 4)):
        results, checkpoint = str(tmp_path / f"r{label}"), str(tmp_path / f"c{label}")
        stream = sources.stream_flights(spark, path)
        query = streaming.run_running(
            name, stream, results, checkpoint, airports, per, state_partitions=4
        )
        assert sum(batch_rows(query)) == len(hand.FLIGHTS)
        got = streaming.latest_batch(spark, results)
        assert hand.rows(got.select("batch_id").distinct()) == {(batches - 1,)}
        assert hand.rows(got.drop("batch_id")) == want


def test_running_counts(spark, flights, split_months, tmp_path):
    results, checkpoint = folders(tmp_path)
    table = str(tmp_path / "table")
    streaming.count_months(sources.stream_flights(spark, split_months), table, str(tmp_path / "c2"))
    counts = ops.month_year_counts(sources.stream_flights(spark, split_months))
    streaming.drain(counts, streaming.results_sink(results, lambda b: b), checkpoint)
    want = hand.rows(ops.month_year_counts(flights))
    assert hand.rows(streaming.keyed_rows(spark, table)) == want
    assert hand.rows(streaming.latest_per_key(spark, results, ["Month", "Year"])) == want
    # Each batch wrote only what it changed, as totals so far.
    changes = streaming.all_batches(spark, results).collect()
    assert len(changes) < 4 * len(want)
    january = sorted((r.batch_id, r.n_flights) for r in changes if (r.Month, r.Year) == (1, 2001))
    assert [n for _, n in january] == [1, 2, 3, 4]


def test_counts_in_sql_on_a_stream(spark, flights, by_year, tmp_path):
    results, checkpoint = folders(tmp_path)
    counts = ops.month_year_counts_sql(sources.stream_flights(spark, by_year), "streamed_flights")
    streaming.drain(counts, streaming.results_sink(results, lambda b: b), checkpoint)
    got = streaming.all_batches(spark, results).drop("batch_id")
    assert hand.rows(got) == hand.rows(ops.month_year_counts(flights))


def test_stream_over_a_bucketed_table(spark, flights, tmp_path):
    sources.write_bucketed(flights, "streamed_table", str(tmp_path / "table"))
    results, checkpoint = folders(tmp_path)
    try:
        stream = sources.stream_flights(spark, str(tmp_path / "table"), max_files=2)
        streaming.count_months(stream, results, checkpoint)
        assert hand.rows(streaming.keyed_rows(spark, results)) == hand.rows(ops.month_year_counts(flights))
    finally:
        spark.sql("DROP TABLE streamed_table")


def test_a_batch_run_again_counts_once(spark, flights, tmp_path):
    results = str(tmp_path / "results")
    sink = streaming.results_sink(results, ops.worst_months)
    for batch_id in (0, 1, 1):
        sink(flights.where(F.col("Year") == 2000 + batch_id), batch_id)
    got = streaming.all_batches(spark, results)
    assert hand.rows(got.drop("batch_id")) == hand.rows(ops.worst_months(flights))


def test_empty_batches(spark, flights, tmp_path):
    nothing = flights.where("Year = 1900")
    kept, skipped = str(tmp_path / "kept"), str(tmp_path / "skipped")
    streaming.results_sink(kept, ops.worst_months)(nothing, 0)
    assert streaming.all_batches(spark, kept).count() == 0
    sink = streaming.results_sink(skipped, ops.worst_months, skip_empty=True)
    sink(nothing, 0)
    sink(flights, 1)
    assert hand.rows(streaming.all_batches(spark, skipped).select("batch_id").distinct()) == {(1,)}
    # The session outlives an empty batch.
    assert spark.range(3).count() == 3


def test_console(spark, by_year, tmp_path, capfd):
    counts = ops.month_year_counts(sources.stream_flights(spark, by_year))
    streaming.drain(counts, streaming.console_sink(2), str(tmp_path / "checkpoint"))
    shown = capfd.readouterr().out
    assert shown.count("|Month|Year|n_flights|") == 2
    assert "only showing top 2 rows" in shown


def test_new_files_after_a_restart(spark, flights, tmp_path):
    """A second run reads only what arrived since; ``max_files=None`` takes it in one batch."""
    results, checkpoint = folders(tmp_path)
    for year in (2000, 2001):
        arriving = flights.where(F.col("Year") == year).repartition(3, "Month")
        arriving.write.parquet(str(tmp_path / "landing" / str(year)))
        stream = sources.stream_flights(spark, f"{tmp_path}/landing/*/", max_files=None)
        streaming.run_per_batch("carrier_punctuality", stream, results, checkpoint)
    got = streaming.all_batches(spark, results)
    years = got.select("batch_id", "Year").distinct()
    assert hand.rows(years) == {(0, 2000), (1, 2001)}
    assert hand.rows(got.drop("batch_id")) == hand.rows(ops.carrier_punctuality(flights))


def test_continuous_query(spark, by_year, tmp_path):
    results, checkpoint = folders(tmp_path)
    counts = ops.month_year_counts(sources.stream_flights(spark, by_year).select("Year", "Month"))
    sink = streaming.results_sink(results, lambda b: b)
    spark.streams.resetTerminated()
    query = streaming.start_stream(counts, sink, checkpoint, available_now=False)
    try:
        query.processAllAvailable()
        assert query.isActive
        assert not spark.streams.awaitAnyTermination(1)
    finally:
        query.stop()
    deadline = time.time() + 30
    while query.isActive and time.time() < deadline:
        time.sleep(0.1)
    assert not query.isActive
    assert streaming.all_batches(spark, results).count() == 5


def test_state_partitions_are_the_querys_own(spark, by_year, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results, checkpoint = folders(tmp_path)
    stream = sources.stream_flights(spark, by_year)
    query = streaming.count_months(stream, results, checkpoint, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"
    states = [op.numShufflePartitions for p in query.recentProgress for op in p.stateOperators]
    assert states and set(states) == {3}


def test_errors_in_a_batch_surface(spark, by_year, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is full")

    with pytest.raises(Exception, match="sink is full"):
        streaming.drain(
            sources.stream_flights(spark, by_year), fail, str(tmp_path / "checkpoint")
        )


def test_a_results_folder_belongs_to_one_query(spark, by_year, tmp_path):
    results = str(tmp_path / "results")
    stream = sources.stream_flights(spark, by_year)
    streaming.run_per_batch("worst_months", stream, results, str(tmp_path / "one"))
    streaming.run_per_batch("worst_months", stream, results, str(tmp_path / "one"))
    before = hand.rows(streaming.latest_batch(spark, results))
    with pytest.raises(Exception, match="another query"):
        streaming.run_per_batch("worst_months", stream, results, str(tmp_path / "two"))
    assert hand.rows(streaming.latest_batch(spark, results)) == before


def test_no_results_yet(spark, tmp_path):
    for read in (streaming.latest_batch, streaming.all_batches):
        assert read(spark, str(tmp_path / "none")).collect() == []
    assert streaming.latest_per_key(spark, str(tmp_path / "none"), ["Year"]).collect() == []


def test_compact_keeps_the_newest_rows(spark, by_year, tmp_path):
    results, small = str(tmp_path / "results"), str(tmp_path / "small")
    counts = ops.month_year_counts(sources.stream_flights(spark, by_year))
    streaming.drain(counts, streaming.results_sink(results, lambda b: b), str(tmp_path / "c"))
    keys = ["Month", "Year"]
    streaming.compact(spark, results, keys, small)
    want = hand.rows(streaming.latest_per_key(spark, results, keys))
    assert hand.rows(streaming.latest_per_key(spark, small, keys)) == want


def test_missing_airports_are_told_at_the_start(spark, by_year, tmp_path):
    with pytest.raises(ValueError, match="needs the airports"):
        streaming.run_running("busy_paths", sources.stream_flights(spark, by_year), "r", "c")


def test_a_named_run_can_go_on_and_take_options(spark, flights, by_year, tmp_path):
    results, airports = str(tmp_path / "results"), hand.airports(spark)
    query = streaming.run_running(
        "busy_paths", sources.stream_flights(spark, by_year), results, str(tmp_path / "c"), airports,
        available_now=False, interval="1 second", k=2,
    )
    try:
        assert query.isActive
        query.processAllAvailable()
    finally:
        query.stop()
    got = streaming.latest_batch(spark, results).drop("batch_id")
    assert hand.rows(got) == hand.rows(QUESTIONS["busy_paths"].answer(flights, airports, k=2))


def test_the_workloads_batch_size_is_one_the_source_takes(spark, flights, by_year, tmp_path):
    stream = sources.stream_flights(spark, by_year, max_bytes=BATCH_BYTES)
    query = streaming.count_months(stream, str(tmp_path / "r"), str(tmp_path / "c"))
    assert batch_rows(query) == [12]
    for wrong in ("100g", 0):
        with pytest.raises(ValueError, match="max_bytes"):
            sources.stream_flights(spark, by_year, max_bytes=wrong)


def test_batches_by_bytes(spark, by_year, tmp_path):
    stream = sources.stream_flights(spark, by_year, max_bytes=1)
    query = streaming.count_months(stream, str(tmp_path / "r"), str(tmp_path / "c"))
    assert sorted(batch_rows(query)) == [5, 7]
