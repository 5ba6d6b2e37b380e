"""Run questions over streams of flight records."""

import threading

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import month_year_counts
from skyledger.plans.questions import QUESTIONS, Question
from skyledger.plans.rollups import COLUMNS, KEYS, all_rollups, rollup_for
from skyledger.streaming.commits import Commits
from skyledger.streaming.keyed import keyed_rows, keyed_sink, merge_rows
from skyledger.streaming.results import BatchFunction, batches_since, commit_rows, owner_of, results_sink

_PARTITIONS = "spark.sql.shuffle.partitions"
_STARTING = threading.Lock()


def start_stream(
    stream: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    state_partitions: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``on_batch``.

    ``available_now`` reads what is there, in batches of the source's size, and ends. Without
    it the query waits for more, looking every ``interval`` (such as ``10 seconds``) if one is
    given; await it with ``spark.streams.awaitAnyTermination()`` or stop it by its handle.

    Every micro-batch runs one task per state partition, and their number stays as first
    started. A roll-up has few groups however large its input, so ``state_partitions`` can be
    far below the session's shuffle partitions, which are sized for the input.
    """
    if state_partitions is not None:
        return _start_with_partitions(
            state_partitions, stream, on_batch, checkpoint, output_mode, available_now, None, interval
        )
    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _start_with_partitions(partitions: int, stream: DataFrame, *rest) -> StreamingQuery:
    """A query keeps the settings its session had at the start, so they can go back after it.

    Starts take turns. A batch query planned by another thread meanwhile may see the number.
    """
    settings = stream.sparkSession.conf
    with _STARTING:
        before = settings.get(_PARTITIONS)
        settings.set(_PARTITIONS, partitions)
        try:
            return start_stream(stream, *rest)
        finally:
            settings.set(_PARTITIONS, before)


def drain(
    stream: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    output_mode: str = "update",
    state_partitions: int | None = None,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Run a query until it has read all that is there; raises what the query raised.

    Returns the finished query, whose progress tells what each micro-batch read. Without
    ``available_now`` it returns at once and the query goes on until it is stopped.
    """
    query = start_stream(
        stream, on_batch, checkpoint, output_mode, available_now, state_partitions, interval
    )
    if available_now:
        query.awaitTermination()
    return query


def _question(name: str, airports: DataFrame | None) -> Question:
    question = QUESTIONS[name]
    if question.needs_airports and airports is None:
        raise ValueError(f"{name} needs the airports")
    return question


def run_per_batch(
    name: str,
    stream: DataFrame,
    results: str,
    checkpoint: str,
    airports: DataFrame | None = None,
    per: str | None = None,
    skip_empty: bool = False,
    available_now: bool = True,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Answer a question for each micro-batch by itself; nothing is carried over.

    The answers depend on which files share a batch. They are those of the whole input only if
    no group (month, or year for the top-k questions) is split between batches. ``options`` are
    those of the question: ``k`` or ``threshold``.
    """
    question = _question(name, airports)
    sink = results_sink(
        results, lambda batch: question.answer(batch, airports, per, **options), skip_empty
    )
    return drain(
        stream.select(*question.columns), sink, checkpoint, "update", None, available_now, interval
    )


def run_running(
    name: str,
    stream: DataFrame,
    results: str,
    checkpoint: str,
    airports: DataFrame | None = None,
    per: str | None = None,
    state_partitions: int | None = None,
    available_now: bool = True,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Answer a question for everything read so far, after each micro-batch.

    State holds the question's roll-up, whose size is that of its groups, so the answers do not
    depend on how the input is cut into files and batches.
    """
    question = _question(name, airports)
    early, late = question.parted(options)
    sink = results_sink(results, lambda rollup: question.finish(rollup, airports, per, **late))
    rollup = question.rollup(stream.select(*question.columns), **early)
    return drain(rollup, sink, checkpoint, "complete", state_partitions, available_now, interval)


def count_months(
    stream: DataFrame,
    results: str,
    checkpoint: str,
    state_partitions: int | None = None,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Running flight counts by month. Each batch merges the counts that it changed into the keyed
    table ``results``, which has every month once (:func:`keyed_rows`)."""
    counts = month_year_counts(stream.select("Year", "Month"))
    sink = keyed_sink(results, ["Month", "Year"])
    return drain(counts, sink, checkpoint, "update", state_partitions, available_now, interval)


def questions_sink(
    root: str, airports: DataFrame, per: str | None = None, running: bool = False
) -> BatchFunction:
    """Answer all questions for every micro-batch, each in its own results folder under ``root``.

    The batch is scanned once, into the roll-ups of all questions, which are committed before any
    answer. A batch that is run again starts from them, and writes only the answers that are
    missing. ``running`` adds the roll-ups to those of all batches before it and answers from these.
    """
    names = list(QUESTIONS)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        logs = {name: Commits(spark, f"{root}/{name}") for name in ("rollups", *names)}
        for log in logs.values():
            log.claim(owner_of(spark))
        missing = [name for name in names if logs[name].entry(batch_id) is None]
        if not missing:
            return
        if logs["rollups"].entry(batch_id) is None:
            commit_rows(logs["rollups"], all_rollups(batch), batch_id)
        rollups = batches_since(spark, f"{root}/rollups", batch_id - 1, batch_id).drop("batch_id")
        if running:
            merge_rows(rollups, f"{root}/history", ["kind", *KEYS], batch_id, add=True)
            rollups = keyed_rows(spark, f"{root}/history")
        for name in missing:
            commit_rows(logs[name], QUESTIONS[name].finish(rollup_for(rollups, name), airports, per), batch_id)

    return write


def run_all_questions(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    airports: DataFrame,
    per: str | None = None,
    running: bool = False,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """All questions over one stream, under one checkpoint; see :func:`questions_sink`.

    With ``running`` the table ``root/history`` holds the roll-ups of everything read so far.
    """
    sink = questions_sink(root, airports, per, running)
    return drain(stream.select(*COLUMNS), sink, checkpoint, "update", None, available_now, interval)
