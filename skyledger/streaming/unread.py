"""Taking batches one by one: the newest that a reader has not had yet, each once.

A reader is known by its name. What it has taken is kept in numbered files beside the results, one
for each batch taken, each with the whole state: up to which batch commits were looked at, and
which of them are still unread, as ranges. The next number is created once only, so of several
processes reading under one name each batch goes to one; the others look again.
"""

import json

from pyspark.sql import DataFrame, SparkSession

from skyledger.streaming.commits import Commits
from skyledger.streaming.files import create_once, file_names, read_text
from skyledger.streaming.results import batches_since


def _state(spark: SparkSession, folder: str) -> tuple[int, dict]:
    numbers = [int(n) for n in file_names(spark, folder) if n.isdigit()]
    if not numbers:
        return -1, {"seen": -1, "unread": []}
    return max(numbers), json.loads(read_text(spark, f"{folder}/{max(numbers):020d}"))


def _ranges(ids: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for i in ids:
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return out


def take_unread(spark: SparkSession, path: str, reader: str) -> DataFrame | None:
    """The newest batch with rows that ``reader`` has not taken, now taken; None if there is none.

    Batches that arrive later come first, and those left behind come back after them. A reader
    that dies between taking a batch and using it has had it.
    """
    if not reader or "/" in reader:
        raise ValueError(f"not the name of a reader: {reader!r}")
    log, folder = Commits(spark, path), f"{path}/_readers/{reader}"
    while True:
        number, state = _state(spark, folder)
        fresh = {i: e for i, e in log.entries(since=state["seen"] if state["seen"] >= 0 else None).items()}
        unread = [*state["unread"], *_ranges([i for i, e in fresh.items() if e["rows"]])]
        if not unread:
            return None
        low, taken = unread.pop()
        if low < taken:
            unread.append([low, taken - 1])
        seen = max([state["seen"], *fresh])
        if create_once(spark, f"{folder}/{number + 1:020d}", json.dumps({"seen": seen, "unread": unread, "taken": taken})):
            return batches_since(spark, path, taken - 1, taken)


def count_unread(spark: SparkSession, path: str, reader: str) -> int:
    """How many batches :func:`take_unread` would give."""
    _, state = _state(spark, f"{path}/_readers/{reader}")
    fresh = Commits(spark, path).entries(since=state["seen"] if state["seen"] >= 0 else None)
    return sum(b - a + 1 for a, b in state["unread"]) + sum(1 for e in fresh.values() if e["rows"])
