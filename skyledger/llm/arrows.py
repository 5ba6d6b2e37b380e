"""Helpers of the functions that run inside tasks."""

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute


def kept(kind: str, key, make: Callable):
    """What ``make`` gives, made once in each Python worker and used by its next tasks too.

    Functions of this package travel to tasks by value, and their globals are new in each task;
    a module entry of the worker itself outlives them.
    """
    place = vars(sys.modules.setdefault("skyledger.llm.worker", types.ModuleType("skyledger.llm.worker")))
    if (kind, key) not in place:
        place[kind, key] = make()
    return place[kind, key]


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Each batch in slices whose binary ``column`` has ``most`` bytes or a single row."""
    for batch in batches:
        start, total = 0, 0
        for i, size in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            size = size or 0
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)
