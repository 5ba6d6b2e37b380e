"""Questions over streams, and the results folders they write."""

from skyledger.streaming.files import copy, deliver, folder_names
from skyledger.streaming.keyed import keyed_rows, keyed_sink, merge_rows
from skyledger.streaming.results import (
    all_batches,
    batches_since,
    compact,
    console_sink,
    drop_lost_attempts,
    latest_batch,
    latest_per_key,
    results_sink,
)
from skyledger.streaming.runner import (
    count_months,
    drain,
    questions_sink,
    run_all_questions,
    run_per_batch,
    run_running,
    start_stream,
)
from skyledger.streaming.unread import count_unread, take_unread

__all__ = [
    "all_batches",
    "batches_since",
    "compact",
    "console_sink",
    "copy",
    "count_months",
    "count_unread",
    "deliver",
    "drain",
    "drop_lost_attempts",
    "folder_names",
    "keyed_rows",
    "keyed_sink",
    "latest_batch",
    "latest_per_key",
    "merge_rows",
    "questions_sink",
    "results_sink",
    "run_all_questions",
    "run_per_batch",
    "run_running",
    "start_stream",
    "take_unread",
]
