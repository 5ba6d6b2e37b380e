"""Whole jobs built from the operators: ingest, display views, and the named questions."""

from skyledger.plans.ingest import flights_for_year, ingest
from skyledger.plans.questions import QUESTIONS, Question
from skyledger.plans.rollups import all_rollups, carrier_ranking, month_ranking, rollup_for
from skyledger.plans.views import (
    airports_summary,
    airports_view,
    carrier_matrix,
    carrier_view,
    months_matrix,
    months_view,
    paths_view,
    to_records_json,
)

__all__ = [
    "QUESTIONS",
    "Question",
    "airports_summary",
    "airports_view",
    "all_rollups",
    "carrier_matrix",
    "carrier_ranking",
    "carrier_view",
    "flights_for_year",
    "ingest",
    "month_ranking",
    "months_matrix",
    "months_view",
    "paths_view",
    "rollup_for",
    "to_records_json",
]
