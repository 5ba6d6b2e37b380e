"""The questions asked of flight records, as DataFrame functions.

Each answer is split into a roll-up, whose rows add up over any split of the input, and a
finishing step over the roll-up. The streaming layer keeps the roll-up as state.
"""

from skyledger.operators.punctuality import (
    carrier_monthly,
    carrier_punctuality,
    finish_carriers,
    finish_months,
    monthly_penalties,
    worst_months,
)
from skyledger.operators.traffic import (
    airport_totals,
    busiest_airports,
    busy_paths,
    finish_airports,
    finish_paths,
    month_year_counts,
    month_year_counts_sql,
    route_counts,
)

__all__ = [
    "airport_totals",
    "busiest_airports",
    "busy_paths",
    "carrier_monthly",
    "carrier_punctuality",
    "finish_airports",
    "finish_carriers",
    "finish_months",
    "finish_paths",
    "month_year_counts",
    "month_year_counts_sql",
    "monthly_penalties",
    "route_counts",
    "worst_months",
]
