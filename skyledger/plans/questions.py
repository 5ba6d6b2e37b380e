"""The four dashboard questions by name, for batch and stream runners alike."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from skyledger.operators import (
    carrier_monthly,
    finish_airports,
    finish_carriers,
    finish_months,
    finish_paths,
    monthly_penalties,
    route_counts,
)
from skyledger.plans.views import airports_view, carrier_view, months_view, paths_view


@dataclass(frozen=True)
class Question:
    """A question: the columns it reads, its additive roll-up, and the steps after it.

    ``finish(rollup, airports, per)`` turns the roll-up into the answer and ``view(answer)``
    makes it presentable.
    """

    columns: tuple[str, ...]
    rollup: Callable[[DataFrame], DataFrame]
    finish: Callable[..., DataFrame]
    view: Callable[[DataFrame], DataFrame]
    needs_airports: bool = False

    def parted(self, options: dict) -> tuple[dict, dict]:
        """The options of the roll-up (``threshold``) and those of the steps after it (``k``)."""
        known = {"k"} if self.needs_airports else {"threshold"}
        if unknown := set(options) - known:
            raise TypeError(f"not an option of this question: {', '.join(sorted(unknown))}")
        return (options, {}) if not self.needs_airports else ({}, options)

    def answer(
        self, flights: DataFrame, airports: DataFrame | None = None, per: str | None = None, **options
    ) -> DataFrame:
        early, late = self.parted(options)
        return self.finish(self.rollup(flights, **early), airports, per, **late)


QUESTIONS: dict[str, Question] = {
    "carrier_punctuality": Question(
        columns=("Year", "Month", "UniqueCarrier", "ArrDelay", "DepDelay"),
        rollup=carrier_monthly,
        finish=lambda rollup, airports, per: finish_carriers(rollup),
        view=carrier_view,
    ),
    "worst_months": Question(
        columns=("Year", "Month", "ArrDelay", "Cancelled"),
        rollup=monthly_penalties,
        finish=lambda rollup, airports, per: finish_months(rollup),
        view=months_view,
    ),
    "busiest_airports": Question(
        columns=("Year", "Origin", "Dest"),
        rollup=route_counts,
        finish=lambda rollup, airports, per, **top: finish_airports(rollup, airports, per=per, **top),
        view=airports_view,
        needs_airports=True,
    ),
    "busy_paths": Question(
        columns=("Year", "Origin", "Dest"),
        rollup=route_counts,
        finish=lambda rollup, airports, per, **top: finish_paths(rollup, airports, per=per, **top),
        view=paths_view,
        needs_airports=True,
    ),
}
