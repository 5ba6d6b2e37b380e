"""All questions from one scan, and their roll-ups over all of history.

The four questions need three roll-ups: by carrier and month, by month, by route and year. They come
from one aggregate over the union of their keys (grouping sets), so the flights are read once. Its
rows add up over any split of the input; kept in a keyed table they stand for all flights so far.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import ranked, share, with_is_delayed, with_penalty
from skyledger.functions.flags import ON_TIME_MINUTES
from skyledger.operators import finish_months

KEYS = ("Year", "Month", "UniqueCarrier", "Origin", "Dest")
COLUMNS = (*KEYS, "ArrDelay", "DepDelay", "Cancelled")
# Each kind of roll-up: its keys, and its columns by the names that the questions know.
_KINDS = {
    "carriers": (("Year", "Month", "UniqueCarrier"), {"num_delayed_flights": "n_delayed", "num_total_flights": "n_flights"}),
    "months": (("Year", "Month"), {"num_bad_flights": "n_bad", "num_total_flights": "n_arrived"}),
    "routes": (("Origin", "Dest", "Year"), {"total_flights": "n_flights"}),
}
# The roll-up behind each question.
KIND_OF = {"carrier_punctuality": "carriers", "worst_months": "months", "busiest_airports": "routes", "busy_paths": "routes"}


def _mark(keys: Sequence[str]) -> int:
    """What ``grouping_id`` says of a row grouped by ``keys``: a bit for each key left out."""
    return sum(1 << (len(KEYS) - 1 - i) for i, key in enumerate(KEYS) if key not in keys)


def all_rollups(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """``kind``, the keys (null where the kind has none) and four counts, from one scan."""
    flagged = with_penalty(with_is_delayed(flights, threshold), threshold)
    sets = [[F.col(key) for key in keys] for keys, _ in _KINDS.values()]
    kind: Column = F.lit(None).cast("string")
    for name, (keys, _) in _KINDS.items():
        kind = F.when(F.grouping_id() == _mark(keys), name).otherwise(kind)
    counts = flagged.groupingSets(sets, *KEYS).agg(
        kind.alias("kind"),
        F.sum("is_delayed").alias("n_delayed"),
        F.count("*").alias("n_flights"),
        F.sum("penalty").alias("n_bad"),
        F.count("ArrDelay").alias("n_arrived"),
    )
    return counts.select("kind", *KEYS, "n_delayed", "n_flights", "n_bad", "n_arrived")


def rollup_for(rollups: DataFrame, question: str) -> DataFrame:
    """The roll-up that a question finishes, out of those of all."""
    kind = KIND_OF[question]
    keys, names = _KINDS[kind]
    return rollups.where(F.col("kind") == kind).select(*keys, *(F.col(was).alias(name) for name, was in names.items()))


def carrier_ranking(monthly: DataFrame, digits: int = 9) -> DataFrame:
    """``rank, UniqueCarrier, punctuality, n_flights``: carriers by the plain mean of their monthly
    punctuality over all of history, the most punctual first; equal ones share a rank. Rounded
    first, so that the order of addition cannot part equals."""
    ratio = 1 - share("num_delayed_flights", "num_total_flights")
    means = monthly.groupBy("UniqueCarrier").agg(
        F.round(F.avg(ratio), digits).alias("punctuality"), F.sum("num_total_flights").alias("n_flights")
    )
    return ranked(means, ["-punctuality"]).select("rank", "UniqueCarrier", "punctuality", "n_flights")


def month_ranking(penalties: DataFrame, digits: int = 9) -> DataFrame:
    """``rank, Year, Month, non_punctuality``: all months of history, the worst first, those in which
    nothing arrived last."""
    months = finish_months(penalties).withColumn("non_punctuality", F.round("non_punctuality", digits))
    return ranked(months, ["-non_punctuality"]).select("rank", "Year", "Month", "non_punctuality")
