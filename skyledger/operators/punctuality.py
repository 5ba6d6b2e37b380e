"""How punctual each carrier was, and how bad each month was."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import share, with_is_delayed, with_penalty
from skyledger.functions.flags import ON_TIME_MINUTES


def carrier_monthly(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Roll-up: delayed and all flights of each carrier in each month.

    Both counts come from one aggregate over one scan, so a null carrier is a group like any
    other and nothing needs joining back together.
    """
    return (
        with_is_delayed(flights, threshold)
        .groupBy("Year", "Month", "UniqueCarrier")
        .agg(
            F.sum("is_delayed").alias("num_delayed_flights"),
            F.count("is_delayed").alias("num_total_flights"),
        )
    )


def finish_carriers(monthly: DataFrame) -> DataFrame:
    """Yearly punctuality (0..1): the plain mean of the carrier's monthly ratios."""
    return (
        monthly.withColumn("punctuality", 1 - share("num_delayed_flights", "num_total_flights"))
        .groupBy("Year", "UniqueCarrier")
        .agg(F.avg("punctuality").alias("punctuality"))
    )


def carrier_punctuality(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """``Year, UniqueCarrier, punctuality``."""
    return finish_carriers(carrier_monthly(flights, threshold))


def monthly_penalties(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Roll-up: bad flights of each month, and flights with a known arrival delay."""
    return (
        with_penalty(flights, threshold)
        .groupBy("Year", "Month")
        .agg(
            F.sum("penalty").alias("num_bad_flights"),
            F.count("ArrDelay").alias("num_total_flights"),
        )
    )


def finish_months(penalties: DataFrame) -> DataFrame:
    """Ratio of bad flights. Cancelled flights count only above the line, so it may exceed 1,
    and it is null for a month in which nothing arrived."""
    return penalties.select(
        "Year", "Month", share("num_bad_flights", "num_total_flights").alias("non_punctuality")
    )


def worst_months(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """``Year, Month, non_punctuality``."""
    return finish_months(monthly_penalties(flights, threshold))
