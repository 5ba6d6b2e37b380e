"""Flags derived from one flight record."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: minutes of delay that still count as on time.
ON_TIME_MINUTES = 30


def with_total_delay(flights: DataFrame) -> DataFrame:
    """Add ``total_delay``: minutes lost at both ends, null if either is unknown."""
    return flights.withColumn("total_delay", F.col("ArrDelay") + F.col("DepDelay"))


def with_is_delayed(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Add ``is_delayed`` (0/1). An unknown total delay, as of a cancelled flight, is 0."""
    late = F.col("total_delay") > threshold
    return with_total_delay(flights).withColumn("is_delayed", F.when(late, 1).otherwise(0))


def with_penalty(flights: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Add ``penalty`` (0/1): arrived late, or cancelled."""
    bad = (F.col("ArrDelay") > threshold) | (F.col("Cancelled") > 0)
    return flights.withColumn("penalty", F.when(bad, 1).otherwise(0))


def share(part: str, whole: str) -> Column:
    """``part / whole`` as a double; null where ``whole`` is zero."""
    return F.try_divide(F.col(part), F.col(whole))
