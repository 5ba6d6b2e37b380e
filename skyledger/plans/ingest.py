"""From yearly CSV files to the bucketed table."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources import read_flights_csv, write_bucketed


def flights_for_year(flights: DataFrame, year: int) -> DataFrame:
    """The flights of one year; prunes partitions on a table laid out by Year."""
    return flights.where(F.col("Year") == year)


def ingest(
    spark: SparkSession,
    source: str,
    table: str,
    years: Iterable[int] | None = None,
    path: str | None = None,
    replace: bool = False,
) -> None:
    """Append CSV records, of all years or of the given ones, to the bucketed table.

    ``replace`` overwrites the years being loaded, for a job that is run again. The table keeps its rows sorted by Month within each file, so no sort comes before it.
    """
    flights = read_flights_csv(spark, source)
    if years is not None:
        flights = flights.where(F.col("Year").isin(*years))
    write_bucketed(flights, table, path, replace=replace)
