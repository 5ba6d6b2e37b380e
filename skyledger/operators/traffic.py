"""Which airports and paths were busiest, and how many flights each month had.

``per=None`` treats the frame as one batch: arrivals are counted over all its years and the
top-k is overall. ``per="Year"`` treats each year as its own batch.

No join carries a broadcast hint. The planner broadcasts the airports only if their size is
under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise; the other side is a
roll-up, never the flights.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import top_k

_SCOPES = (None, "Year")


def _check_scope(per: str | None) -> None:
    if per not in _SCOPES:
        raise ValueError(f"per must be one of {_SCOPES}, not {per!r}")


def route_counts(flights: DataFrame) -> DataFrame:
    """Roll-up: flights of each route in each year."""
    return flights.groupBy("Origin", "Dest", "Year").agg(F.count("*").alias("total_flights"))


def airport_totals(routes: DataFrame, per: str | None = None) -> DataFrame:
    """``Origin, Year, total_count``: departures plus arrivals, for airports with departures.

    A route adds to the airports at both its ends, so the routes are read once and each row is
    turned into a departure row and an arrival row.
    """
    _check_scope(per)
    yearly = (
        routes.selectExpr(
            "Year",
            "stack(2, Origin, total_flights, 0L, Dest, 0L, total_flights)"
            " AS (code, departures, arrivals)",
        )
        .where("code IS NOT NULL")
        .groupBy("code", "Year")
        .agg(F.sum("departures").alias("source_count"), F.sum("arrivals").alias("dest_count"))
    )
    if per is None:
        over_years = F.sum("dest_count").over(Window.partitionBy("code"))
        yearly = yearly.withColumn("dest_count", over_years)
    return yearly.where("source_count > 0").selectExpr(
        "code AS Origin",
        "coalesce(Year, 0) AS Year",
        "source_count + dest_count AS total_count",
    )


def _named(frame: DataFrame, airports: DataFrame, code: str, name: str) -> DataFrame:
    """``frame`` with the display name of the airport whose code is in column ``code``; rows with
    an unknown code go."""
    look_up = airports.select(F.col("iata").alias("_code"), F.col("airport").alias(name))
    return frame.join(look_up, F.col(code) == F.col("_code")).drop("_code")


def finish_airports(
    routes: DataFrame, airports: DataFrame, k: int = 10, per: str | None = None
) -> DataFrame:
    """Name the airports, then keep the busiest ``k``; unknown codes never take a place."""
    named = _named(airport_totals(routes, per), airports, "Origin", "airport")
    named = named.select("airport", "Year", "total_count")
    return top_k(named, k, [F.desc("total_count"), F.asc("airport"), F.asc("Year")], per)


def busiest_airports(
    flights: DataFrame, airports: DataFrame, k: int = 10, per: str | None = None
) -> DataFrame:
    """``airport, Year, total_count``."""
    return finish_airports(route_counts(flights), airports, k, per)


def finish_paths(
    routes: DataFrame, airports: DataFrame, k: int = 20, per: str | None = None
) -> DataFrame:
    """Keep the busiest ``k`` routes, then name both ends; an unknown code leaves a gap."""
    _check_scope(per)
    busiest = top_k(
        routes, k, [F.desc("total_flights"), F.asc("Origin"), F.asc("Dest"), F.asc("Year")], per
    )
    named = _named(_named(busiest, airports, "Origin", "origin_name"), airports, "Dest", "airport")
    columns = ["Origin", "origin_name", "Dest", "airport", "Year", "total_flights"]
    return named.select(*columns).orderBy(F.desc("total_flights"), "Year", "Origin", "Dest")


def busy_paths(
    flights: DataFrame, airports: DataFrame, k: int = 20, per: str | None = None
) -> DataFrame:
    """``Origin, origin_name, Dest, airport, Year, total_flights``."""
    return finish_paths(route_counts(flights), airports, k, per)


def month_year_counts(flights: DataFrame) -> DataFrame:
    """``Month, Year, n_flights``; on a stream, running totals."""
    return flights.groupBy("Month", "Year").agg(F.count("*").alias("n_flights"))


def month_year_counts_sql(flights: DataFrame, view: str | None = None) -> DataFrame:
    """The same count in SQL, over the frame itself or over a temporary view of the given name,
    which is replaced."""
    text = "SELECT Month, Year, count(*) AS n_flights FROM {source} GROUP BY Month, Year"
    if view is None:
        return flights.sparkSession.sql(text, source=flights)
    flights.createOrReplaceTempView(view)
    return flights.sparkSession.sql(text.format(source="`" + view.replace("`", "``") + "`"))
