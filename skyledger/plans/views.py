"""Results in the shape a dashboard shows: percentages, ranks, display names, JSON records."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: shares above this percentage get the same colour in the heat map.
HEAT_LIMIT = 30.0


def _whole(name: str) -> Column:
    """A key column as an integer, with a missing one shown as 0."""
    return F.coalesce(F.col(name).cast("int"), F.lit(0)).alias(name)


def _percent(name: str) -> Column:
    return (F.coalesce(F.col(name), F.lit(0.0)) * 100.0).alias("value")


def carrier_view(punctuality: DataFrame) -> DataFrame:
    """``Year, name, value, period_end``: percent on time, dated at the end of the year."""
    return punctuality.select(
        _whole("Year"), F.col("UniqueCarrier").alias("name"), _percent("punctuality")
    ).withColumn("period_end", F.make_date("Year", F.lit(12), F.lit(31)))


def carrier_matrix(view: DataFrame, carriers: Sequence[str]) -> DataFrame:
    """One line per year and one column per carrier, the missing carrier's being ``unknown``.

    Naming the carriers saves a pass that would look for them. Every series is kept: a carrier
    outside the list stops the query; :func:`carrier_view` itself is the form that needs no list.
    """
    if "unknown" in carriers:
        raise ValueError("the column unknown is that of the missing carrier")
    outside = F.raise_error(F.concat(F.lit("carrier outside the list: "), F.col("name")))
    named = F.when(F.col("name").isNull(), "unknown").when(F.col("name").isin(*carriers), F.col("name"))
    series = view.withColumn("name", named.otherwise(outside.cast("string")))
    return series.groupBy("Year").pivot("name", [*carriers, "unknown"]).agg(F.max("value"))


def months_view(months: DataFrame) -> DataFrame:
    """``Year, Month, value, heat_value``: percent bad, latest month of the year first."""
    return (
        months.select(_whole("Year"), _whole("Month"), _percent("non_punctuality"))
        .withColumn("heat_value", F.least(F.greatest("value", F.lit(0.0)), F.lit(HEAT_LIMIT)))
        .orderBy(F.desc("Month"))
    )


def months_matrix(view: DataFrame) -> DataFrame:
    """The heat map: one line per year and one column per month; ``m00`` is the unknown month."""
    named = view.withColumn("month_name", F.format_string("m%02d", "Month"))
    return (
        named.groupBy("Year")
        .pivot("month_name", [f"m{month:02d}" for month in range(13)])
        .agg(F.max("value"))
    )


def airports_view(totals: DataFrame) -> DataFrame:
    """``airport, Year, value, rank``: bars of each year, longest first."""
    by_length = Window.partitionBy("Year").orderBy(F.desc("value"), F.asc("airport"))
    return totals.select(
        "airport", _whole("Year"), F.coalesce("total_count", F.lit(0)).alias("value")
    ).withColumn("rank", F.row_number().over(by_length))


def airports_summary(view: DataFrame) -> DataFrame:
    """``Year, n_bars``: how many bars of each year have any length."""
    return view.groupBy("Year").agg(F.count_if(F.col("value") > 0).alias("n_bars"))


def paths_view(paths: DataFrame) -> DataFrame:
    """The paths under their display names."""
    return paths.withColumn("Year", F.col("Year").cast("int")).withColumnsRenamed(
        {
            "origin_name": "Origin Name",
            "Dest": "Destination",
            "airport": "Destination Name",
            "total_flights": "Total Flights",
        }
    )


def to_records_json(frame: DataFrame) -> DataFrame:
    """``json``: one object per row, with nulls written out."""
    return frame.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json")
    )
