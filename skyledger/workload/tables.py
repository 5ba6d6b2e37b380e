"""Flights and airports derived from the given tables (see ``FIXTURES.md``)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("Year", "Month", "UniqueCarrier", "ArrDelay", "DepDelay", "Cancelled", "Origin", "Dest")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(nation: str) -> Column:
    return F.concat(F.lit("N"), F.col(nation).cast("string"))


def flights(spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """One flight per line item. Joins only what the asked columns need.

    The destination is looked up over orders already joined with customers, so the line items
    are shuffled once for it. All lookups are left joins from the many side: adaptive execution
    splits the partition of an order, customer or supplier that holds most of the rows.
    """
    lines = _table(spark, sf_dir, "lineitem")
    if "Origin" in columns:
        suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "Dest" in columns:
        customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        buyers = (
            _table(spark, sf_dir, "orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "c_nationkey")
        )
        lines = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.07)
    definitions = {
        "Year": F.year("l_shipdate"),
        "Month": F.month("l_shipdate"),
        "UniqueCarrier": F.concat(F.lit("C"), (F.col("l_suppkey") % 20).cast("string")),
        "ArrDelay": F.when(cancelled, None).otherwise((F.col("l_quantity") * 2 - 60).cast("int")),
        "DepDelay": F.when(cancelled, None).otherwise(
            (F.round(F.col("l_discount") * 100) * 3 - 10).cast("int")
        ),
        "Cancelled": F.when(cancelled, 1).otherwise(0),
        "Origin": _code("s_nationkey"),
        # one code without a name, that only ever arrives; the first name only ever departs
        "Dest": F.concat(F.lit("N"), (F.col("c_nationkey") + 1).cast("string")),
    }
    return lines.select(*(definitions[name].alias(name) for name in columns))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per nation."""
    return _table(spark, sf_dir, "nation").select(
        _code("n_nationkey").alias("iata"), F.col("n_name").alias("airport")
    )
