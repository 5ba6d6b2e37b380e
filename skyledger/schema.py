"""Fixed schemas of the flight records and of the airports dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

_INT, _STR = IntegerType(), StringType()

# The columns of the public on-time performance records, in file order.
# Tail numbers are alphanumeric, so TailNum is text; a missing value is written as NA.
FLIGHTS = StructType(
    [
        StructField(name, kind)
        for name, kind in [
            ("Year", _INT),
            ("Month", _INT),
            ("DayofMonth", _INT),
            ("DayofWeek", _INT),
            ("DepTime", _INT),
            ("CRSDepTime", _INT),
            ("ArrTime", _INT),
            ("CRSArrTime", _INT),
            ("UniqueCarrier", _STR),
            ("FlightNum", _INT),
            ("TailNum", _STR),
            ("ActualElapsedTime", _INT),
            ("CRSElapsedTime", _INT),
            ("AirTime", _INT),
            ("ArrDelay", _INT),
            ("DepDelay", _INT),
            ("Origin", _STR),
            ("Dest", _STR),
            ("Distance", _INT),
            ("TaxiIn", _INT),
            ("TaxiOut", _INT),
            ("Cancelled", _INT),
            ("CancellationCode", _STR),
            ("Diverted", _INT),
            ("CarrierDelay", _INT),
            ("WeatherDelay", _INT),
            ("NASDelay", _INT),
            ("SecurityDelay", _INT),
            ("LateAircraftDelay", _INT),
        ]
    ]
)
MISSING = "NA"

AIRPORTS = StructType([StructField("iata", _STR), StructField("airport", _STR)])


def as_flights(frame: DataFrame) -> DataFrame:
    """Give a frame the full flight layout: known columns cast, absent ones null."""
    present = {name.lower() for name in frame.columns}
    return frame.select(
        *(
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in FLIGHTS.fields
        )
    )
