"""The hand-made flights of ``FIXTURES.md`` section 2, and their airports."""

from skyledger.schema import AIRPORTS

COLUMNS = (
    "Year int, Month int, UniqueCarrier string, ArrDelay int, DepDelay int, Cancelled int, "
    "Origin string, Dest string"
)
FLIGHTS = [
    (2000, 1, "AA", 40, 0, 0, "JFK", "LAX"),
    (2000, 1, "AA", 20, 20, 0, "JFK", "LAX"),
    (2000, 1, "AA", 5, 0, 0, "LAX", "JFK"),
    (2000, 2, "AA", None, None, 1, "JFK", "LAX"),
    (2000, 2, "BB", 31, -10, 0, "LAX", "SFO"),
    (2000, 2, "BB", None, 12, 0, "SFO", "JFK"),
    (2000, 3, "BB", None, None, 1, "JFK", "ZZZ"),
    (2001, 1, "AA", 30, 1, 0, "JFK", "LAX"),
    (2001, 1, None, 10, None, 0, "SFO", "JFK"),
    (2001, 1, None, 50, 50, 0, "SFO", "JFK"),
    (2001, 1, "BB", 15, 15, 0, "QQQ", "JFK"),
    (2001, 2, "BB", 0, 0, 0, "LAX", "NUL"),
]
JFK, LAX, SFO = "John F Kennedy Intl", "Los Angeles International", "San Francisco International"
AIRPORT_ROWS = [("JFK", JFK), ("LAX", LAX), ("SFO", SFO), ("NUL", "Arrivals Only")]


def flights(spark, rows=FLIGHTS):
    return spark.createDataFrame(rows, COLUMNS)


def airports(spark):
    return spark.createDataFrame(AIRPORT_ROWS, AIRPORTS)


def rows(df, *columns):
    """Rows as a set of plain tuples, doubles to nine places."""
    out = [
        tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        for row in df.select(*(columns or df.columns)).collect()
    ]
    assert len(out) == len(set(out))
    return set(out)
