import random

import duckdb
import hand
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger.functions import with_is_delayed, with_penalty
from skyledger.plans import QUESTIONS

THIRD = round(1 / 3, 9)
TWO_THIRDS = round(2 / 3, 9)


@pytest.fixture(scope="module")
def flights(spark):
    return hand.flights(spark).cache()


@pytest.fixture(scope="module")
def airports(spark):
    return hand.airports(spark)


def test_flags_at_the_threshold(spark):
    frame = hand.flights(
        spark,
        [
            (2000, 1, "A", 30, 0, 0, "X", "Y"),
            (2000, 1, "A", 30, 1, 0, "X", "Y"),
            (2000, 1, "A", 31, -31, 0, "X", "Y"),
            (2000, 1, "A", None, 99, 0, "X", "Y"),
            (2000, 1, "A", None, None, 1, "X", "Y"),
            (2000, 1, "A", 10, 10, 1, "X", "Y"),
            (2000, 1, "A", None, None, None, "X", "Y"),
        ],
    ).coalesce(1)
    got = with_penalty(with_is_delayed(frame)).collect()
    assert [r.total_delay for r in got] == [30, 31, 0, None, None, 20, None]
    assert [r.is_delayed for r in got] == [0, 1, 0, 0, 0, 0, 0]
    assert [r.penalty for r in got] == [0, 0, 1, 0, 1, 1, 0]
    stricter = with_penalty(with_is_delayed(frame, 19), 9).collect()
    assert [r.is_delayed for r in stricter] == [1, 1, 0, 0, 0, 1, 0]
    assert [r.penalty for r in stricter] == [1, 1, 1, 0, 1, 1, 0]


def test_carrier_monthly(flights):
    assert hand.rows(ops.carrier_monthly(flights)) == {
        (2000, 1, "AA", 2, 3),
        (2000, 2, "AA", 0, 1),
        (2000, 2, "BB", 0, 2),
        (2000, 3, "BB", 0, 1),
        (2001, 1, "AA", 1, 1),
        (2001, 1, None, 1, 2),
        (2001, 1, "BB", 0, 1),
        (2001, 2, "BB", 0, 1),
    }


def test_carrier_punctuality(flights):
    assert hand.rows(ops.carrier_punctuality(flights)) == {
        (2000, "AA", TWO_THIRDS),
        (2000, "BB", 1.0),
        (2001, "AA", 0.0),
        (2001, "BB", 1.0),
        (2001, None, 0.5),
    }


def test_worst_months(flights):
    assert hand.rows(ops.worst_months(flights)) == {
        (2000, 1, THIRD),
        (2000, 2, 2.0),
        (2000, 3, None),
        (2001, 1, 0.25),
        (2001, 2, 0.0),
    }


def test_busiest_airports(flights, airports):
    assert hand.rows(ops.busiest_airports(flights, airports)) == {
        (hand.JFK, 2000, 9),
        (hand.JFK, 2001, 6),
        (hand.LAX, 2000, 6),
        (hand.LAX, 2001, 5),
        (hand.SFO, 2000, 2),
        (hand.SFO, 2001, 3),
    }
    assert hand.rows(ops.busiest_airports(flights, airports, per="Year")) == {
        (hand.JFK, 2000, 6),
        (hand.JFK, 2001, 4),
        (hand.LAX, 2000, 5),
        (hand.LAX, 2001, 2),
        (hand.SFO, 2000, 2),
        (hand.SFO, 2001, 2),
    }


def test_busiest_airports_cut(flights, airports):
    top = ops.busiest_airports(flights, airports, k=2).collect()
    assert [tuple(r) for r in top] == [(hand.JFK, 2000, 9), (hand.JFK, 2001, 6)]
    # LAX and SFO tie in 2001; the name decides.
    assert hand.rows(ops.busiest_airports(flights, airports, k=2, per="Year")) == {
        (hand.JFK, 2000, 6),
        (hand.LAX, 2000, 5),
        (hand.JFK, 2001, 4),
        (hand.LAX, 2001, 2),
    }


@pytest.mark.parametrize("per", [None, "Year"])
def test_missing_year_counts_as_zero(spark, airports, per):
    frame = hand.flights(spark, [(None, 1, "AA", 0, 0, 0, "JFK", "LAX")])
    got = hand.rows(ops.busiest_airports(frame, airports, per=per))
    assert got == {(hand.JFK, 0, 1)}


def test_busy_paths(flights, airports):
    everything = [
        ("JFK", hand.JFK, "LAX", hand.LAX, 2000, 3),
        ("SFO", hand.SFO, "JFK", hand.JFK, 2001, 2),
        ("JFK", hand.JFK, "LAX", hand.LAX, 2001, 1),
        ("LAX", hand.LAX, "JFK", hand.JFK, 2000, 1),
        ("LAX", hand.LAX, "NUL", "Arrivals Only", 2001, 1),
        ("LAX", hand.LAX, "SFO", hand.SFO, 2000, 1),
        ("SFO", hand.SFO, "JFK", hand.JFK, 2000, 1),
    ]
    for per in (None, "Year"):
        assert hand.rows(ops.busy_paths(flights, airports, per=per)) == set(everything)
    assert hand.rows(ops.busy_paths(flights, airports, k=2)) == set(everything[:2])
    ordered = ops.busy_paths(flights, airports).collect()
    assert [(r.total_flights, r.Year) for r in ordered] == [
        (3, 2000), (2, 2001), (1, 2000), (1, 2000), (1, 2000), (1, 2001), (1, 2001),
    ]


def test_unknown_codes_take_a_place_among_paths_only(spark, airports):
    frame = hand.flights(
        spark,
        [(2000, 1, "AA", 0, 0, 0, "QQQ", "JFK")] * 3 + [(2000, 1, "AA", 0, 0, 0, "LAX", "JFK")],
    )
    assert hand.rows(ops.busy_paths(frame, airports, k=1)) == set()
    assert hand.rows(ops.busiest_airports(frame, airports, k=1)) == {(hand.LAX, 2000, 1)}


def test_month_year_counts(flights):
    want = {(1, 2000, 3), (2, 2000, 3), (3, 2000, 1), (1, 2001, 4), (2, 2001, 1)}
    assert hand.rows(ops.month_year_counts(flights)) == want
    assert hand.rows(ops.month_year_counts_sql(flights, "hand_flights")) == want


def test_unknown_scope(flights, airports):
    for query in (ops.busiest_airports, ops.busy_paths):
        with pytest.raises(ValueError, match="per must be"):
            query(flights, airports, per="Month")


@pytest.mark.parametrize("name", ["busiest_airports", "busy_paths"])
def test_per_year_equals_one_year_at_a_time(flights, airports, name):
    question = QUESTIONS[name]
    alone = set()
    for year in (2000, 2001):
        alone |= hand.rows(question.answer(flights.where(F.col("Year") == year), airports))
    assert hand.rows(question.answer(flights, airports, "Year")) == alone


def test_questions_read_only_their_columns(flights, airports):
    for question in QUESTIONS.values():
        narrow = flights.select(*question.columns)
        assert hand.rows(question.answer(narrow, airports, "Year")) == hand.rows(
            question.answer(flights, airports, "Year")
        )


# -- the literal forms of the questions, on random flights with nulls everywhere ------------------


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(7)

    def maybe(value, odds=0.1):
        return None if rng.random() < odds else value

    codes = ["JFK", "LAX", "SFO", "NUL", "QQQ"]
    rows = [
        (
            maybe(rng.randint(1999, 2001), 0.02),
            maybe(rng.randint(1, 12), 0.02),
            maybe(rng.choice(["AA", "BB", "CC"])),
            maybe(rng.randint(-40, 60)),
            maybe(rng.randint(-40, 60)),
            maybe(int(rng.random() < 0.1), 0.02),
            # A third of all flights share a route.
            "JFK" if i % 3 == 0 else maybe(rng.choice(codes)),
            "LAX" if i % 3 == 0 else maybe(rng.choice(codes)),
        )
        for i in range(3000)
    ]
    return hand.flights(spark, rows).repartition(5).cache()


def in_duckdb(frame, airports, sql):
    con = duckdb.connect()
    names = frame.columns
    columns = list(zip(*(tuple(r) for r in frame.collect()), strict=True))
    con.register("flights", pa.table(dict(zip(names, map(list, columns), strict=True))))
    con.register("airports", airports.toPandas())
    return {
        tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        for row in con.execute(sql).fetchall()
    }


def test_hash_joined_carriers_on_noise(spark, noisy):
    """Two aggregates matched on a hash of their keys give what the single aggregate gives."""
    with_is_delayed(noisy).createOrReplaceTempView("noisy_delays")
    literal = spark.sql("""
        WITH late AS (SELECT hash(Year, Month, UniqueCarrier) AS id, Year, UniqueCarrier,
                             sum(is_delayed) AS n
                      FROM noisy_delays GROUP BY Year, Month, UniqueCarrier),
             every AS (SELECT hash(Year, Month, UniqueCarrier) AS id, count(is_delayed) AS n
                       FROM noisy_delays GROUP BY Year, Month, UniqueCarrier)
        SELECT Year, UniqueCarrier, avg(1 - late.n / every.n) AS punctuality
        FROM late JOIN every USING (id) GROUP BY Year, UniqueCarrier""")
    assert hand.rows(ops.carrier_punctuality(noisy)) == hand.rows(literal)


def test_hash_joined_months_on_noise(spark, noisy):
    with_penalty(noisy).createOrReplaceTempView("noisy_penalties")
    literal = spark.sql("""
        WITH bad AS (SELECT hash(Year, Month) AS id, Year, Month, sum(penalty) AS n
                     FROM noisy_penalties GROUP BY Year, Month),
             known AS (SELECT hash(Year, Month) AS id, count(ArrDelay) AS n
                       FROM noisy_penalties GROUP BY Year, Month)
        SELECT Year, Month, try_divide(bad.n, known.n) AS non_punctuality
        FROM bad JOIN known USING (id)""")
    assert hand.rows(ops.worst_months(noisy)) == hand.rows(literal)


def test_outer_joined_airports_on_noise(noisy, airports):
    sql = """
        SELECT airport, coalesce(Year, 0), coalesce(n_out, 0) + coalesce(n_in, 0) AS total
        FROM (SELECT Origin, Year, count(*) AS n_out FROM flights GROUP BY ALL)
             FULL JOIN (SELECT Dest, count(*) AS n_in FROM flights GROUP BY ALL) ON Origin = Dest
             JOIN airports ON Origin = iata
        ORDER BY total DESC, airport, coalesce(Year, 0) LIMIT 10"""
    got = hand.rows(ops.busiest_airports(noisy, airports))
    assert got == in_duckdb(noisy, airports, sql) and len(got) == 10


def test_outer_joined_airports_per_year_on_noise(noisy, airports):
    sql = """
        SELECT airport, coalesce(y, 0), coalesce(n_out, 0) + coalesce(n_in, 0) AS total
        FROM (SELECT Origin, Year AS y, count(*) AS n_out FROM flights GROUP BY ALL)
             FULL JOIN (SELECT Dest, Year AS z, count(*) AS n_in FROM flights GROUP BY ALL)
             ON Origin = Dest AND y IS NOT DISTINCT FROM z
             JOIN airports ON Origin = iata
        QUALIFY row_number() OVER (PARTITION BY y ORDER BY total DESC, airport) <= 3"""
    got = hand.rows(ops.busiest_airports(noisy, airports, k=3, per="Year"))
    assert got == in_duckdb(noisy, airports, sql) and len(got) == 12


@pytest.mark.parametrize("per", [None, "Year"])
def test_paths_on_noise(noisy, airports, per):
    window = "PARTITION BY Year" if per else ""
    sql = f"""
        SELECT Origin, o.airport, Dest, d.airport, Year, total
        FROM (SELECT *, row_number() OVER ({window} ORDER BY total DESC, Origin NULLS FIRST,
                        Dest NULLS FIRST, Year NULLS FIRST) AS position
              FROM (SELECT Origin, Dest, Year, count(*) AS total FROM flights GROUP BY ALL))
             JOIN airports o ON Origin = o.iata JOIN airports d ON Dest = d.iata
        WHERE position <= 20"""
    got = hand.rows(ops.busy_paths(noisy, airports, per=per))
    assert got == in_duckdb(noisy, airports, sql) and got
