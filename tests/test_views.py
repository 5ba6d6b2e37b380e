import datetime as dt
import json

import hand
import pytest

from skyledger import operators as ops
from skyledger import plans


@pytest.fixture(scope="module")
def flights(spark):
    return hand.flights(spark).cache()


@pytest.fixture(scope="module")
def bars(spark, flights):
    return plans.airports_view(ops.busiest_airports(flights, hand.airports(spark), per="Year"))


def test_carrier_view(flights):
    def end(year):
        return dt.date(year, 12, 31)

    assert hand.rows(plans.carrier_view(ops.carrier_punctuality(flights))) == {
        (2000, "AA", round(200 / 3, 9), end(2000)),
        (2000, "BB", 100.0, end(2000)),
        (2001, "AA", 0.0, end(2001)),
        (2001, "BB", 100.0, end(2001)),
        (2001, None, 50.0, end(2001)),
    }


def test_carrier_matrix(flights):
    view = plans.carrier_view(ops.carrier_punctuality(flights))
    matrix = plans.carrier_matrix(view, ["AA", "BB", "CC"])
    assert hand.rows(matrix, "Year", "AA", "BB", "CC", "unknown") == {
        (2000, round(200 / 3, 9), 100.0, None, None),
        (2001, 0.0, 100.0, None, 50.0),
    }


def test_carrier_matrix_refuses_what_it_would_drop(flights):
    view = plans.carrier_view(ops.carrier_punctuality(flights))
    with pytest.raises(Exception, match="carrier outside the list: BB"):
        plans.carrier_matrix(view, ["AA"]).collect()


def test_months_matrix_keeps_the_unknown_month(spark):
    months = spark.createDataFrame([(2000, None, 0.5), (2000, 3, 0.25)], "Year int, Month int, non_punctuality double")
    got = plans.months_matrix(plans.months_view(months))
    assert hand.rows(got, "Year", "m00", "m03") == {(2000, 50.0, 25.0)}


def test_months_view(flights):
    view = plans.months_view(ops.worst_months(flights))
    assert hand.rows(view) == {
        (2000, 3, 0.0, 0.0),
        (2000, 2, 200.0, 30.0),
        (2001, 2, 0.0, 0.0),
        (2000, 1, round(100 / 3, 9), 30.0),
        (2001, 1, 25.0, 25.0),
    }
    assert [r.Month for r in view.collect()] == [3, 2, 2, 1, 1]
    matrix = plans.months_matrix(view)
    assert len(matrix.columns) == 14
    assert hand.rows(matrix, "Year", "m01", "m02", "m03", "m12") == {
        (2000, round(100 / 3, 9), 200.0, 0.0, None),
        (2001, 25.0, 0.0, None, None),
    }


def test_airports_view(bars):
    for year in (2000, 2001):
        ranked = {r.rank: r.airport for r in bars.collect() if r.Year == year}
        assert ranked == {1: hand.JFK, 2: hand.LAX, 3: hand.SFO}
    assert hand.rows(plans.airports_summary(bars)) == {(2000, 3), (2001, 3)}


def test_paths_view(spark, flights):
    view = plans.paths_view(ops.busy_paths(flights, hand.airports(spark), k=2))
    assert view.columns == [
        "Origin", "Origin Name", "Destination", "Destination Name", "Year", "Total Flights",
    ]
    assert ("JFK", hand.JFK, "LAX", hand.LAX, 2000, 3) in hand.rows(view)


def test_records_json_writes_nulls(flights):
    records = plans.to_records_json(ops.worst_months(flights)).collect()
    parsed = [json.loads(r.json) for r in records]
    assert {"Year": 2000, "Month": 3, "non_punctuality": None} in parsed
    assert {"Year": 2000, "Month": 2, "non_punctuality": 2.0} in parsed


def test_question_names():
    assert set(plans.QUESTIONS) == {
        "carrier_punctuality", "worst_months", "busiest_airports", "busy_paths",
    }


def test_every_question_has_its_view(spark, flights):
    for question in plans.QUESTIONS.values():
        answer = question.answer(flights, hand.airports(spark), "Year")
        assert question.view(answer).count() == answer.count()
