"""The SQL each query is checked against, over the given tables.

Written from the meaning of the questions, not from the Spark plans: the airports, for one,
are an outer join of departures with arrivals here.
"""

# All line items find their order, customer and supplier, whose keys are unique.
_FLIGHTS = """
flights AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year",
         CAST(month(l_shipdate) AS INTEGER) AS "Month",
         'C' || CAST(l_suppkey % 20 AS VARCHAR) AS "UniqueCarrier",
         CASE WHEN l_returnflag = 'R' AND l_tax >= 0.07 THEN NULL
              ELSE CAST(l_quantity * 2 - 60 AS INTEGER) END AS "ArrDelay",
         CASE WHEN l_returnflag = 'R' AND l_tax >= 0.07 THEN NULL
              ELSE CAST(round(l_discount * 100) * 3 - 10 AS INTEGER) END AS "DepDelay",
         CASE WHEN l_returnflag = 'R' AND l_tax >= 0.07 THEN 1 ELSE 0 END AS "Cancelled",
         'N' || CAST(s_nationkey AS VARCHAR) AS "Origin",
         'N' || CAST(c_nationkey + 1 AS VARCHAR) AS "Dest"
  FROM lineitem
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
)"""

_AIRPORTS = """
airports AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS iata, n_name AS airport
  FROM nation
)"""

_CARRIER_MONTHLY = """
carrier_monthly AS (
  SELECT "Year", "Month", "UniqueCarrier",
         count(*) FILTER (WHERE "ArrDelay" + "DepDelay" > 30) AS num_delayed_flights,
         count(*) AS num_total_flights
  FROM flights GROUP BY ALL
)"""

_CARRIERS = (
    _CARRIER_MONTHLY
    + """,
carriers AS (
  SELECT "Year", "UniqueCarrier",
         avg(1 - num_delayed_flights / num_total_flights) AS punctuality
  FROM carrier_monthly GROUP BY ALL
)"""
)

_PENALTIES = """
penalties AS (
  SELECT "Year", "Month",
         count(*) FILTER (WHERE "ArrDelay" > 30 OR "Cancelled" > 0) AS num_bad_flights,
         count("ArrDelay") AS num_total_flights
  FROM flights GROUP BY ALL
)"""

_MONTHS = (
    _PENALTIES
    + """,
months AS (
  SELECT "Year", "Month", num_bad_flights / nullif(num_total_flights, 0) AS non_punctuality
  FROM penalties
)"""
)

_ROUTES = """
routes AS (
  SELECT "Origin", "Dest", "Year", count(*) AS total_flights FROM flights GROUP BY ALL
)"""

_AIRPORTS_OVERALL = """
departures AS (SELECT "Origin", "Year", count(*) AS n_out FROM flights GROUP BY ALL),
arrivals AS (SELECT "Dest", count(*) AS n_in FROM flights GROUP BY ALL),
busiest AS (
  SELECT airport, coalesce("Year", 0) AS "Year",
         coalesce(n_out, 0) + coalesce(n_in, 0) AS total_count
  FROM departures FULL JOIN arrivals ON "Origin" = "Dest" JOIN airports ON "Origin" = iata
  ORDER BY total_count DESC, airport, "Year" LIMIT 10
)"""

_AIRPORTS_YEARLY = """
departures AS (SELECT "Origin", "Year", count(*) AS n_out FROM flights GROUP BY ALL),
arrivals AS (SELECT "Dest", "Year" AS y, count(*) AS n_in FROM flights GROUP BY ALL),
busiest AS (
  SELECT airport, "Year", coalesce(n_out, 0) + coalesce(n_in, 0) AS total_count
  FROM departures FULL JOIN arrivals ON "Origin" = "Dest" AND "Year" = y
       JOIN airports ON "Origin" = iata
  QUALIFY row_number() OVER (PARTITION BY "Year" ORDER BY total_count DESC, airport) <= 10
)"""


def _paths(top: str) -> str:
    return f"""
top_routes AS (SELECT * FROM routes {top}),
paths AS (
  SELECT "Origin", o.airport AS origin_name, "Dest", d.airport AS airport, "Year", total_flights
  FROM top_routes JOIN airports o ON "Origin" = o.iata JOIN airports d ON "Dest" = d.iata
)"""


_ROUTE_ORDER = 'total_flights DESC, "Origin", "Dest"'
_PATHS_OVERALL = _paths(f'ORDER BY {_ROUTE_ORDER}, "Year" LIMIT 20')
_PATHS_YEARLY = _paths(
    f'QUALIFY row_number() OVER (PARTITION BY "Year" ORDER BY {_ROUTE_ORDER}) <= 20'
)

_CARRIER_ROWS = """
carrier_rows AS (
  SELECT "Year", "UniqueCarrier" AS name, round(coalesce(punctuality, 0) * 100, 9) AS value,
         make_date("Year", 12, 31) AS period_end
  FROM carriers
)"""

_MONTH_ROWS = """
month_rows AS (
  SELECT "Year", "Month", round(coalesce(non_punctuality, 0) * 100, 9) AS value,
         round(least(greatest(coalesce(non_punctuality, 0) * 100, 0), 30), 9) AS heat_value
  FROM months
)"""

_BARS = """
bars AS (
  SELECT airport, "Year", total_count AS value,
         CAST(row_number() OVER (PARTITION BY "Year" ORDER BY total_count DESC, airport)
              AS INTEGER) AS rank
  FROM busiest
)"""

_PROFILE = """
SELECT "Year", "Month", "UniqueCarrier", count(*) AS n_flights, count("ArrDelay") AS n_arrived,
       CAST(sum("ArrDelay") AS BIGINT) AS arr_minutes,
       CAST(sum("DepDelay") AS BIGINT) AS dep_minutes,
       CAST(sum("Cancelled") AS BIGINT) AS n_cancelled,
       min("Origin") AS first_origin, max("Dest") AS last_dest
FROM flights"""


def _sql(select: str, *parts: str) -> str:
    return "WITH " + ",".join((_FLIGHTS, *parts)) + "\n" + select.strip()


_CARRIER_SELECT = """
SELECT "Year", "UniqueCarrier", round(punctuality, 9) AS punctuality FROM carriers"""
_MONTH_SELECT = """
SELECT "Year", "Month", round(non_punctuality, 9) AS non_punctuality FROM months"""
_COUNT_SELECT = 'SELECT "Month", "Year", count(*) AS n_flights FROM flights GROUP BY ALL'

# Years arrive in order, one batch each.
_BATCH = 'CAST(dense_rank() OVER (ORDER BY "Year") - 1 AS BIGINT) AS batch_id'
_LAST = """
last_delivery AS (
  SELECT max("Year") AS last_year, count(DISTINCT "Year") - 1 AS batch_id FROM flights
)"""

# All answers in one shape; a question's batches are the years.
_ALL_PARTS = (_CARRIERS, _MONTHS, _ROUTES, _AIRPORTS, _AIRPORTS_YEARLY, _PATHS_YEARLY)
_SHAPES = """
SELECT 'carrier_punctuality' AS question, "Year", "UniqueCarrier" AS name, CAST(NULL AS VARCHAR) AS other,
       round(punctuality, 9) AS value{batch} FROM carriers
UNION ALL
SELECT 'worst_months', "Year", CAST("Month" AS VARCHAR), NULL, round(non_punctuality, 9){batch} FROM months
UNION ALL
SELECT 'busiest_airports', "Year", airport, NULL, CAST(total_count AS DOUBLE){batch} FROM busiest
UNION ALL
SELECT 'busy_paths', "Year", "Origin", "Dest", CAST(total_flights AS DOUBLE){batch} FROM paths"""

_carrier_cells = ", ".join(
    f"max(value) FILTER (WHERE name = 'C{i}') AS \"C{i}\"" for i in range(20)
) + ", max(value) FILTER (WHERE name IS NULL) AS unknown"
_month_cells = ", ".join(
    f'max(value) FILTER (WHERE "Month" = {m}) AS m{m:02d}' for m in range(13)
)

ORACLES: dict[str, str] = {
    "delay_flags": _sql(
        """
        SELECT "ArrDelay" + "DepDelay" AS total_delay,
               CASE WHEN "ArrDelay" + "DepDelay" > 30 THEN 1 ELSE 0 END AS is_delayed,
               CASE WHEN "ArrDelay" > 30 OR "Cancelled" > 0 THEN 1 ELSE 0 END AS penalty,
               count(*) AS n_flights
        FROM flights GROUP BY ALL"""
    ),
    "carrier_monthly": _sql("SELECT * FROM carrier_monthly", _CARRIER_MONTHLY),
    "monthly_penalties": _sql("SELECT * FROM penalties", _PENALTIES),
    "route_counts": _sql("SELECT * FROM routes", _ROUTES),
    "carrier_punctuality": _sql(_CARRIER_SELECT, _CARRIERS),
    "worst_months": _sql(_MONTH_SELECT, _MONTHS),
    "busiest_airports": _sql("SELECT * FROM busiest", _AIRPORTS, _AIRPORTS_OVERALL),
    "busiest_airports_per_year": _sql("SELECT * FROM busiest", _AIRPORTS, _AIRPORTS_YEARLY),
    "busy_paths": _sql("SELECT * FROM paths", _AIRPORTS, _ROUTES, _PATHS_OVERALL),
    "busy_paths_per_year": _sql("SELECT * FROM paths", _AIRPORTS, _ROUTES, _PATHS_YEARLY),
    "month_year_counts": _sql(_COUNT_SELECT),
    "month_year_counts_sql": _sql(_COUNT_SELECT),
    "carrier_view": _sql("SELECT * FROM carrier_rows", _CARRIERS, _CARRIER_ROWS),
    "carrier_matrix": _sql(
        f'SELECT "Year", {_carrier_cells} FROM carrier_rows GROUP BY "Year"',
        _CARRIERS,
        _CARRIER_ROWS,
    ),
    "months_view": _sql("SELECT * FROM month_rows", _MONTHS, _MONTH_ROWS),
    "months_matrix": _sql(
        f'SELECT "Year", {_month_cells} FROM month_rows GROUP BY "Year"', _MONTHS, _MONTH_ROWS
    ),
    "airports_view": _sql("SELECT * FROM bars", _AIRPORTS, _AIRPORTS_YEARLY, _BARS),
    "airports_summary": _sql(
        'SELECT "Year", count(*) FILTER (WHERE value > 0) AS n_bars FROM bars GROUP BY "Year"',
        _AIRPORTS,
        _AIRPORTS_YEARLY,
        _BARS,
    ),
    "paths_view": _sql(
        """
        SELECT "Origin", origin_name AS "Origin Name", "Dest" AS "Destination",
               airport AS "Destination Name", "Year", total_flights AS "Total Flights"
        FROM paths""",
        _AIRPORTS,
        _ROUTES,
        _PATHS_YEARLY,
    ),
    "records_json": _sql(
        """
        SELECT CAST(to_json({'airport': airport, 'Year': "Year", 'value': value, 'rank': rank})
                    AS VARCHAR) AS json
        FROM bars""",
        _AIRPORTS,
        _AIRPORTS_YEARLY,
        _BARS,
    ),
    "flights_for_year": _sql('SELECT * FROM flights WHERE "Year" = 1998'),
    "csv_roundtrip": _sql(_PROFILE + " GROUP BY ALL"),
    "bucketed_roundtrip": _sql(_PROFILE + " GROUP BY ALL"),
    "ingest_years": _sql(_PROFILE + ' WHERE "Year" IN (1998, 2000) GROUP BY ALL'),
    "table_by_name": _sql(_PROFILE + ' WHERE "Year" IN (1998, 2000) GROUP BY ALL'),
    "airports_csv": _sql("SELECT iata, airport FROM airports", _AIRPORTS),
    "stream_month_year_counts_sql": _sql(_COUNT_SELECT),
    "stream_carrier_punctuality": _sql(_CARRIER_SELECT, _CARRIERS),
    "stream_worst_months": _sql(_MONTH_SELECT, _MONTHS),
    "stream_busiest_airports": _sql("SELECT * FROM busiest", _AIRPORTS, _AIRPORTS_YEARLY),
    "stream_busy_paths": _sql("SELECT * FROM paths", _AIRPORTS, _ROUTES, _PATHS_YEARLY),
    "stream_month_year_counts": _sql(_COUNT_SELECT),
    "stream_all_batches": _sql(
        _MONTH_SELECT.replace(" FROM", f", {_BATCH} FROM"), _MONTHS
    ),
    "stream_all_batches_carriers": _sql(
        _CARRIER_SELECT.replace(" FROM", f", {_BATCH} FROM"), _CARRIERS
    ),
    "table_month": _sql(_PROFILE + ' WHERE "Month" IN (2, 7) GROUP BY ALL'),
    "csv_quarantine": _sql(
        """
        SELECT "Year", CASE WHEN "ArrDelay" = 40 THEN 'ArrDelay' WHEN "DepDelay" = 20 THEN 'Cancelled' ELSE 'none' END AS reason,
               count(*) AS n_records
        FROM flights GROUP BY ALL"""
    ),
    "stream_contents_once": _sql(_COUNT_SELECT),
    "stream_until_stopped": _sql(_COUNT_SELECT),
    "stream_shown_rows": _sql(_COUNT_SELECT + ' ORDER BY "Year", "Month" LIMIT 10').replace(
        "AS n_flights", "AS n_flights, CAST(0 AS BIGINT) AS batch_id"
    ),
    "stream_skipping_empty": _sql(_MONTH_SELECT.replace(" FROM", ", CAST(1 AS BIGINT) AS batch_id FROM"), _MONTHS),
    "stream_batches_since": _sql(
        "SELECT * FROM (" + _MONTH_SELECT.replace(" FROM", f", {_BATCH} FROM") + ") WHERE batch_id > 1", _MONTHS
    ),
    # the newest year is taken first
    "stream_unread_batches": _sql(
        _MONTH_SELECT.replace(
            " FROM", f', {_BATCH}, CAST(dense_rank() OVER (ORDER BY "Year" DESC) - 1 AS BIGINT) AS turn FROM'
        ),
        _MONTHS,
    ),
    "stream_all_questions": _sql(_SHAPES.format(batch=f", {_BATCH}"), *_ALL_PARTS),
    "stream_all_questions_running": _sql(_SHAPES.format(batch=""), *_ALL_PARTS),
    "carrier_ranking": _sql(
        """
        SELECT rank() OVER (ORDER BY punctuality DESC NULLS LAST) AS rank, *
        FROM (SELECT "UniqueCarrier", round(avg(1 - num_delayed_flights / num_total_flights), 9) AS punctuality,
                     CAST(sum(num_total_flights) AS BIGINT) AS n_flights
              FROM carrier_monthly GROUP BY "UniqueCarrier")""",
        _CARRIER_MONTHLY,
    ),
    "month_ranking": _sql(
        """
        SELECT rank() OVER (ORDER BY non_punctuality DESC NULLS LAST) AS rank, *
        FROM (SELECT "Year", "Month", round(non_punctuality, 9) AS non_punctuality FROM months)""",
        _MONTHS,
    ),
    "stream_latest_batch": _sql(
        'SELECT busiest.*, batch_id FROM busiest JOIN last_delivery ON "Year" = last_year',
        _AIRPORTS,
        _AIRPORTS_YEARLY,
        _LAST,
    ),
    "stream_latest_batch_paths": _sql(
        'SELECT paths.*, batch_id FROM paths JOIN last_delivery ON "Year" = last_year',
        _AIRPORTS,
        _ROUTES,
        _PATHS_YEARLY,
        _LAST,
    ),
}
