"""What the plans must look like for large inputs."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger.storage import scratch_dir
from skyledger.workload import tables
from skyledger.workload.queries import QUERIES

SF = "/root/testdata/sf0.01"
STORING = ("stream_", "csv_", "bucketed_", "ingest_", "table_", "airports_csv", "carrier_ranking", "month_ranking")
BATCH = [name for name in QUERIES if not name.startswith(STORING)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [
        (table, set(re.findall(r"(\w+)#\d+", columns)))
        for columns, table in re.findall(r"FileScan parquet \[(.*?)\].*?/(\w+)\.parquet", text)
    ]


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in text


@pytest.mark.parametrize("name", BATCH)
def test_line_items_are_read_once(spark, name):
    read = [table for table, _ in scans(plan(QUERIES[name](spark, SF)))]
    assert read.count("lineitem") == 1


def test_only_needed_columns_are_read(spark):
    want = {
        "month_year_counts": {"l_shipdate"},
        "worst_months": {"l_shipdate", "l_quantity", "l_returnflag", "l_tax"},
        "busy_paths": {"l_shipdate", "l_suppkey", "l_orderkey"},
    }
    for name, columns in want.items():
        found = dict(scans(plan(QUERIES[name](spark, SF))))
        assert found["lineitem"] == columns
        if name != "busy_paths":
            assert set(found) == {"lineitem"}


@pytest.mark.parametrize("name", ["carrier_monthly", "monthly_penalties", "route_counts"])
def test_rollups_combine_before_the_exchange(spark, name):
    text = plan(QUERIES[name](spark, SF))
    final, exchange, partial = (
        text.index("HashAggregate"), text.index("Exchange hashpartitioning"), text.rindex("HashAggregate"),
    )
    assert final < exchange < partial and "partial_" in text[partial:]


@pytest.mark.parametrize("name", ["busiest_airports_per_year", "busy_paths_per_year"])
def test_yearly_top_k_is_cut_before_the_exchange(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("WindowGroupLimit") == 2
    assert re.search(r"row_number\(\), \d+, Partial", text)


@pytest.mark.parametrize("name", ["busiest_airports", "busy_paths"])
def test_overall_top_k_is_fused(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_airports_are_broadcast_only_under_the_planner_threshold(spark, no_broadcast):
    schema = "Origin string, Dest string, Year int, total_flights bigint"
    routes = spark.createDataFrame([("N1", "N2", 1999, 5)], schema)
    airports = tables.airports(spark, SF)
    assert "BroadcastHashJoin" not in plan(ops.finish_airports(routes, airports))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert "BroadcastHashJoin" in plan(ops.finish_airports(routes, airports))


def test_a_hot_order_is_split(spark, tmp_path, no_broadcast):
    """With a third of the line items on one order, the join splits that order's partition."""
    source = spark.read.parquet(f"{SF}/lineitem.parquet")
    six = F.explode(F.sequence(F.lit(1), F.lit(6)))
    many = source.withColumn("copy", six).drop("copy").repartition(16)
    is_hot = F.col("l_linenumber") % 3 == 0
    hot = many.withColumn("l_orderkey", F.when(is_hot, 1).otherwise(F.col("l_orderkey")))
    hot.write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("orders", "customer", "supplier", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    }
    want = {tuple(r) for r in QUERIES["route_counts"](spark, str(tmp_path)).collect()}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        routes = QUERIES["route_counts"](spark, str(tmp_path))
        assert {tuple(r) for r in routes.collect()} == want
        assert "SortMergeJoin(skew=true)" in plan(routes)
        assert sum(r[3] for r in want) == 360_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_scratch_folder_of_a_session_that_names_none():
    """The warehouse stands in: it is shared, unlike a machine's own temporary folder."""
    settings = {"spark.sql.warehouse.dir": "store:/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)))
    assert scratch_dir(session, "x").startswith("store:/warehouse/")
