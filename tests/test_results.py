"""Commits, keyed tables, read cursors, the fan-out of questions, and ranks over whole frames."""

import random
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import hand
import pytest
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger import plans, sources, streaming
from skyledger.functions import ranked
from skyledger.plans import QUESTIONS
from skyledger.schema import as_flights
from skyledger.streaming import commits, results
from skyledger.streaming.commits import Commits


@pytest.fixture(scope="module")
def flights(spark):
    return as_flights(hand.flights(spark)).cache()


@pytest.fixture(scope="module")
def by_year(flights, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("by_year") / "data")
    sources.write_per_year(flights, path)
    return path + "/*/"


def numbers(spark, n):
    return spark.createDataFrame([(n, f"v{n}")], "n int, v string")


def put(spark, path, ids, empty=()):
    for i in ids:
        rows = numbers(spark, i)
        streaming.results_sink(path, lambda b: b)(rows.limit(0) if i in empty else rows, i)


# -- commits -------------------------------------------------------------------------------------


def test_half_a_batch_is_never_read(spark, tmp_path, monkeypatch):
    """A reader between the writing and the commit, and after a killed attempt, sees the batches before."""
    path, seen = str(tmp_path / "r"), []
    put(spark, path, [0])
    publish = Commits.publish

    def looked_at(self, batch_id, entry):
        seen.append(hand.rows(streaming.all_batches(spark, path)))
        return publish(self, batch_id, entry)

    def killed(self, batch_id, entry):
        raise KeyboardInterrupt

    monkeypatch.setattr(Commits, "publish", looked_at)
    put(spark, path, [1])
    assert seen == [{(0, "v0", 0)}]
    monkeypatch.setattr(Commits, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        put(spark, path, [2])
    before = {(0, "v0", 0), (1, "v1", 1)}
    assert hand.rows(streaming.all_batches(spark, path)) == before
    assert hand.rows(streaming.latest_batch(spark, path)) == {(1, "v1", 1)}
    monkeypatch.setattr(Commits, "publish", publish)
    put(spark, path, [2])
    assert hand.rows(streaming.all_batches(spark, path)) == before | {(2, "v2", 2)}
    assert len(streaming.folder_names(spark, f"{path}/data/batch_id=2")) == 2
    assert streaming.drop_lost_attempts(spark, path) == 1 and streaming.drop_lost_attempts(spark, path) == 0
    assert hand.rows(streaming.all_batches(spark, path)) == before | {(2, "v2", 2)}


def test_a_commit_is_made_once(spark, tmp_path):
    """Attempts that race for a batch: one commit, whole, whichever it is."""
    log = Commits(spark, str(tmp_path / "r"))
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: log.publish(3, {"folder": f"f{i}" * 1000, "rows": i}), range(8)))
    assert sum(made) >= 1 and log.ids() == [3]
    assert log.entry(3)["folder"] == f"f{log.entry(3)['rows']}" * 1000
    assert not log.publish(3, {"folder": "late", "rows": 1})
    assert not [p for p in Path(log.log).iterdir() if p.name.endswith(".json") and p.name.startswith(".") and "crc" not in p.name]


def test_long_histories_open_few_files(spark, tmp_path, monkeypatch):
    log = Commits(spark, str(tmp_path / "r"))
    for i in range(150):
        log.publish(i, {"folder": f"f{i}", "rows": i % 3})
    opened = []
    read = commits.read_text
    monkeypatch.setattr(commits, "read_text", lambda spark, path: opened.append(path) or read(spark, path))
    assert list(log.entries()) == list(range(150)) and len(opened) <= commits._EVERY
    opened.clear()
    assert {k: v["rows"] for k, v in log.entries(since=146).items()} == {147: 0, 148: 1, 149: 2} and len(opened) == 3
    assert list(log.entries(since=9, until=12)) == [10, 11, 12]


def test_results_are_typed_before_the_first_row(spark, tmp_path):
    path = str(tmp_path / "r")
    put(spark, path, [0], empty=[0])
    for rows in (streaming.all_batches(spark, path), streaming.latest_batch(spark, path), streaming.batches_since(spark, path, 5)):
        assert rows.collect() == [] and dict(rows.dtypes) == {"n": "int", "v": "string", "batch_id": "bigint"}
    with pytest.raises(ValueError, match="not struct"):
        streaming.results_sink(path, lambda b: b.select("n"))(numbers(spark, 1), 1)


def test_a_range_of_batches(spark, tmp_path):
    path = str(tmp_path / "r")
    put(spark, path, range(5), empty=[3])
    ids = lambda *a: sorted(r.batch_id for r in streaming.batches_since(spark, path, *a).collect())
    assert ids() == [0, 1, 2, 4] and ids(0) == [1, 2, 4] and ids(0, 2) == [1, 2] and ids(4) == []
    read = streaming.batches_since(spark, path, 1, 2).inputFiles()
    assert all("batch_id=2/" in f for f in read)
    assert hand.rows(streaming.latest_batch(spark, path)) == {(4, "v4", 4)}


def test_the_latest_batch_is_found_without_a_job(spark, tmp_path):
    path = str(tmp_path / "r")
    put(spark, path, range(6), empty=range(1, 6))
    spark.sparkContext.setJobGroup("looking", "")
    try:
        rows = streaming.latest_batch(spark, path)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("looking")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert hand.rows(rows) == {(0, "v0", 0)}


# -- keyed tables --------------------------------------------------------------------------------


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, j int, n long")


@pytest.mark.parametrize("add", [False, True])
def test_keyed_table_equals_a_dictionary(spark, tmp_path, add):
    path, rnd, want = str(tmp_path / "t"), random.Random(2), {}
    for batch_id in range(12):
        keys = {(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 5)) for _ in range(6)} if batch_id != 5 else set()
        rows = [(k, j, rnd.randint(1, 9)) for k, j in keys]
        for again in range(2):  # run again after its commit
            done = streaming.merge_rows(changes(spark, rows), path, ["k", "j"], batch_id, add, buckets=4)
            assert done == (again == 0)
        for k, j, n in rows:
            want[k, j] = want.get((k, j), 0) + n if add else n
        assert hand.rows(streaming.keyed_rows(spark, path)) == {(k, j, n) for (k, j), n in want.items()}


def test_reading_a_keyed_table_does_not_grow_with_its_batches(spark, tmp_path):
    path, cost = str(tmp_path / "t"), []
    for batch_id in range(16):
        streaming.merge_rows(changes(spark, [("a", j, batch_id) for j in range(40)]), path, ["k", "j"], batch_id, buckets=4)
        table = streaming.keyed_rows(spark, path)
        cost.append((len(table.inputFiles()), table.count()))
    assert len(set(cost)) == 1 and cost[0][1] == 40 and cost[0][0] <= 8
    # on disk are the folders of the last two commits
    assert len(list(Path(path).glob("data/*/rows/_bucket=*"))) <= 8


def test_a_killed_merge_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    streaming.merge_rows(changes(spark, [("a", 1, 5)]), path, ["k", "j"], 0, True)
    with monkeypatch.context() as patch:
        patch.setattr(Commits, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            streaming.merge_rows(changes(spark, [("a", 1, 7)]), path, ["k", "j"], 1, True)
    assert hand.rows(streaming.keyed_rows(spark, path)) == {("a", 1, 5)}
    for batch_id in (1, 2, 3):
        streaming.merge_rows(changes(spark, [("a", 1, 7)]), path, ["k", "j"], batch_id, True)
    assert hand.rows(streaming.keyed_rows(spark, path)) == {("a", 1, 26)}
    assert len(list(Path(path).glob("data/*"))) <= 2
    streaming.merge_rows(changes(spark, [("a", 1, 7)]), path, ["k", "j"], 9, True)
    with pytest.raises(ValueError, match="comes after"):
        streaming.merge_rows(changes(spark, [("a", 1, 7)]), path, ["k", "j"], 6, True)


def test_an_empty_keyed_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert streaming.keyed_rows(spark, path).collect() == []
    streaming.merge_rows(changes(spark, []), path, ["k", "j"], 0)
    assert streaming.keyed_rows(spark, path).columns == ["k", "j", "n"]


# -- unread batches ------------------------------------------------------------------------------


def take(spark, path, reader="r"):
    rows = streaming.take_unread(spark, path, reader)
    return None if rows is None else rows.first().batch_id


def test_the_newest_unread_batch_comes_first(spark, tmp_path):
    path = str(tmp_path / "r")
    assert take(spark, path) is None
    put(spark, path, range(4), empty=[2])
    assert streaming.count_unread(spark, path, "r") == 3
    assert [take(spark, path), take(spark, path)] == [3, 1]
    put(spark, path, [4, 5])
    assert [take(spark, path) for _ in range(4)] == [5, 4, 0, None]
    assert [take(spark, path, "other") for _ in range(2)] == [5, 4]
    put(spark, path, [6])
    assert [take(spark, path), take(spark, path), streaming.count_unread(spark, path, "r")] == [6, None, 0]
    with pytest.raises(ValueError, match="name of a reader"):
        take(spark, path, "../x")


def test_two_processes_under_one_name_share_the_batches(spark, tmp_path):
    path = str(tmp_path / "r")
    put(spark, path, range(12))

    def drain(_):
        got = []
        while (i := take(spark, path)) is not None:
            got.append(i)
        return got

    with ThreadPoolExecutor(3) as pool:
        taken = list(pool.map(drain, range(3)))
    assert sorted(i for got in taken for i in got) == list(range(12))


# -- all questions over one stream ---------------------------------------------------------------


@pytest.mark.parametrize("running", [False, True])
def test_all_questions_scan_each_batch_once(spark, flights, by_year, tmp_path, running):
    root, airports = str(tmp_path / "q"), hand.airports(spark)
    stream = sources.stream_flights(spark, by_year)
    query = streaming.run_all_questions(stream, root, str(tmp_path / "c"), airports, "Year", running)
    assert sorted(p.numInputRows for p in query.recentProgress if p.numInputRows) == [5, 7]
    for name, question in QUESTIONS.items():
        got = streaming.all_batches(spark, f"{root}/{name}")
        got = (got.where("batch_id = 1") if running else got).drop("batch_id")
        assert hand.rows(got) == hand.rows(question.answer(flights, airports, "Year")), name
    if running:
        history = streaming.keyed_rows(spark, f"{root}/history")
        for name, question in QUESTIONS.items():
            kept = plans.rollup_for(history, name)
            assert hand.rows(kept) == hand.rows(question.rollup(flights).select(*kept.columns))


def test_questions_of_a_batch_run_again(spark, flights, tmp_path, monkeypatch):
    """A batch killed after its first answer goes on from its roll-ups and writes what is missing."""
    root, airports = str(tmp_path / "q"), hand.airports(spark)
    sink = streaming.questions_sink(root, airports, "Year", running=True)
    commit, done = results.commit_rows, []

    def killed(log, rows, batch_id, skip_empty=False):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(log.path)
        return commit(log, rows, batch_id, skip_empty)

    monkeypatch.setattr("skyledger.streaming.runner.commit_rows", killed)
    with pytest.raises(KeyboardInterrupt):
        sink(flights, 0)
    monkeypatch.setattr("skyledger.streaming.runner.commit_rows", commit)
    gone = flights.where("raise_error('scanned again') is null")
    sink(gone, 0)
    sink(gone, 0)
    for name, question in QUESTIONS.items():
        got = streaming.all_batches(spark, f"{root}/{name}").drop("batch_id")
        assert hand.rows(got) == hand.rows(question.answer(flights, airports, "Year"))


# -- ranks ---------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_equal_a_sort(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([None, 0.5, *range(30)]) if i % 3 else 7.0, rnd.randint(0, 3)) for i in range(600)]
    rows = [(i, None if a is None else float(a), b) for i, a, b in rows]
    df = spark.createDataFrame(rows, "i int, a double, b int")
    got = {r.i: r["rank"] for r in ranked(df, ["-a", "b"], tasks=5).collect()}
    key = lambda r: (r[1] is None, -(r[1] or 0), r[2])
    order = sorted(map(key, rows))
    assert got == {r[0]: order.index(key(r)) + 1 for r in rows}
    assert ranked(df.limit(0), ["a"]).collect() == []
    with pytest.raises(ValueError, match="column b"):
        ranked(df, ["a"], name="b")


def test_ranks_see_no_single_partition(spark, flights):
    months = plans.month_ranking(ops.monthly_penalties(flights))
    carriers = plans.carrier_ranking(ops.carrier_monthly(flights))
    for df in (months, carriers):
        assert "SinglePartition" not in plan(df)
    assert hand.rows(carriers) == {(1, "BB", 1.0, 5), (2, None, 0.5, 2), (3, "AA", 0.444444444, 5)}
    assert hand.rows(months) == {
        (1, 2000, 2, 2.0), (2, 2000, 1, 0.333333333), (3, 2001, 1, 0.25), (4, 2001, 2, 0.0), (5, 2000, 3, None),
    }
