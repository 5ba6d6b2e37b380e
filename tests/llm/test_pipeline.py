"""Stages of the corpus pipeline on rows with null and repeated ids."""

import random

import corpus_pipeline
import duckdb
import pytest

from skyledger.llm import mixing

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], KIND).repartition(3)


def found(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_decontamination_drops_rows_not_ids(spark, frame, tmp_path):
    item = prose(1, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(None, prose(10 + i, 60)) for i in range(5)] + [(7, prose(20, 60)), (8, prose(21, 60)), (None, None), (9, "")]
    dirty = [(i, f"{prose(30 + k, 20)} {item} {prose(40 + k, 20)}") for k, i in enumerate((None, 7, 11))]
    got = corpus_pipeline.decontamination(spark, frame(clean + dirty), str(tmp_path))
    assert found(got) == sorted(clean, key=str) and got.columns == corpus_pipeline.COLUMNS


def test_near_dedup_keeps_one_row_of_each_group(spark, frame):
    a, b, c, d = (prose(50 + i, 80) for i in range(4))
    rows = [(None, a), (None, a + " more"), (None, b), (3, b), (4, c), (4, c + " more"), (4, d), (4, d), (20, c), (None, None)]
    got = found(corpus_pipeline.near_dedup(spark, frame(rows), ""))
    one = [r for r in got if r[1] and r[1].startswith(a)]
    assert len(one) == 1  # no copy stays, although all its rows lack an id
    four = [r for r in got if r[1] and r[1].startswith(c)]
    assert len(four) == 1 and four[0][0] == 4
    assert sorted((r for r in got if r not in one + four), key=str) == sorted([(3, b), (4, d), (None, None)], key=str)


def test_run_on_known_documents(spark, tmp_path):
    """What must stay, by construction, and how often, by the mix's SQL over that."""
    rnd = random.Random(4)
    roots = {"en": ["wor", "thi", "sea", "lon", "ship", "bre"], "de": ["schl", "üb", "gro", "zei", "kön", "wäh"]}
    made = {k: ["".join(rnd.choice(v) for _ in range(2)) + rnd.choice("aeiou") * (k == "en") + chr(97 + i % 26) + chr(97 + i // 26) for i in range(600)] for k, v in roots.items()}
    some = lambda lang, n: " ".join(rnd.choice(made[lang]) for _ in range(n))
    sources, item, passage = ["web", "wiki", None], some("en", 30), some("en", 70)
    keep = [(i, some("en" if i % 2 else "de", 90), "en" if i % 2 else "de", sources[i % 3]) for i in range(60)]
    keep += [(None, some("de", 80), "de", "wiki") for _ in range(4)]
    first = (100, f"{some('en', 40)} {passage} {some('en', 40)}", "en", "web")
    before, behind = some("en", 40), some("en", 40)
    second = (101, f"{before} {passage} {behind}", "en", "web")
    gone = [(200 + i, t, "en", "web") for i, (_, t, *_) in enumerate(keep[1:20:2])]  # copies
    gone += [(300 + i, keep[i][1] + " anhang", "de", "wiki") for i in (0, 2)]  # near copies
    gone += [(400, None, "en", "web"), (401, "", "en", "web"), (402, "12 34 !", "en", None)]  # no letters
    gone += [(500 + i, f"{some('en', 30)} {item} {some('en', 30)}", "en", "web") for i in range(2)]  # the second loses the item as a repeat
    table = [(*r[:2], *r[2:], len(r[1] or "")) for r in [*keep, first, second, *gone]]
    spark.createDataFrame(table, KIND).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {(r.doc_id, r.text) for r in got}
    assert 500 not in {i for i, _ in texts} and not {i for i, *_ in gone if i != 501} & {i for i, _ in texts}
    kept = {(i, t): s for i, t, _, s in [*keep, first]}
    cut = next((t for i, t in texts if i == 101), f"{before} {behind}")
    assert cut.split() == f"{before} {behind}".split()
    kept[101, cut] = "web"
    tail = next((t for i, t in texts if i == 501), None)  # without the item it is clean
    rest = [t for i, t, *_ in gone if i == 501][0].replace(item, "")
    assert tail is None or tail.split() == rest.split()
    kept[501, tail or rest] = "web"
    assert texts <= set(kept)
    documents = [(i, t, s) for (i, t), s in kept.items()]
    with duckdb.connect() as db:
        db.execute("create table documents (doc_id bigint, text varchar, source varchar)")
        db.executemany("insert into documents values (?, ?, ?)", documents)
        want = sorted(((i, taken) for i, _, _, _, taken in db.execute(mixing.ORACLE).fetchall() if taken), key=str)
    taken = {}
    for r in got:
        taken[r.doc_id, r.text] = taken.get((r.doc_id, r.text), 0) + len(r.text.split())
    assert sorted(((i, n) for (i, _), n in taken.items()), key=str) == want


def test_stages_ignore_other_columns_and_empty_tables(spark, frame, tmp_path):
    spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = frame([(i, prose(60 + i, 40)) for i in range(6)])
    odd = rows.selectExpr("*", "'x' as _id", "'y' as _own", "1 as _md5", "'z' as kept_text", "2 as copies", "3 as row")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns[:5] == corpus_pipeline.COLUMNS and (name == "source_mixing" or out.count() == 6)
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
