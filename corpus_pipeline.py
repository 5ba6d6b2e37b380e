"""A training corpus from raw documents, in five stages, each written and read again.

1. Language ID: documents without letters, or in no language with any confidence, go.
2. Near-duplicates: one document of each group stays.
3. Substrings: chunks that occurred before are cut out of the text.
4. Benchmark decontamination: documents with a passage of the benchmark go.
5. Mixing: documents are repeated to the target weights of their sources.

Every stage reads the columns of documents only, so others, whatever their names, change nothing, and
gives no rows for an empty table. Rows are told apart by id and text: those of equal or no id are
judged one by one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import chunkdedup, decontam, langid, mixing, neardup
from skyledger.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def _key() -> Column:
    """Tells rows apart by id and text, so that rows of equal or no id are judged one by one. In
    order of ids, null last."""
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text.alias("text_md5"))


def _listed(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined with ``keys`` (one column)."""
    keys = keys.toDF("_key").distinct().select(F.col("_key.doc_id").alias("_id"), F.col("_key.text_md5").alias("_md5"))
    rows = docs.select(*COLUMNS).withColumn("_own", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_md5")), how).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language, learned from the rows not held out. Rows without text or letters go, as do all
    if no row says its language; empty and very long texts, ties and repeated rows are judged each by its text."""
    found = langid.identify(docs.select(*COLUMNS))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, the one with the smallest id (null last), of ties the one with the smallest
    digest of its text: rows that repeat an id with its text count once as well. Rows without words are in no group and stay."""
    groups = neardup.near_duplicates(docs.select(_key().alias("key"), "text"), "key")
    return _listed(docs, groups.where("kept").select("doc_id"), "left_semi").dropDuplicates(["doc_id", "text"])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without what an earlier row or place has. Null text stays null, with null characters; rows that
    repeat id and text are cut alike; a text may be left empty."""
    cut = chunkdedup.dedup_substrings(docs.select(*COLUMNS))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with no window that is similar to an item. Rows without words, and all rows if there are no
    items, stay; of rows with one id only those go whose own text holds an item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = stored(decontam.contaminated(docs.select(_key().alias("key"), "text"), items, "key").select("doc_id"), "pipeline-hits")
    return _listed(docs, hit, "left_anti")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, with the number of the ``copy``. A null source is one of its own; rows
    without words weigh nothing and are drawn like others; a row may be taken no times."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
