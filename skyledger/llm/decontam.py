"""Benchmark decontamination by SimHash over windows of the items' own sizes.

A window of as many words as an item has gets a SimHash of its word shingles, each weighing as
often as it occurs. Fingerprints are cut into one block more than the radius, so two within the
radius agree in a block: a join on (size, block, value) finds them all. Candidates within the
radius are then verified by exact weighted similarity, the sum of the smaller over the sum of the
larger counts of each shingle.

Only windows that begin with a shingle of an item of that size (or end with the text) are built.
Nothing is lost: a window that begins otherwise does not become less similar by moving on one
word, as it gives up a shingle that is not the item's; and a window without any shingle of the
item has similarity 0. Everything is DataFrame functions.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.storage import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LANES = 0x0000000100000001


def words(text: Column) -> Column:
    """Words, A-Z lowered; null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def shingles(of: Column, width: int) -> Column:
    """A hash for each run of ``width`` words, in order; none if there are fewer."""
    starts = F.when(F.size(of) >= width, F.sequence(F.lit(0), F.size(of) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(of, i + j) for j in range(width)]))


def _fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, simhash, total`` of rows (keys, h), one for each shingle: two bits share a sum, the
    one of bit j in its low half, the one of bit j + 32 in its high half."""
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LANES))).alias(f"s{j}") for j in range(32)]
    summed = rows.groupBy(*keys).agg(F.count("*").alias("total"), *sums)
    half = lambda j, high: F.shiftrightunsigned(f"s{j}", 32) if high else F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
    bit = lambda j, high: F.when(half(j, high) * 2 > F.col("total"), F.lit(1 << j if not high else (1 << j + 32) - (1 << 64 if j == 31 else 0)).cast("long")).otherwise(F.lit(0).cast("long"))
    parts = [bit(j, high) for j in range(32) for high in (False, True)]
    return summed.select(*keys, "total", reduce(lambda a, b: a.bitwiseOR(b), parts).alias("simhash"))


def _blocks(radius: int) -> Column:
    """``array<struct<block, value>>`` of a fingerprint: one block more than the radius."""
    n = radius + 1
    edges = [64 * k // n for k in range(n + 1)]
    cut = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("simhash", a).bitwiseAND(F.lit((1 << b - a) - 1)).alias("value"))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
    ]
    return F.array(*cut)


def contaminated(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", similarity: float = 0.75,
    width: int = 5, radius: int = 21, broadcast_rows: int = 200_000,
) -> DataFrame:
    """``doc_id, item_id, start, n_words, distance, similarity``: per document and item the most
    similar window (of equals the first that begins with a shingle of an item), if it reaches
    ``similarity``; ``start`` counts words.

    ``radius`` 21 of 64 bits holds pairs at similarity 0.75 (expected distance 11, deviation 3).
    The shingles of the items are broadcast up to ``broadcast_rows`` of them (counted), and joined
    by a shuffle beyond. Defined results: texts without words match nothing; an item with fewer
    words than ``width`` is one shingle; a text shorter than an item is one window; rows with
    equal ids are told apart by their text and reported once per id; a null id is reported as
    null; empty tables give no rows; other columns are ignored.
    """
    texts = documents.select(F.struct(F.col(id_col).alias("id"), F.xxhash64("text").alias("mark")).alias("doc"), F.col("text").alias("text"))
    tests = stored(
        items.select(F.col(item_col).alias("item_id"), words(F.col("text")).alias("w"))
        .where(F.size("w") > 0)
        .withColumn("size", F.size("w"))
        .withColumn("k", F.least("size", F.lit(width))),
        "bench-items",
    )
    found = []
    for (k,) in sorted(tests.select("k").distinct().collect()):  # at most ``width`` rows
        part = tests.where(F.col("k") == k)
        item_rows = stored(part.select("item_id", "size", F.explode(shingles(F.col("w"), k)).alias("h")), "bench-shingles")
        found.append(_matches(texts, item_rows, k, similarity, radius, broadcast_rows))
    if not found:
        kinds = dict(texts.select("doc.id").dtypes)["id"], dict(items.dtypes)[item_col]
        return documents.sparkSession.createDataFrame(
            [], f"doc_id {kinds[0]}, item_id {kinds[1]}, start int, n_words int, distance int, similarity double"
        )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "size", "distance"))
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy(F.col("doc.id").alias("doc_id"), "item_id")
        .agg(best.alias("m"))
        .select("doc_id", "item_id", (-F.col("m.s")).alias("start"), F.col("m.size").alias("n_words"), "m.distance", "m.similarity")
    )


def _shingled(rows: DataFrame, k: int) -> DataFrame:
    # words are a column first: inside the lambda they would be split again for every shingle
    return rows.select("doc", words(F.col("text")).alias("w")).select("doc", F.size("w").alias("n"), shingles(F.col("w"), k).alias("g"))


def _windows(texts: DataFrame, item_rows: DataFrame, k: int, broadcast_rows: int) -> DataFrame:
    """``doc, start, size, shingles`` of every window to look at, each once."""
    starts = item_rows.select("h", "size").distinct()
    small = starts.count() <= broadcast_rows
    rows = _shingled(texts, k)
    start = F.least("pos", F.greatest(F.col("n") - F.col("size"), F.lit(0))).alias("start")
    cut = F.slice("g", F.col("start") + 1, F.col("size") - (k - 1)).alias("shingles")
    key = ["doc", "start", "size"]
    # outer, as the inner form makes the planner filter on the whole expression, below its columns
    if small:  # the array is at hand where a shingle hits, so texts are neither shuffled nor read again
        spread = rows.select("doc", "n", "g", F.posexplode_outer("g").alias("pos", "h")).where("h is not null")
        hits = spread.join(F.broadcast(starts), "h").select("doc", start, "size", "g").select(*key, cut)
        return hits.groupBy(*key).agg(F.any_value("shingles").alias("shingles"))
    spread = rows.select("doc", "n", F.posexplode_outer("g").alias("pos", "h")).where("h is not null")
    places = stored(spread.join(starts, "h").select("doc", start, "size").distinct(), "bench-places")
    hit = texts.join(places.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    return _shingled(hit, k).join(places, "doc").select(*key, cut)


def _matches(texts, item_rows, k, similarity, radius, broadcast_rows):
    key = ["doc", "start", "size"]
    windows = stored(_windows(texts, item_rows, k, broadcast_rows), "bench-windows")
    rows = windows.select(*key, F.explode("shingles").alias("h"))
    prints = stored(_fingerprints(rows, key), "bench-prints")
    item_prints = _fingerprints(item_rows, ["item_id", "size"])
    cut = lambda df: df.withColumn("b", F.explode(_blocks(radius))).select("*", "b.block", "b.value").drop("b")
    other = cut(item_prints).select("item_id", "size", "block", "value", F.col("simhash").alias("item_hash"), F.col("total").alias("item_total"))
    near = (
        cut(prints)
        .join(other, ["size", "block", "value"])
        .withColumn("distance", F.bit_count(F.col("simhash").bitwiseXOR(F.col("item_hash"))))
        .where(F.col("distance") <= radius)
        .select(*key, "item_id", "distance", "total", "item_total")
        .distinct()
    )
    counts = rows.groupBy(*key, "h").agg(F.count("*").alias("c"))
    item_counts = item_rows.groupBy("item_id", "h").agg(F.count("*").alias("ic"))
    both = near.join(counts, key).join(item_counts, ["item_id", "h"]).groupBy(*key, "item_id", "distance", "total", "item_total")
    common = both.agg(F.sum(F.least("c", "ic")).alias("common"))
    ratio = F.col("common") / (F.col("total") + F.col("item_total") - F.col("common"))
    return common.withColumn("similarity", ratio).where(F.col("similarity") >= similarity).select(*key, "item_id", "distance", "similarity")
