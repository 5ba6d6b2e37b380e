"""Mix sources to target weights by repeating documents.

Tokens are summed per source; a source's rate is its target over its size; every document is
emitted floor(rate) times, and once more if a draw seeded by its id falls below the fraction.
Everything is DataFrame functions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.hashing import unused
from skyledger.storage import stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the id and the seed: 52 bits of an MD5."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, null last, without one task for all of them."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        sources.repartitionByRange(n, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "mix-ranges",
    )
    # one row per partition, so this window is bounded by their number
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.withColumn("at", F.row_number().over(within))
        .join(starts, "part")
        .select("source", "source_size", (F.col("first") + F.col("at") - 1).alias("place"))
    )


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source, source_size, target``: weights repeat over the sources in code point order.

    The total is ``share`` of all sizes (never above ``most``); a source stops at ``most`` times
    its size and the excess is shared again by weight until none is above. Only sums reach the
    driver: the level of water, one number a round.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(stored(per_source, "mix-sources"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    base = stored(ranked.withColumn("weight", weight).drop("place"), "mix-weights")
    cap = F.col("source_size") * F.lit(float(most))
    total = base.agg(F.sum("source_size")).first()[0] or 0
    total = min(share, most) * float(total)
    level, stopped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        got = base.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if got.n == stopped or not got.open:
            break
        stopped, level = got.n, (total - got.capped) / got.open
    return base.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def with_copies(documents: DataFrame, seed: int = 17, id_col: str = "doc_id", **goal) -> DataFrame:
    """``documents`` with ``size, source_size, target, copies`` (how often the mix takes each row).

    Defined results: null text has size 0; a null source is a source of its own, the last; a
    source without words has target and rate 0; repeated rows draw alike, as do null ids; an empty
    table gives no rows. Columns of the input named like the new ones are replaced.
    """
    new = ["size", "source_size", "target", "copies"]
    own = [c for c in documents.columns if c not in new]
    sizes = documents.select("source", word_count(F.col("text")).alias("size"))
    theirs = unused("mix_source", documents)
    targets = source_targets(sizes, **goal).withColumnRenamed("source", theirs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = draw(F.col(id_col), seed) < rate - F.floor(rate)
    return (
        documents.select(*own)
        .join(targets, F.col("source").eqNullSafe(F.col(theirs)))
        .withColumn("size", word_count(F.col("text")))
        .withColumn("copies", F.floor(rate) + extra.cast("long"))
        .select(*own, *new)
    )


def mix(documents: DataFrame, **settings) -> DataFrame:
    """The mixed rows themselves: each document as often as it is taken, copies numbered from 1."""
    return (
        with_copies(documents, **settings)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .drop("size", "source_size", "target", "copies")
    )


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
r as (select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w from s),
t as (select 1.5 * sum(source_size)::double as total from r),
-- sources that stop first come first; c is what those before stop at, open the weight of the rest
o as (select *, 2.0 * source_size as cap, row_number() over q as k,
        coalesce(sum(2.0 * source_size) over (q rows between unbounded preceding and 1 preceding), 0) as c,
        sum(w) over (q rows between current row and unbounded following) as open
      from r window q as (order by 2.0 * source_size / w, source nulls last)),
l as (select arg_min((total - c) / open, k) filter ((total - c) / open * w < cap) as level from o, t),
g as (select source, source_size, least(cap, w * coalesce(level, 1e300)) as target from o, l),
m as (select d.doc_id, d.size, g.source_size, g.target, case when g.source_size > 0 then g.target / g.source_size else 0.0 end as rate,
        ('0x' || substr(md5('17:' || coalesce(d.doc_id::varchar, '')), 1, 13))::bigint::double / 4503599627370496.0 as u
      from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target,
  (floor(rate)::bigint + (u < rate - floor(rate))::bigint) * size as taken from m
"""
