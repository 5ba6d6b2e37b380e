"""Connected components of links, with labels that only grow smaller."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.storage import forget, stored, stored_counting


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``key, root`` for every key in ``links`` (a, b): the smallest key it is connected with.

    Each round takes the smallest label of all neighbours and then the label of that label, so
    long chains shorten fast. Every round is written to the shared folder, which cuts lineage;
    only a count of changed labels reaches the driver.
    """
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct().toDF("key", "other"), f"{label}-edges"
    )
    labels = stored(both.groupBy("key").agg(F.min("other").alias("o")).select("key", F.least("key", "o").alias("root")), label)
    while True:
        own = labels.select("key", "root")
        near = both.join(own.withColumnRenamed("key", "other"), "other").groupBy("key").agg(F.min("root").alias("near"))
        met = own.join(near, "key", "left").select("key", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        up = own.toDF("root", "above")
        nxt = met.join(up, "root", "left").select("key", "was", F.least("root", "above").alias("root"))
        nxt, changed = stored_counting(nxt, label, "was != root")
        forget(labels)
        labels = nxt
        if not changed:
            forget(both)
            return nxt.select("key", "root")


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``key, root`` as ``components`` gave it, after more ``links``: only the components that these
    touch are connected, as one key each, so the work follows the new links."""
    for side in ("a", "b"):
        links = links.join(roots.toDF(side, "root"), side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    met = components(links, "components-met")
    old = roots.join(met.toDF("root", "above"), "root", "left").select("key", F.coalesce("above", "root").alias("root"))
    return old.unionByName(met.join(roots, "key", "left_anti"))
