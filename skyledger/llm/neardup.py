"""Near-duplicate documents by chosen-path set similarity join.

A document is the set of its shingles. Its signature holds one minwise token for each of many
random orders. A tree is walked from its root: at every node a pseudo-random choice that depends
on the node alone names one or two of the orders, and a document goes to the child named by the
token it has there. Similar documents share paths, others part soon. On average a pair of the
wanted similarity shares as many children as it had nodes, and independent trees raise the recall.
Where a node must go deeper, it branches more often: so often that a pair of the wanted similarity
stays together in some tree with the wanted recall however deep its nodes go. The chance for that
is computed from the similarity, the number of trees and the recall.

Two observations keep the work linear where copies gather. Documents with equal sets are one class
from the start. And since the result is the connected components, a node whose members are all
connected needs no further comparing: each document is first checked against the member of its
node with the smallest key, and then only members outside a node's largest component are compared
with all others, exhaustively where they are few, some levels deeper where they are not.

Candidates are pre-checked on sketches with a wide margin; every link is confirmed on full sets.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components, extended
from skyledger.llm.hashing import U, mix, odd, shingle_set
from skyledger.storage import stored

# The query over documents as SQL, for small tables: all pairs that share a shingle, and their closure.
ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM split
),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
tops AS (SELECT x, least(x, min(y)) AS top FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(top, doc_id) AS component_id, doc_id = coalesce(top, doc_id) AS kept
FROM sets LEFT JOIN tops ON doc_id = x
"""


@dataclass(frozen=True)
class ChosenPath:
    """``similarity`` in percent. ``few``: so many members outside its largest component a node may
    have to be compared exhaustively, in blocks of ``block`` members; the others go ``step`` levels
    deeper. ``recall``: the share of pairs at the similarity that some tree keeps together, at any
    depth. ``sketch``: further orders, of which one byte of each token is kept for comparing, the
    first quarter of them before all, and the second half for the levels below. ``deviations``: how many standard deviations of an estimate
    a pair may lie below the similarity and still be confirmed on full sets."""

    similarity: int = 75
    width: int = 5
    orders: int = 128
    trees: int = 14
    depth: int = 2
    few: int = 256
    block: int = 256
    step: int = 3
    recall: float = 0.998
    sketch: int = 1024
    deviations: float = 5.0
    seed: int = 7

    def signature(self, tokens: np.ndarray) -> np.ndarray:
        return self._minima(tokens, self.orders, self.seed)

    def sketch_of(self, tokens: np.ndarray) -> np.ndarray:
        best = self._minima(tokens, self.sketch, self.seed + 1)
        return (best * np.uint32(0x9E3779B1) >> np.uint32(24)).astype("u1")

    def least(self, orders: int) -> float:
        """The smallest share of equal tokens in an estimate from so many orders."""
        wanted = self.similarity / 100
        return wanted - self.deviations * (wanted * (1 - wanted) / orders) ** 0.5

    @staticmethod
    def _minima(tokens: np.ndarray, orders: int, seed: int) -> np.ndarray:
        ways = (odd(orders, seed) & U(0xFFFFFFFF)).astype("u4")[:, None]
        short = (tokens >> U(32)).astype("u4")
        best = np.full(orders, 0xFFFFFFFF, "u4")
        for at in range(0, len(short), 2048):
            np.minimum(best, (short[None, at : at + 2048] * ways).min(1), out=best)
        return best

    def roots(self) -> np.ndarray:
        return mix(np.arange(1, self.trees + 1, dtype=U) * U(0x9E3779B97F4A7C15))

    def lost(self, chance: float, after: float = 0.0) -> float:
        """The probability that a pair at the similarity parts in one level, or below it with
        probability ``after`` for each child they share."""
        wanted = self.similarity / 100
        apart = 1 - wanted + wanted * after
        return (1 - chance) * apart + chance * apart * apart

    @property
    def even(self) -> float:
        """The chance of a second order with which 100 / similarity orders are chosen on average."""
        return 100.0 / self.similarity - 1.0

    @property
    def lively(self) -> float:
        """The chance of a second order, below the first levels, with which all trees together lose
        no more than 1 - recall of the pairs at the similarity, however many levels follow."""

        def missed(chance: float) -> float:
            after = 0.0
            for _ in range(10_000):  # tends to the share lost by an endless tree
                after = self.lost(chance, after)
            for _ in range(self.depth):
                after = self.lost(self.even, after)
            return after**self.trees

        low, high = self.even, 1.0
        for _ in range(12):
            middle = (low + high) / 2
            low, high = (low, middle) if missed(middle) <= 1 - self.recall else (middle, high)
        return high

    def children(self, nodes: np.ndarray, signatures: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
        """For each node with the signature of a document in it: the child nodes, and the rows they
        come from. One order is chosen, and with ``chance`` a second one."""
        first = mix(nodes + U(1))
        second = mix(nodes + U(2))
        n = U(signatures.shape[1])
        one = (first % n).astype("i8")
        two = ((first % n + U(1) + (second >> U(32)) % (n - U(1))) % n).astype("i8")
        extra = (second & U(0xFFFFFFFF)).astype("f8") / 2.0**32 < chance
        rows = np.concatenate([np.arange(len(nodes)), np.flatnonzero(extra)])
        order = np.concatenate([one, two[extra]])
        token = signatures[rows, order].astype(U)
        return mix(mix(nodes[rows] + order.astype(U) * U(0xD6E8FEB86659FD93)) + token), rows

    def descend(self, nodes: np.ndarray, signatures: np.ndarray, levels: int, chance: float) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`children`, so many levels below."""
        rows = np.arange(len(nodes))
        for _ in range(levels):
            nodes, back = self.children(nodes, signatures[rows], chance)
            rows = rows[back]
        return nodes, rows


def _arrow(df: DataFrame, work, kind: str) -> DataFrame:
    return df.mapInArrow(lambda batches: (out for b in batches for out in work(b)), kind)


def _signatures(column: pa.Array, orders: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u4").reshape(-1, orders)


def describe(documents: DataFrame, id_col: str, method: ChosenPath) -> DataFrame:
    """Per row: ``doc_id, n_shingles, digest`` of the set and ``signature`` (null without words)."""
    kind = dict(documents.dtypes)[id_col]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1):
                tokens = shingle_set(text.as_py(), method.width)
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                signatures.append(method.signature(tokens).tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    rows = documents.select(F.col(id_col).alias("doc_id"), F.col("text").cast("binary").alias("data"))
    return rows.mapInArrow(tasks, f"doc_id {kind}, n_shingles long, digest binary, signature binary")


def _shared(nodes: DataFrame) -> DataFrame:
    """Rows of nodes that more than one document is in."""
    many = nodes.groupBy("node").count().where("count > 1").select("node")
    return nodes.join(many, "node")


def _start(classes: DataFrame, method: ChosenPath) -> DataFrame:
    def work(batch):
        signatures = _signatures(batch.column(1), method.orders)
        n, roots = len(signatures), method.roots()
        rows = np.tile(np.arange(n), len(roots))
        nodes, back = method.descend(np.repeat(roots, n), signatures[rows], method.depth, method.even)
        yield pa.RecordBatch.from_arrays([pa.array(nodes.view("i8")), batch.column(0).take(pa.array(rows[back]))], ["node", "digest"])

    return _arrow(classes.select("digest", "signature"), work, "node long, digest binary")


def _deeper(rows: DataFrame, method: ChosenPath) -> DataFrame:
    """The nodes some levels below, for rows ``node, digest, sketch``. Its orders are others than
    those of the first levels, and many, so that trees differ."""
    half, chance = method.sketch // 2, method.lively

    def work(batch):
        tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), "u1").reshape(-1, half)
        nodes, back = method.descend(batch.column(0).to_numpy().view("u8"), tokens, method.step, chance)
        yield pa.RecordBatch.from_arrays([pa.array(nodes.view("i8")), batch.column(1).take(pa.array(back))], ["node", "digest"])

    tokens = F.substring("sketch", half + 1, half)
    return _arrow(rows.select("node", "digest", tokens), work, "node long, digest binary")


def _sketches(column: pa.Array, method: ChosenPath) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u1").reshape(-1, method.sketch)


def _promising(pairs: DataFrame, method: ChosenPath) -> DataFrame:
    """``a, b`` of the pairs (with sketches ``sa, sb``) that may be similar enough."""
    least = method.least(method.sketch)

    def work(batch):
        same = (_sketches(batch.column(2), method) == _sketches(batch.column(3), method)).mean(1)
        keep = pa.array(np.flatnonzero(same >= least))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    return _arrow(pairs.select("a", "b", "sa", "sb"), work, "a binary, b binary")


def _compared(small: DataFrame, sketches: DataFrame, method: ChosenPath) -> DataFrame:
    """``a, b``, a < b, of the promising pairs of different components in the nodes, each once.

    The members of a node outside its largest component are at most ``few``; they are sent to
    blocks of about ``block`` members and compared there as arrays. So a node is copied once,
    not once for each pair, and a large one is spread over many tasks. Each member brings the list
    of its nodes, which follows the trees and not the number of documents: a pair that meets in
    several nodes is told by the smallest of them alone."""
    few, some = method.few, method.sketch // 4
    placed = small.groupBy("digest").agg(F.collect_list("node").alias("nodes")).join(sketches, "digest")
    rows = small.join(placed, "digest").withColumn("blocks", F.ceil(F.col("members") / method.block))
    rows = rows.withColumn("entry", F.struct("digest", "root", "sketch", "nodes", (F.col("root") != F.col("main")).alias("apart")))
    whole = rows.withColumn("block", F.pmod(F.xxhash64("digest"), "blocks")).groupBy("node", "block").agg(F.collect_list("entry").alias("ys"))
    apart = rows.where("entry.apart").groupBy("node").agg(F.collect_list("entry").alias("xs"), F.first("blocks").alias("blocks"))
    apart = apart.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))

    def work(batch):
        nodes, xs, ys = batch.columns
        x_at, y_at = xs.offsets.to_numpy(), ys.offsets.to_numpy()
        x, y = xs.values, ys.values
        roots = pa.concat_arrays([x.field("root"), y.field("root")]).dictionary_encode().indices.to_numpy()
        rx, ry = roots[: len(x)], roots[len(x) :]
        sx, sy = _sketches(x.field("sketch"), method), _sketches(y.field("sketch"), method)
        names, others = x.field("digest").to_pylist(), y.field("digest").to_pylist()
        both = y.field("apart").to_pylist()  # such a member is compared from both sides
        places = [[set(p) for p in side.field("nodes").to_pylist()] for side in (x, y)]
        left, right = [], []
        for i, node in enumerate(nodes.to_pylist()):
            for k in range(x_at[i], x_at[i + 1], few):
                m, n = slice(k, min(k + few, x_at[i + 1])), slice(y_at[i], y_at[i + 1])
                same = (sx[m, None, :some] == sy[None, n, :some]).mean(2)
                one, two = np.nonzero((same >= method.least(some)) & (rx[m, None] != ry[None, n]))
                one, two = one + m.start, two + n.start
                good = (sx[one] == sy[two]).mean(1) >= method.least(method.sketch)
                for a, b in zip(one[good].tolist(), two[good].tolist(), strict=True):
                    if (not both[b] or names[a] < others[b]) and min(places[0][a] & places[1][b]) == node:
                        left.append(min(names[a], others[b]))
                        right.append(max(names[a], others[b]))
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return _arrow(apart.join(whole, ["node", "block"]).select("node", "xs", "ys"), work, "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, method: ChosenPath) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough on their full sets."""

    def work(batch):
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = np.frombuffer(x.as_py(), "u8"), np.frombuffer(y.as_py(), "u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= method.similarity * (len(x) + len(y) - both):
                keep.append(i)
        keep = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    left, right = sets.toDF("a", "xa"), sets.toDF("b", "xb")
    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "xa", "xb")
    return _arrow(rows, work, "a binary, b binary")


def _sets_of(documents: DataFrame, id_col: str, wanted: DataFrame, method: ChosenPath) -> DataFrame:
    """``digest, tokens, sketch`` of the classes in ``wanted`` (digest, doc_id of one document of each)."""

    def work(batch):
        sets = [shingle_set(t, method.width) for t in batch.column(0).to_pylist()]
        tokens = [s.tobytes() for s in sets]
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in tokens]
        sketches = [method.sketch_of(s).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(z, pa.binary()) for z in (digests, tokens, sketches)], ["digest", "tokens", "sketch"])

    rows = documents.select(F.col(id_col).alias("id"), F.col("text").cast("binary").alias("data"))
    ids = wanted.select("doc_id").distinct()
    found = _arrow(rows.join(ids, F.col("id").eqNullSafe(F.col("doc_id")), "left_semi").select("data"), work, "digest binary, tokens binary, sketch binary")
    # an id may stand for several texts: only the wanted classes, each once
    return found.join(wanted.select("digest"), "digest", "left_semi").dropDuplicates(["digest"])


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", method: ChosenPath | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked whose sets have at least ``similarity`` percent of their union in common;
    ``component_id`` is the smallest id reachable over links, ``kept`` marks the document that has
    it. Defined results: without text or words the set is empty and linked with nothing; fewer
    words than ``width`` are one shingle; rows with equal texts are linked; every row is returned,
    also repeated ones; a null id counts as larger than any other; an empty table gives no rows;
    other columns are ignored.
    """
    method = method or ChosenPath()
    own = stored(describe(documents, id_col, method), "paths-own")
    classes = stored(
        own.where("digest is not null").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.any_value("signature").alias("signature")
        ),
        "paths-classes",
    )
    nodes = stored(_shared(_start(classes, method)), "paths-nodes")
    live = nodes.select("digest").distinct()
    wanted = stored(classes.join(live, "digest").select("digest", "doc_id"), "paths-live")
    known = stored(_sets_of(documents, id_col, wanted, method), "paths-sets")
    sketches, sets = known.select("digest", "sketch"), known.select("digest", "tokens")

    def likeliest(pairs: DataFrame) -> DataFrame:
        """Confirmed links of each ``b`` with the ``a`` that it meets in most nodes: one for each
        ``b``, chosen before anything is fetched for the pairs."""
        often = pairs.groupBy("b", "a").count()
        best = often.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))
        best = best.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b")
        return stored(_confirmed(_promising(best, method), sets, method), "paths-links")

    def unfinished(nodes: DataFrame, roots: DataFrame) -> DataFrame:
        """The nodes that hold several components, with each member's."""
        placed = nodes.join(roots.withColumnRenamed("key", "digest"), "digest", "left")
        placed = placed.select("node", "digest", F.coalesce("root", "digest").alias("root"))
        sizes = placed.groupBy("node", "root").count()
        state = sizes.groupBy("node").agg(
            F.max(F.struct("count", "root"))["root"].alias("main"),
            (F.sum("count") - F.max("count")).alias("outside"),
            F.count("*").alias("parts"),
            F.sum("count").alias("members"),
        )
        return stored(placed.join(state.where("parts > 1"), "node"), "paths-open")

    # every document against the smallest key of its nodes
    pivots = nodes.groupBy("node").agg(F.min("digest").alias("a"))
    roots = components(likeliest(nodes.join(pivots, "node").where("a != digest").select("a", F.col("digest").alias("b"))), "paths-roots")
    tried = None
    for _ in range(64):
        left = unfinished(nodes, roots)
        small = left.where(F.col("outside") <= method.few)
        pairs = _compared(small, sketches, method)
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "paths-pairs")
        tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
        found = stored(_confirmed(pairs, sets, method), "paths-links")
        if not found.isEmpty():
            roots = stored(extended(roots, found), "paths-roots")
        large = left.where(F.col("outside") > method.few).select("node", "digest").join(sketches, "digest")
        nodes = stored(_shared(_deeper(large, method)), "paths-nodes")
        if nodes.isEmpty():
            break
    else:
        raise RuntimeError("nodes do not part: more than 64 levels")

    # only classes with copies or links have another label than their own id
    tops = classes.select("digest", "doc_id", "copies").join(roots.withColumnRenamed("key", "digest"), "digest", "left")
    tops = tops.where("root is not null or copies > 1").withColumn("root", F.coalesce("root", "digest"))
    first = tops.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = tops.join(first, "root").select("digest", "component_id")
    out = own.join(labels, "digest", "left").withColumn(
        "component_id", F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
