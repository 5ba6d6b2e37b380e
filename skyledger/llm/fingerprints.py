"""Order MinHash: fingerprints whose likeness follows the edit distance of texts.

The k-mers of a text are numbered by occurrence, so repeats count. Each of ``lanes`` random orders
selects the few smallest numbered k-mers, which are put back into the order in which they stand in
the text and hashed as a tuple. Two texts agree in a lane if they select the same k-mers in the
same order; the share of agreeing lanes is their likeness.

k-mers run over code points, and all of them take part.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.hashing import U, mix, odd
from skyledger.storage import stored


@dataclass(frozen=True)
class OrderMinHash:
    k: int = 8
    tuple_size: int = 2
    lanes: int = 64
    seed: int = 3
    block: int = 2048

    def kmers(self, text: str) -> np.ndarray:
        """Hashes of the k-mers, in text order."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(U) + U(1)
        if len(codes) < self.k:
            codes = np.concatenate([codes, np.zeros(self.k - len(codes), U)])
        ways, h, width = odd(self.k, self.seed), codes, 1
        while width * 2 <= self.k:  # double the width of what is hashed, then add the rest
            h, width = h[:-width] + h[width:] * ways[width], width * 2
        for j in range(width, self.k):
            h = h[:-1] + codes[j : j + len(h) - 1] * ways[j]
        return mix(h)

    def lanes_of(self, text: str) -> np.ndarray:
        """One 16-bit number a lane; zeros for the empty text."""
        if not text:
            return np.zeros(self.lanes, "u2")
        kmers = self.kmers(text)
        order = np.argsort(kmers, kind="stable")
        sorted_ = kmers[order]
        new = np.append(True, sorted_[1:] != sorted_[:-1])
        at = np.arange(len(kmers))
        nth = np.empty(len(kmers), U)
        nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U)
        # 32 bits order as well as 64 and multiply several times faster
        numbered = (mix(kmers + nth * U(0x9E3779B97F4A7C15)) >> U(32)).astype("u4")
        ways = (odd(self.lanes, self.seed + 1) & U(0xFFFFFFFF)).astype("u4")[:, None]
        take = min(self.tuple_size, len(kmers))
        best = []
        for start in range(0, len(kmers), self.block):
            part = numbered[None, start : start + self.block] * ways
            best.append(start + self._smallest(part, take))
        best = np.concatenate(best, 1)
        if best.shape[1] > take:
            picked = self._smallest(numbered[best] * ways, take)
            best = np.take_along_axis(best, picked, 1)
        best.sort(1)  # back into text order
        chosen, total = kmers[best], np.zeros(self.lanes, U)
        for j, way in enumerate(odd(take, self.seed + 2)):
            total += chosen[:, j] * way
        return (mix(total) >> U(48)).astype("u2")

    @staticmethod
    def _smallest(values: np.ndarray, take: int) -> np.ndarray:
        rows, found = np.arange(len(values)), []
        for _ in range(min(take, values.shape[1])):
            at = values.argmin(1)
            values[rows, at] = 0xFFFFFFFF
            found.append(at)
        return np.stack(found, 1)

    @staticmethod
    def as_text(lanes: np.ndarray) -> str:
        return lanes.astype(">u2").tobytes().hex()

    @staticmethod
    def likeness(a: np.ndarray, b: np.ndarray) -> float:
        return float(np.mean(a == b))


def fingerprint(documents: DataFrame, text: str = "text", method: OrderMinHash | None = None) -> DataFrame:
    """``documents`` with a ``fingerprint`` of each whole text.

    Defined results: null text counts as empty, whose fingerprint is all zeros; repeated rows stay and
    are alike; an empty table gives no rows; a column of the input named ``fingerprint`` is replaced.
    """
    method = method or OrderMinHash()
    own = [c for c in documents.columns if c != "fingerprint"]
    rows = documents.select(F.struct(*own).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [method.as_text(method.lanes_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["row", "fingerprint"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(tasks, f"row {kind}, fingerprint string").select("row.*", "fingerprint")


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_OUT = (
    "part int, first boolean, last boolean, doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, text string"
)


def ranged(rows: DataFrame) -> DataFrame:
    """``part, doc_id, text``: rows in descending order of ids, dealt to tasks by ranges that also split
    rows of one id, and of one id and text, by their place in the input."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    # texts stay out of the ranges' sample
    dealt = rows.repartitionByRange(n, *order, "place").sortWithinPartitions(*order, "text", "place")
    return dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")


def with_neighbours(documents: DataFrame, id_col: str = "doc_id", method: OrderMinHash | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, against the next document.

    The next document is the one after it by descending id, and the first one after the last.
    Rows are range-partitioned and sorted, so each task walks its rows with the next one in hand;
    only the last row of each task waits for the first row of the next task, one row a partition.

    Defined results: null text is empty; null ids come last; rows of equal ids are ordered by a
    hash of the text, then the text; a single row is its own next; an empty table gives no rows; other columns are ignored.
    """
    method, spark = method or OrderMinHash(), documents.sparkSession
    rows = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = _OUT.format(id=dict(rows.dtypes)["doc_id"])
    names = [c.split()[0] for c in kind.split(", ")]

    def facts(text, own, following, theirs):
        if following is None:
            return (None, method.as_text(own), None, None, None)
        changed = edited(text, following)
        lanes = method.lanes_of(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (sha, method.as_text(own), method.as_text(lanes), method.likeness(own, lanes), method.likeness(own, theirs))

    def table(rows):
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in batches:
            out = []
            for part, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = (part, doc_id, text, method.lanes_of(text))
                if held is not None:
                    out.append((held[0], first, False, held[1], len(held[2]), *facts(held[2], held[3], text, now[3]), held[2] if first else None))
                    first = False
                held = now
            yield table(out)
        if held is not None:
            yield table([(held[0], first, True, held[1], len(held[2]), *facts(held[2], held[3], None, None), held[2])])

    schema = to_arrow_schema(spark.createDataFrame([], kind).schema)
    done = stored(ranged(rows).mapInArrow(tasks, kind), "order-minhash")
    # one row per partition: the last one of each waits for the first one of the next
    heads = done.where("first").select("part", F.col("text").alias("following"))
    after = Window.orderBy("part")
    turn = F.coalesce(F.lead("part").over(after), F.first("part").over(after))
    linked = heads.select(F.col("part").alias("own"), turn.alias("part")).join(heads, "part").select(F.col("own").alias("part"), "following")
    waiting = done.where("last").join(linked, "part").select("part", "first", "last", "doc_id", "n_chars", "text", "following")

    def closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table(
                (r["part"], r["first"], True, r["doc_id"], r["n_chars"],
                 *facts(r["text"], method.lanes_of(r["text"]), r["following"], method.lanes_of(r["following"])), None)
                for r in batch.to_pylist()
            )

    out = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return done.where("not last").select(*out).unionByName(waiting.mapInArrow(closing, kind).select(*out))
