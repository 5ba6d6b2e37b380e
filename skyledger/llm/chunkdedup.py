"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes: each byte's random number enters at the bottom and has left the
top 8 bytes later. A cut is set where the hash is the smallest of all within ``reach`` bytes on
either side, and moved to the next start of a word. A cut thus depends on the text near it only,
so an insertion shifts chunks without changing those behind it, and a passage of 50 words holds
chunks to within some 20 bytes of its edges on average.

Single chunks are short and recur by chance, so they are not what is compared. At every chunk
begins a run of neighbouring chunks that add up to ``least`` bytes; runs are told apart by digest.
Each run is kept where it occurs first, in the order of document ids and places, and cut out
elsewhere. Cuts lie somewhat inside of a passage, so what is cut out is widened on both sides, word
by word, as far as the text there equals the text beside the first place. Whatever goes is thus part
of a repeat of ``least`` bytes at least, or a whole text shorter than that which repeats another
whole text, and every byte that goes has an equal one at an earlier place.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.hashing import U, mix, word_spans
from skyledger.storage import forget, stored

_GEAR = (mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) >> U(32)).astype("u4")


@dataclass(frozen=True)
class Chunks:
    """``bits``: how far the hash moves for each byte. A chunk has about twice ``reach`` bytes on average. The first and the last one of a text have
    more than ``reach``, unless the text itself has no more; between them, moving cuts to word starts
    can shorten one. Where the text itself sets no cut, the least hash between half of ``most`` and ``most`` bytes is one; a chunk
    has ``most`` + ``reach`` + ``shift`` bytes at most.
    ``least``: the bytes that neighbouring chunks must add up to before they count as a repeat.
    ``beside``: how many bytes on either side of a repeat are compared with those beside its first place."""

    reach: int = 12
    most: int = 256
    shift: int = 64
    bits: int = 4
    least: int = 100
    beside: int = 96

    def gear(self, raw: np.ndarray) -> np.ndarray:
        """The rolling hash after each byte, from windows of doubling width."""
        h, width = _GEAR[raw], 1
        while width * self.bits < 32:
            wider = h.copy()
            wider[width:] += h[:-width] << np.uint32(width * self.bits)
            h, width = wider, width * 2
        return h

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """Where chunks end, the last at the end of the text."""
        n, w = len(raw), self.reach
        if n <= w:
            return np.array([n]) if n else np.empty(0, "i8")
        padded = np.full(n + 2 * w, 0xFFFFFFFF, "u4")
        padded[w : w + n] = h = self.gear(raw)
        low, width = padded, 1
        while width * 2 <= w:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        low = np.minimum(low[: len(low) - (w - width)], low[w - width :])  # the least of w in a row
        least = (h < low[:n]) & (h <= low[w + 1 : w + 1 + n])
        found = np.flatnonzero(least) + 1
        found = found[(found > w) & (found < n)]
        starts, _ = word_spans(raw)
        found = self._moved(raw, starts, found)
        found = found[n - found > w]  # a cut near the end would leave a last chunk of a word or two
        edges = np.unique(np.concatenate([[0], found, [n]]))
        more = []
        for k in np.flatnonzero(np.diff(edges) > self.most + w):
            a, b = edges[k : k + 2]
            while b - a > self.most + w:  # text of a short period sets no cut: its least hash, so that chunks are equal again
                a = self._moved(raw, starts, a + self.most // 2 + h[a + self.most // 2 : a + self.most].argmin(keepdims=True) + 1)[0]
                more.append(a)
        edges = np.unique(np.concatenate([edges, more]).astype("i8"))
        edges = edges[(n - edges > w) | (edges == n)]
        return edges[1:]

    def runs(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs: from each chunk on, as many as make ``least`` bytes. A text
        shorter than that is one run."""
        cuts = self.cuts(raw)
        if len(raw) <= self.least:
            return np.zeros(min(len(raw), 1), "i8"), cuts[-1:]
        starts = np.append(0, cuts[:-1])
        starts = starts[len(raw) - starts >= self.least]
        return starts, cuts[np.searchsorted(cuts, starts + self.least)]

    def _moved(self, raw: np.ndarray, starts: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Cuts moved to the next of the word starts, or of the characters if that is far."""
        words = np.append(starts, len(raw))[np.searchsorted(starts, cuts)]
        return np.where(words - cuts <= self.shift, words, self._whole(raw, cuts))

    @staticmethod
    def _whole(raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Cuts moved to the next start of a UTF-8 character."""
        cuts = cuts.copy()
        for _ in range(3):
            inside = cuts < len(raw)
            inside[inside] = (raw[cuts[inside]] & 0xC0) == 0x80
            cuts[inside] += 1
        return cuts


def _rows(documents: DataFrame, id_col: str) -> DataFrame:
    """``id`` and ``mark``, which tells apart texts of equal ids, and the bytes."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(F.col(id_col).alias("id"), F.xxhash64(data).alias("mark"), data.alias("data"))


def run_table(documents: DataFrame, id_col: str = "doc_id", method: Chunks | None = None) -> DataFrame:
    """``id, mark, start, end, d1, d2``: every run with its place in bytes and its 128-bit digest."""
    method = method or Chunks()
    rows = _rows(documents, id_col)
    kind = f"id {dict(rows.dtypes)['id']}, mark long, start int, end int, d1 long, d2 long"
    names = [c.split()[0] for c in kind.split(", ")]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, start, end, digests = [], [], [], []
            for i, data in enumerate(batch.column(2).to_pylist()):
                starts, ends = method.runs(np.frombuffer(data, "u1"))
                digests += [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                start.append(starts)
                end.append(ends)
                owner.append(np.full(len(starts), i))
            if not digests:
                continue
            own = pa.array(np.concatenate(owner))
            pair = np.frombuffer(b"".join(digests), "i8").reshape(-1, 2)
            places = [pa.array(np.concatenate(x).astype("i4")) for x in (start, end)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), *places, pa.array(pair[:, 0]), pa.array(pair[:, 1])], names
            )

    return rows.mapInArrow(tasks, kind)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which spans, sorted by start, begin and which end a stretch of spans that overlap or touch. Ends
    must grow with starts."""
    new = np.append(True, starts[1:] > ends[:-1])[: len(starts)]
    return np.flatnonzero(new), np.flatnonzero(np.append(new[1:], True)[: len(starts)])


def _lists(columns: dict[str, list], counts: list[int]) -> pa.ListArray:
    """Lists of structs with ``counts`` items each, from the parts of every column."""
    whole = [c if isinstance(c, pa.Array) else pa.array(np.concatenate(c)) for c in columns.values()]
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]).astype("i4")), pa.StructArray.from_arrays(whole, list(columns)))


_SPANS = "array<struct<start:int,end:int>>"


def _chunk_spans(runs: DataFrame) -> DataFrame:
    """``id, mark, gone, every, edges`` of each document with repeated runs: the spans that repeat an
    earlier place, all spans with repeated runs, and for each end of the former ones where it lies
    here (``at``) and in the text which has the run first (``pid, pmark, pat``)."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "mark", "start")
    seen = runs.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("place")).where("n > 1")
    hits = runs.join(seen.select("d1", "d2", "place"), ["d1", "d2"])
    source = F.when(~place.eqNullSafe(F.col("place")), F.struct("place.id", "place.mark", "place.start"))
    spans = F.array_sort(F.collect_set(F.struct("start", "end", source.alias("source"))))
    grouped = hits.groupBy("id", "mark").agg(spans.alias("spans"))
    id_kind = dict(grouped.dtypes)["id"]
    kind = f"id {id_kind}, mark long, gone {_SPANS}, every {_SPANS}, edges array<struct<at:int,right:boolean,pid:{id_kind},pmark:long,pat:int>>"

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = batch.column(2)
            at, flat = spans.offsets.to_numpy(), spans.values
            start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            source = flat.field("source")
            later = source.is_valid().to_numpy(zero_copy_only=False)
            there = source.field("start").fill_null(0).to_numpy()
            gone, every, edges = {"start": [], "end": []}, {"start": [], "end": []}, {"at": [], "right": [], "pat": []}
            counts, picked = [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                left, right = _merged(start[a:b], end[a:b])
                every["start"].append(start[a:b][left])
                every["end"].append(end[a:b][right])
                k = a + np.flatnonzero(later[a:b])
                one, last = _merged(start[k], end[k])
                one, last = k[one], k[last]
                gone["start"].append(start[one])
                gone["end"].append(end[last])
                edges["at"].append(np.concatenate([start[one], end[last]]))
                edges["pat"].append(np.concatenate([there[one], there[last] + end[last] - start[last]]))
                edges["right"].append(np.repeat([False, True], len(one)))
                picked.append(np.concatenate([one, last]))
                counts.append((len(one), len(left), 2 * len(one)))
            where = pa.array(np.concatenate(picked))
            theirs = {"pid": source.field("id").take(where), "pmark": source.field("mark").take(where)}
            edges = {"at": edges["at"], "right": edges["right"], **theirs, "pat": edges["pat"]}
            n = list(zip(*counts, strict=True))
            made = [_lists(c, list(m)) for c, m in zip((gone, every, edges), n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["id", "mark", "gone", "every", "edges"])

    return grouped.mapInArrow(tasks, kind)


_WHITE = frozenset(b" \t\n\r\x0b\x0c")


def _shared(own: bytes, theirs: bytes, right: bool, width: int) -> int:
    """How many bytes next to an edge, in whole words, both texts have alike. ``own`` and ``theirs``
    are the ``width`` bytes behind it (before it, if not ``right``), or fewer at the end of a text."""
    a, b = (own, theirs) if right else (own[::-1], theirs[::-1])
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    x = n - (differ.bit_length() + 7) // 8
    over = lambda t, x: t[x] in _WHITE if x < len(t) else len(t) < width
    while x and not (over(a, x) and over(b, x)) and not (right and a[x - 1] in _WHITE):
        x -= 1
    return x


def _widened(documents: DataFrame, spans: DataFrame, id_col: str, width: int) -> DataFrame:
    """``id, mark, start, end``: what lies beside a repeated span and equals what lies beside its
    first place, up to ``width`` bytes on either side.

    Each text is asked once for the few bytes at its edges and at places that others repeat; texts
    themselves are not compared."""
    edges = spans.select("id", "mark", F.explode("edges").alias("e")).select("id", "mark", "e.*")
    theirs = edges.select(F.col("pid").alias("id"), F.col("pmark").alias("mark"), F.col("pat").alias("at"), "right")
    asked = edges.select("id", "mark", "at", "right").union(theirs).groupBy("id", "mark").agg(F.collect_set(F.struct("at", "right")).alias("asked"))
    asked = asked.select(F.col("id").alias("aid"), F.col("mark").alias("amark"), "asked")
    rows = _rows(documents, id_col)
    found = rows.join(asked, F.col("id").eqNullSafe(F.col("aid")) & (F.col("mark") == F.col("amark")))
    found = found.select("id", "mark", "data", F.explode("asked").alias("e")).select("id", "mark", "data", "e.*")
    begin = F.when(F.col("right"), F.col("at")).otherwise(F.greatest(F.col("at") - width, F.lit(0)))
    length = F.when(F.col("right"), F.lit(width)).otherwise(F.col("at") - begin)
    found = found.select("id", "mark", "at", "right", F.substring(F.col("data"), begin + 1, length).alias("beside"))
    found = stored(found.groupBy("id", "mark", "at", "right").agg(F.any_value("beside").alias("beside")), "chunks-beside")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    own = found.toDF("oid", "omark", "oat", "oright", "own")
    other = found.toDF("tid", "tmark", "tat", "tright", "theirs")
    pairs = edges.join(own, same("id", "oid") & same("mark", "omark") & same("at", "oat") & same("right", "oright"))
    pairs = pairs.join(other, same("pid", "tid") & same("pmark", "tmark") & same("pat", "tat") & same("right", "tright"))
    pairs = pairs.select("id", "mark", "at", "right", "own", "theirs")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, right = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            sides = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), right.tolist(), strict=True)
            more = np.array([_shared(a, b, r, width) for a, b, r in sides], "i4")
            start, end = np.where(right, at, at - more), np.where(right, at + more, at)
            columns = [batch.column(0), batch.column(1), pa.array(start.astype("i4")), pa.array(end.astype("i4"))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "start", "end"]).filter(pa.array(more > 0))

    more = stored(pairs.mapInArrow(tasks, f"id {dict(edges.dtypes)['id']}, mark long, start int, end int"), "chunks-wider")
    forget(found)
    return more


def repeated_spans(documents: DataFrame, id_col: str = "doc_id", method: Chunks | None = None) -> DataFrame:
    """``id, mark, gone, repeated``: per document with repeated runs, the spans to cut out in order
    (``array<struct<start, end>>``, joined where they overlap or touch) and the bytes in repeated
    runs, first places included."""
    method = method or Chunks()
    runs = run_table(documents, id_col, method)
    # half the digest tells which runs may be repeated, so that only those carry their places on
    many = stored(runs.groupBy("d1").count().where("count > 1").select("d1"), "chunks-many")
    runs = stored(runs.join(many, "d1"), "chunks-repeated")
    forget(many)
    spans = stored(_chunk_spans(runs), "chunks-spans")
    forget(runs)
    more = _widened(documents, spans, id_col, method.beside)
    wider = more.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("more"))
    wider = wider.select(F.col("id").alias("wid"), F.col("mark").alias("wmark"), "more")
    both = spans.join(wider, F.col("id").eqNullSafe(F.col("wid")) & (F.col("mark") == F.col("wmark")), "left")
    more_ = F.coalesce("more", F.array().cast(_SPANS))
    both = both.select("id", "mark", *[F.array_sort(F.concat(c, more_)).alias(c) for c in ("gone", "every")])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = []
            for spans in batch.columns[2:]:
                at, flat = spans.offsets.to_numpy(), spans.values
                start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
                merged, counts = {"start": [], "end": []}, []
                for a, b in zip(at[:-1], at[1:], strict=True):
                    reach = np.maximum.accumulate(end[a:b])
                    left, right = _merged(start[a:b], reach)
                    merged["start"].append(start[a:b][left])
                    merged["end"].append(reach[right])
                    counts.append(len(left))
                made.append((merged, counts))
            repeated = [int((e - s).sum()) for s, e in zip(made[1][0]["start"], made[1][0]["end"], strict=True)]
            columns = [batch.column(0), batch.column(1), _lists(*made[0]), pa.array(repeated, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "gone", "repeated"])

    out = stored(both.mapInArrow(tasks, f"id {dict(both.dtypes)['id']}, mark long, gone {_SPANS}, repeated long"), "chunks-cut")
    forget(spans, more)
    return out


def dedup_substrings(documents: DataFrame, id_col: str = "doc_id", method: Chunks | None = None) -> DataFrame:
    """``documents`` with ``kept_text`` (repeats cut out), ``removed_bytes``, ``repeated_bytes`` (in
    runs that occur more than once, first places included) and ``removed_spans`` (apart from each other).

    Defined results: null text has nothing to remove and stays null; empty text stays empty; of
    runs with equal bytes the first by id (null last), then by text and place, is kept, the
    others go, in the same document too; rows repeated with the same id and text are one document
    and are treated alike; a text may be left empty; an empty table gives no rows; columns of the
    input named like the new ones are replaced.
    """
    new = ["kept_text", "removed_bytes", "repeated_bytes", "removed_spans"]
    own = [c for c in documents.columns if c not in new]
    spans = repeated_spans(documents, id_col, method).select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), "gone", "repeated")
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = documents.select(F.struct(*own).alias("row"), F.col(id_col).alias("__own"), mark.alias("__at"), F.col("text").alias("__text"))
    rows = rows.join(spans, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__at") == F.col("__mark")), "left")
    gone = F.coalesce("gone", F.array().cast("array<struct<start:int,end:int>>"))
    rows = rows.select("row", F.col("__text").cast("binary").alias("data"), gone.alias("gone"), F.coalesce("repeated", F.lit(0)).alias("repeated"))
    width = F.aggregate("gone", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    # what is kept lies between the spans that go
    ends = F.concat(F.transform("gone", lambda s: s["start"]), F.array(F.length("data")))
    begins = F.concat(F.array(F.lit(0)), F.transform("gone", lambda s: s["end"]))
    kept = F.transform(
        F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda s: F.substring(F.col("data"), s["a"] + 1, s["b"] - s["a"]).cast("string"),
    )
    text = F.when(F.size("gone") == 0, F.col("data").cast("string")).otherwise(F.array_join(kept, ""))
    return rows.select(
        "row.*",
        text.alias("kept_text"),
        width.alias("removed_bytes"),
        F.col("repeated").cast("long").alias("repeated_bytes"),
        F.size("gone").cast("long").alias("removed_spans"),
    )
