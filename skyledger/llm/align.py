"""Which tokens of two tokenizers cover the same bytes of a text.

Places where a token of both ends are shared cuts; between two neighbouring cuts lies a group, and
all its tokens of one side are linked with all of the other. Groups are found by divide and
conquer: an interval of tokens is cut at a common end near its middle, which a bisection of the
other side's ends confirms, and both halves go on; an interval without a common end inside is a
group. All intervals of a level, over many texts, are cut in one step.

How many documents hold an id pair linked is counted over the corpus from packed links: tasks
count their own documents first. Looking the counts up again has to bring them to every document.
The commonest pairs, at most ``hot`` of them, are few rows that every task can hold; documents look
those up in place, and only links of rarer pairs are joined with the counts, each of which is the
pair of a small share of all links.
"""

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructType
from tokenizers import Tokenizer

from skyledger.llm.arrows import kept, slices
from skyledger.storage import stored

# Between two visible characters a single space begins a token.
_CUT = re.compile("(?<=[!-~À-ÿ]) (?=[!-~À-ÿ])")
_SEEN = re.compile("[!-~À-ÿ]")
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
# The characters that stand for bytes in byte-level vocabularies.
_BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(_HIDDEN)}


class Coders:
    """Both tokenizers. A worker keeps the ids of stretches of text, in a young and an old table:
    what the old one still serves moves to the young one, which replaces it when it is full."""

    def __init__(self, path_a: str, path_b: str, remembered: int = 300_000):
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.n_b)]
        if self.b.normalize("a  ﬁ ") != "▁a▁▁ﬁ▁" or any("▁" in s.lstrip("▁") for s in names):
            raise ValueError("the second model changes texts, or its pieces go on over spaces")
        self.raw_a = [b""] * self.n_a
        for name, i in self.a.get_vocab().items():
            if all(c in _BYTE_OF for c in name):
                self.raw_a[i] = bytes(_BYTE_OF[c] for c in name)
        self.raw_b = [self._bytes_b(i) for i in range(self.n_b)]
        self.size_a = np.array([len(r) for r in self.raw_a], "i4")
        self.size_b = np.array([len(r) for r in self.raw_b], "i4")
        self.remembered, self.young, self.old = remembered, {}, {}
        self.shown = [f"{i}{mark}" for i in range(max(self.n_a, self.n_b)) for mark in ",|;"]

    def _bytes_b(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        silent = self.b.is_control(i) or self.b.is_unknown(i)
        return b"" if silent else self.b.id_to_piece(i).replace("▁", " ").encode()

    def _learn(self, parts: list[str]) -> None:
        """Encode new stretches as one text, which is cut again where they begin."""
        shut, alone = [], []
        for part in dict.fromkeys(parts):
            if (ids := self.old.get(part)) is not None:
                self.young[part] = ids
            else:
                (shut if _SEEN.match(part[0]) and _SEEN.match(part[-1]) else alone).append(part)
        for some in [*(shut[at : at + 4096] for at in range(0, len(shut), 4096)), *([p] for p in alone)]:
            self._encode(some)

    def _encode(self, some: list[str]) -> None:
        data = [b" " + p.encode("utf-8", "surrogatepass") for p in some]
        text, to = " ".join(some), np.cumsum([len(d) for d in data])
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        sides = []
        for ids, raw, size in ((a, self.raw_a, self.size_a), (self.b.encode(text), self.raw_b, self.size_b)):
            if b"".join(map(raw.__getitem__, ids)) != b"".join(data):
                if len(some) > 1:  # which of them is it?
                    for p in some:
                        self._encode([p])
                else:
                    self.young[some[0]] = None, None
                return
            ids = np.array(ids, "<i4")
            ends = [0, *(4 * (np.searchsorted(np.cumsum(size[ids]), to) + 1)).tolist()]
            packed = ids.tobytes()
            sides.append([packed[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)])
        self.young.update(zip(some, zip(*sides, strict=True), strict=True))

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text the ids of a space and the text on both sides, packed; none if either
        side does not stand for the same bytes. Stretches between cuts that both sides' rules make
        anyway are encoded one by one, which gives the ids of the whole."""
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        cut = [_CUT.split(t) if t else [] for t in texts]
        self._learn([p for parts in cut for p in parts if p not in self.young])
        out = []
        for parts in cut:
            a, b = zip(*map(self.young.__getitem__, parts), strict=True) if parts else ((), ())
            out.append((b"", b"") if None in a else (b"".join(a), b"".join(b)))
        return out


def coders(path_a: str, path_b: str) -> Coders:
    return kept("coders", (path_a, path_b), lambda: Coders(path_a, path_b))


def vocabulary_size(path_b: str) -> int:
    """The factor that parts an id pair's code."""
    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of the tokens of ``a`` that end where one of ``b`` ends, inside the intervals of
    tokens from ``first`` up to ``last`` (excluded), whose last tokens are known to; those included."""
    found = [last - 1]
    lo, hi = first, last - 1  # tokens that may still be cuts
    while len(lo):
        open_ = lo < hi
        lo, hi = lo[open_], hi[open_]
        at, step = (lo + hi) // 2, 0
        cut = np.full(len(lo), -1, "i8")
        waiting = np.arange(len(lo))
        while len(waiting):  # the middle, then its neighbours outwards
            probe = at[waiting] + (step // 2 + 1 if step % 2 else -(step // 2))
            inside = (probe >= lo[waiting]) & (probe < hi[waiting])
            w, p = waiting[inside], probe[inside]
            spot = np.searchsorted(ends_b, ends_a[p])
            hit = ends_b[np.minimum(spot, len(ends_b) - 1)] == ends_a[p]
            cut[w[hit]] = p[hit]
            step += 1
            left = waiting[cut[waiting] < 0]
            reach = (step + 1) // 2  # done once both sides are past
            waiting = left[(at[left] - reach >= lo[left]) | (at[left] + reach < hi[left])]
        good = cut >= 0
        found.append(cut[good])
        # both halves, in the order of the text
        lo, hi = np.stack([lo[good], cut[good] + 1], 1).ravel(), np.stack([cut[good], hi[good]], 1).ravel()
    return np.sort(np.concatenate(found))


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, one after the other."""
    starts = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(starts, sizes)


def links(
    a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_b: int, base: np.ndarray | int = 0, most: int = 1 << 20
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs as ``a * n_b + b`` plus the ``base`` of their group (which tells texts
    apart), in order, and how often each is linked. ``in_a`` and ``in_b``: tokens in each group. A
    group of very many links is counted by the distinct ids on both sides."""
    base = np.broadcast_to(np.asarray(base, "i8"), in_a.shape)
    a, b = a.astype("i8"), b.astype("i8")
    at_a, at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    size = in_a * in_b
    big = np.flatnonzero(size > most)
    small = np.flatnonzero(size <= most)
    codes, times = [], []
    rounds = np.cumsum(size[small]) // most
    for part in np.split(small, np.flatnonzero(np.diff(rounds)) + 1) if len(small) else []:
        k = _ranges(size[part])
        wide = np.repeat(in_b[part], size[part])
        pair = a[np.repeat(at_a[part], size[part]) + k // wide] * n_b + b[np.repeat(at_b[part], size[part]) + k % wide]
        pair += np.repeat(base[part], size[part])
        found = np.unique(pair, return_counts=True)
        codes.append(found[0])
        times.append(found[1])
    for g in big.tolist():
        ua, ca = np.unique(a[at_a[g] : at_a[g] + in_a[g]], return_counts=True)
        ub, cb = np.unique(b[at_b[g] : at_b[g] + in_b[g]], return_counts=True)
        codes.append((ua[:, None] * n_b + ub).ravel() + base[g])
        times.append((ca[:, None] * cb).ravel())
    if len(codes) < 2:
        return (codes[0], times[0]) if codes else (np.empty(0, "i8"), np.empty(0, "i8"))
    every, back = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(every), "i8")
    np.add.at(total, back, np.concatenate(times))
    return every, total


def _shown(ids_a, ids_b, in_a, in_b, shown: list[str]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3``: tokens in order, group by group, each with the mark behind it."""
    mark_a, mark_b = np.zeros(len(ids_a), "i8"), np.zeros(len(ids_b), "i8")
    end_a, end_b = np.cumsum(in_a), np.cumsum(in_b)
    mark_a[end_a - 1], mark_b[end_b - 1] = 1, 2
    out = np.empty(len(ids_a) + len(ids_b), "i8")
    out[np.arange(len(ids_a)) + np.repeat(end_b - in_b, in_a)] = ids_a.astype("i8") * 3 + mark_a
    out[np.arange(len(ids_b)) + np.repeat(end_a, in_b)] = ids_b.astype("i8") * 3 + mark_b
    return list(map(shown.__getitem__, out.tolist()))


def _packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Codes in order as steps of 4 bytes where all fit (else 8), and counts of 1 byte (else 8)."""
    step = np.diff(codes, prepend=0)
    wide, many = "<i8" if len(step) and step.max() >= 1 << 32 else "<u4", "<i8" if len(times) and times.max() > 255 else "u1"
    head = np.array([len(codes), wide == "<i8", many == "<i8"], "<i4")
    return head.tobytes() + step.astype(wide).tobytes() + times.astype(many).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, many = np.frombuffer(data, "<i4", 3).tolist()
    end = 12 + n * (8 if wide else 4)
    codes = np.cumsum(np.frombuffer(data[12:end], "<i8" if wide else "<u4").astype("i8"))
    return codes, np.frombuffer(data[end:], "<i8" if many else "u1").astype("i8")


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(path_a: str, path_b: str, out: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = coders(path_a, path_b)
    span = both.n_a * both.n_b
    for batch in slices(batches, 1, 1 << 19):
        sides = both.ids([(data or b"").decode("utf-8", "replace") for data in batch.column(1).to_pylist()])
        a, b = (np.frombuffer(b"".join(side), "<i4") for side in zip(*sides, strict=True))
        n_a, n_b = (np.array([len(s[i]) // 4 for s in sides]) for i in (0, 1))
        # the texts stand one after the other, so that one bisection serves them all
        last_a, some = np.cumsum(n_a), n_a > 0
        ends_a, ends_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
        cuts = shared_cuts(ends_a, ends_b, (last_a - n_a)[some], last_a[some]) if len(a) else np.empty(0, "i8")
        cuts_b = np.searchsorted(ends_b, ends_a[cuts])
        in_a, in_b = np.diff(cuts, prepend=-1), np.diff(cuts_b, prepend=-1)
        to = np.searchsorted(cuts, last_a)  # groups up to each text's end
        begin = np.append(0, to[:-1])
        pairs, times = links(a, b, in_a, in_b, both.n_b, np.repeat(np.arange(len(to)), to - begin) * span)
        spots = np.searchsorted(pairs, np.arange(len(to) + 1) * span)
        n_links = np.diff(np.append(0, np.cumsum(in_a * in_b))[np.append(0, to)])
        shown = _shown(a, b, in_a, in_b, both.shown)
        ends = np.cumsum(n_a + n_b)
        groups = ["".join(shown[x - n : x])[:-1] for x, n in zip(ends.tolist(), (n_a + n_b).tolist(), strict=True)]
        packed = [_packed(pairs[x:y] - i * span, times[x:y]) for i, (x, y) in enumerate(zip(spots[:-1].tolist(), spots[1:].tolist(), strict=True))]
        columns = [*(pa.array(n.astype("i8")) for n in (n_a, n_b, to - begin, n_links)), pa.array(groups, pa.string()), pa.array(packed, pa.binary())]
        columns = [c.cast(t.type) for c, t in zip(columns, list(out)[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=out)


def align(documents: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``documents`` with ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``groups``
    (``a1,a2|b1;a3|b2,b3``: ids of both sides in order) and ``links`` (packed, for :func:`scored`).

    ``path_a`` is a byte-level BPE file, which encodes a space and the text, ``path_b`` a model
    that adds the space itself. Defined results: texts that are null or empty, or that either
    side does not stand for byte by byte, have no tokens: zeros and empty ``groups``; repeated
    rows stay, each a document of its own; very long texts are aligned whole; an empty table
    gives no rows; columns of the input named like the new ones are replaced. Nothing is shuffled.
    """
    new = [*_COUNTS, "groups", "links"]
    own = [c for c in documents.columns if c not in new]
    rows = documents.select(F.struct(*own).alias("row"), F.col(text).cast("binary").alias("data"))
    schema = StructType([rows.schema.fields[0]])
    for name in _COUNTS:
        schema = schema.add(name, LongType())
    schema = schema.add("groups", StringType()).add("links", BinaryType())
    work = partial(_aligned, path_a, path_b, to_arrow_schema(schema))
    return rows.mapInArrow(work, schema).select("row.*", *new)


def _counted(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of documents, summed over stretches of ``most`` links."""
    codes, total, waiting = np.empty(0, "i8"), np.empty(0, "i8"), []

    def merged():
        every, back = np.unique(np.concatenate([codes, *waiting]), return_inverse=True)
        count = np.zeros(len(every), "i8")
        np.add.at(count, back, np.concatenate([total, np.ones(len(back) - len(codes), "i8")]))
        return every, count

    held = 0
    for batch in batches:
        for data in batch.column(0).to_pylist():
            waiting.append(_unpacked(data)[0])
            held += len(waiting[-1])
            if held > most:
                (codes, total), waiting, held = merged(), [], 0
                if len(codes) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(total)], ["code", "n"])
                    codes, total = np.empty(0, "i8"), np.empty(0, "i8")
    if waiting:
        codes, total = merged()
    for at in range(0, len(codes), 1 << 17):
        part = slice(at, at + (1 << 17))
        yield pa.RecordBatch.from_arrays([pa.array(codes[part]), pa.array(total[part])], ["code", "n"])


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``code`` (the id of A times ``n_b`` plus the id of B), ``n`` (documents that hold the pair
    linked) and ``best`` (whether no pair of its A id has more)."""
    counts = aligned.select("links").mapInArrow(partial(_counted, 1 << 21), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stored(counts, "align-pairs").withColumn("a", F.floor(F.col("code") / n_b))
    top = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stored(counts.join(top, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "align-counts")


def _looked_up(codes: np.ndarray, n: np.ndarray, best: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of common pairs, and the other links by themselves."""
    for batch in batches:
        sums, rest = [], []
        for data in batch.column(1).to_pylist():
            code, times = _unpacked(data)
            spot = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            hit = codes[spot] == code if len(codes) else np.zeros(len(code), bool)
            sums.append((int(times[hit][best[spot[hit]]].sum()), int((times[hit] * n[spot[hit]]).sum())))
            rest.append((code[~hit], times[~hit]))
        if not sums:
            continue
        offsets = pa.array(np.cumsum([0, *(len(c) for c, _ in rest)]).astype("i4"))
        pair = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rest, strict=True)], ["code", "times"])
        found = [pa.array(x, pa.int64()) for x in zip(*sums, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *found, pa.ListArray.from_arrays(offsets, pair)], ["at", "n_best", "count_sum", "rest"])


def scored(aligned: DataFrame, n_b: int, hot: int = 200_000) -> DataFrame:
    """``aligned`` without ``links``, with ``n_best`` (links whose pair no other pair of its A id
    exceeds in documents) and ``count_sum`` (the documents of its pairs, summed over links)."""
    own = [c for c in aligned.columns if c not in ("links", "n_best", "count_sum")]
    rows = stored(aligned.select(F.struct(*own).alias("row"), "links", F.monotonically_increasing_id().alias("at")), "align-rows")
    counts = pair_counts(rows, n_b)
    # pairs by powers of two of their documents: a few rows that tell from where on they are common
    found = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("pairs")).collect()
    least, held = 63, 0
    for power, pairs in sorted(found, reverse=True):
        held += pairs
        if held > hot:
            break
        least = power
    common = counts.where(F.floor(F.log2("n")) >= least).toArrow()
    codes = common["code"].to_numpy()
    order = np.argsort(codes)
    look = partial(_looked_up, codes[order], common["n"].to_numpy()[order], common["best"].to_numpy()[order])
    kind = "at long, n_best long, count_sum long, rest array<struct<code: long, times: long>>"
    sums = stored(rows.select("at", "links").mapInArrow(look, kind), "align-sums")
    single = sums.select("at", F.explode("rest").alias("one")).select("at", "one.code", "one.times")
    more = single.join(counts, "code").groupBy("at").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    both = sums.drop("rest").join(more, "at", "left").select(
        "at",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
    return rows.select("at", "row").join(both, "at").select("row.*", "n_best", "count_sum")
