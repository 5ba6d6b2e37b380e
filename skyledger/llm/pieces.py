"""SentencePiece encoding and decoding by a table of each prefix's last token.

The library merges, again and again, the adjacent pair whose concatenation has the best score, the
leftmost of equals. Seen through two neighbouring tokens only, that process is the one which
encodes the two by themselves. So a sequence of tokens is the encoding of its text exactly if
every two neighbours, encoded by themselves, come out as these two (they *fit*), and every prefix
of a text has one last token. From left to right an automaton over all pieces finds the tokens
that end at a place; the one that fits the last token of the prefix before it is stored. The ids
are read off the table backwards. Work and memory grow with the text, whatever it holds.

Characters outside the vocabulary never merge and become their bytes. Where no piece holds a word
start behind another character, words are encoded one by one, which gives the same ids: a Python
worker keeps a bounded number of them.
"""

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from skyledger.llm.arrows import kept, slices

START = "▁"
_LONGEST_KEPT = 64


class Pieces:
    """Encodes and decodes as the library does with a BPE model with byte fallback and without
    normalization. Other models are refused."""

    def __init__(self, path: str, kept: int = 400_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        bytes_of = {int(names[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {names[i]: model.get_score(i) for i in plain}
        self.ids = {names[i]: i for i in plain}
        self.names, self.size, self.kept = names, [len(s) for s in names], kept
        letters = {c for s in self.ids for c in s}
        probe = "a  ﬁ é "
        if model.normalize(probe) != START + probe.replace(" ", START):
            raise ValueError("the model normalizes texts")
        if len(bytes_of) != 256 or any(len(s) > 1 and v != int(v) for s, v in self.score.items()) or letters - set(self.ids):
            raise ValueError("not a BPE model with byte fallback")
        self.byte_ids = np.array([bytes_of[b] for b in range(256)], "<i4")
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        known = "".join(map(re.escape, sorted(letters - {START})))
        apart = not any(START in s.lstrip(START) for s in self.ids)
        self.parts = re.compile(f"{START}*[{known}]+|{START}+|[^{known}{START}]" if apart else f"[{known}{START}]+|[^{known}{START}]")
        # what an id stands for when it is decoded
        self.raw = [names[i].replace(START, " ").encode() for i in range(n)]
        for i in range(n):
            if model.is_control(i):
                self.raw[i] = b""
            elif model.is_unknown(i):
                self.raw[i] = model.decode([i]).encode()
        for b, i in bytes_of.items():
            self.raw[i] = bytes([b])
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte_ids] = True
        self.starts = [names[i].startswith(START) for i in range(n)]
        self.silent = {i for i in range(n) if model.is_control(i)}
        self._fits: dict[int, bool] = {}
        self._steps: dict[int, tuple] = {}
        self._known: dict[str, bytes] = {}

    def merges(self, token: int) -> tuple[list, list, list, bool]:
        """How a piece comes about from its characters: the score of each merge in order, the first
        and the last symbol before each merge and after all, and whether one symbol is left."""
        if token not in self._steps:
            now, scores = list(self.names[token]), []
            first, last = [now[0]], [now[-1]]
            while True:
                found = [(s, -i) for i in range(len(now) - 1) if (s := self.score.get(now[i] + now[i + 1])) is not None]
                if not found:
                    break
                best, at = max(found)
                now[-at : 2 - at] = [now[-at] + now[1 - at]]
                scores.append(best)
                first.append(now[0])
                last.append(now[-1])
            self._steps[token] = scores, first, last, len(now) == 1
        return self._steps[token]

    def fit(self, left: int, right: int) -> bool:
        """Whether the text of both tokens is encoded as just these two; with -1 for ``left``,
        whether the token's own text is encoded as the token."""
        scores, first, _, whole = self.merges(right)
        if left < 0 or not whole:
            return whole
        before, _, last, _ = self.merges(left)
        i = j = 0
        while True:
            here = self.score.get(last[i] + first[j])
            own = before[i] if i < len(before) else None
            other = scores[j] if j < len(scores) else None
            if here is not None and (own is None or here > own) and (other is None or here >= other):
                return False
            if own is None and other is None:
                return True
            if other is None or (own is not None and own >= other):
                i += 1
            else:
                j += 1

    def table(self, part: str) -> list[int]:
        """The last token of the first 0, 1, ... characters of a text of known characters."""
        last = [-1] * (len(part) + 1)
        size, fits, n = self.size, self._fits, len(self.names)
        for end, token in self.automaton.iter(part):
            if last[end + 1] < 0:
                left = last[end + 1 - size[token]]
                key = left * n + token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) > 2_000_000:
                        fits.clear()
                    ok = fits[key] = self.fit(left, token)
                if ok:
                    last[end + 1] = token
        return last

    def _encoded(self, part: str) -> bytes:
        if part[0] not in self.ids:
            return self.byte_ids[np.frombuffer(part.encode("utf-8", "surrogatepass"), "u1")].tobytes()
        last, out, at = self.table(part), [], len(part)
        while at:
            out.append(last[at])
            at -= self.size[last[at]]
        return np.array(out[::-1], "<i4").tobytes()

    def packed(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        if not text:
            return b""
        parts = self.parts.findall(START + text.replace(" ", START))
        known = self._known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            pass
        out = []
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = self._encoded(part)
                if len(part) <= _LONGEST_KEPT:
                    if len(known) >= self.kept:
                        known.clear()
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: one space at the start is that which encoding added, ids of bytes
        are read as UTF-8, and bytes that are none become U+FFFD one by one."""
        listed = ids.tolist()
        first = next((i for i, token in enumerate(listed) if token not in self.silent), len(listed))
        head = self.raw[listed[first]][1:] if first < len(listed) and self.starts[listed[first]] else None
        if head is not None:
            first += 1
        rest = listed[first:]
        if self.silent.isdisjoint(rest):  # such an id would part the bytes of a character
            try:
                return ((head or b"") + b"".join(map(self.raw.__getitem__, rest))).decode()
            except UnicodeDecodeError:
                pass
        return (head or b"").decode() + self._decoded_apart(rest)

    def _decoded_apart(self, listed: list[int]) -> str:
        """Runs of byte ids by themselves, as no character spans a run's end."""
        out, at = [], 0
        while at < len(listed):
            end = at
            while end < len(listed) and self.is_byte[listed[end]]:
                end += 1
            if end == at:
                out.append(self.raw[listed[at]].decode())
                at += 1
                continue
            data, at = b"".join(self.raw[i] for i in listed[at:end]), end
            spot = 0
            while spot < len(data):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(data[spot : spot + width].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    width = 1
                    out.append("�")
                spot += width
        return "".join(out)


def pieces(path: str) -> Pieces:
    """One for each Python worker and file."""
    return kept("pieces", path, lambda: Pieces(path))


def encode_texts(documents: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``documents`` with ``ids`` (``array<int>``, without begin or end) and ``decoded``, the text
    that the library's decoding gives for them.

    Defined results: null text counts as empty and has no ids and an empty ``decoded``; bytes that
    are no UTF-8 are read as U+FFFD; very long texts are encoded whole, in memory that grows with
    the text; repeated rows stay, each with its ids; an empty table gives no rows; columns of the
    input named like the new ones are replaced. ``model_path`` must be readable on every
    executor. Nothing is shuffled.
    """
    new = ["ids", "decoded"]
    own = [c for c in documents.columns if c not in new]
    rows = documents.select(F.struct(*own).alias("row"), F.col(text).cast("binary").alias("data"))
    schema = StructType([rows.schema.fields[0]]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    out = to_arrow_schema(schema)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model_path)
        for batch in slices(batches, 1):
            packed = [coder.packed(data.decode("utf-8", "replace")) if data else b"" for data in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype("i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            decoded = pa.array([coder.decode(np.frombuffer(p, "<i4")) for p in packed], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids.cast(out.field("ids").type), decoded], schema=out)

    return rows.mapInArrow(tasks, schema).select("row.*", *new)
