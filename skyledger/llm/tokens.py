"""Token counts of whole texts, with huge ones encoded in overlapping chunks.

The vocabulary drops white space before pairs are merged, so no token spans an ASCII white space
character and what stands between two of them is encoded alike wherever it is. The counts of such
words are the tokenizer's own and are remembered (a bounded table per Python worker); plain Latin
words go to its merge model directly, all others through its whole chain.

A huge text is cut into chunks that overlap. Each chunk is encoded with offsets by itself; at its
ends it may be wrong. Two neighbours are spliced at a common boundary in their overlap that is
proven stable: both have a token edge there, and white space stands there in the text. If the
overlap holds none, it is widened until it does or until both chunks are one.
"""

import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType
from tokenizers import Tokenizer

from skyledger.llm.arrows import kept
from skyledger.llm.hashing import unused

_WHITE = " \t\n\r\x0b\x0c"
_WORDS = re.compile(f"[^{_WHITE}]+")
# Words of printable ASCII and composed Latin letters: normalization only lowers them.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The pieces into which the vocabulary's rule parts lower-case words of that kind.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_BYTES = {b: _HIDDEN.get(b, chr(b)) for b in range(256)}


class Counter:
    """Counts tokens as the tokenizer of a file does, without added special tokens."""

    def __init__(self, path: str, chunk: int = 1 << 12, overlap: int = 1 << 7, remembered: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap, self.remembered = chunk, overlap, remembered
        self.merge = self.tokenizer.model.tokenize
        self.plain = self._is_word_bpe()
        self.known: dict[str, int] = {}
        self.resyncs = self.widened = 0

    def _is_word_bpe(self) -> bool:
        """Whether the file has the rules that the short way for plain words stands for."""
        kinds = json.loads(self.tokenizer.to_str())
        split = ((kinds["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        chain = [n["type"] for n in (kinds["normalizer"] or {}).get("normalizers", [])]
        special = all(t["content"].startswith("<|") for t in kinds["added_tokens"])
        return chain == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and special

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > self.remembered:
            self.known.clear()  # before what this text needs is added, so all of it stays
        new = []
        for word in words:
            if word not in self.known:
                if self.plain and _PLAIN.fullmatch(word) and "<|" not in word:
                    pieces = _PIECES.findall(word.lower())
                    self.known[word] = sum(len(self.merge(p.encode().decode("latin-1").translate(_BYTES))) for p in pieces)
                else:
                    new.append(word)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update(zip(part, (len(e.ids) for e in found), strict=True))

    def count(self, text: str) -> int:
        if not self.plain:  # no proof that white space parts tokens: the whole text as one
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(text) > self.chunk:
            return self._spliced(text)
        words = _WORDS.findall(text)
        try:
            return sum(map(self.known.__getitem__, words))
        except KeyError:
            self._learn(set(words))
            return sum(map(self.known.__getitem__, words))

    def edges(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """Offsets in ``text[start:end]`` of its tokens, encoded by itself."""
        return self.tokenizer.encode(text[start:end], add_special_tokens=False).offsets

    def _spliced(self, text: str) -> int:
        """Tokens of a huge text. A cut is a white space character in the overlap at which no
        token of either chunk lies; tokens before it count from the left chunk, those after it
        from the right one."""
        total, start, floor, n = 0, 0, 0, len(text)  # ``floor``: the last cut
        end = min(self.chunk, n)
        left, done = self.edges(text, start, end), 0  # ``done``: tokens of it that the chunk before has
        while end < n:
            width, cut = self.overlap, None
            while cut is None:
                begin = max(floor, end - width)
                stop = min(n, end + self.chunk)
                right = self.edges(text, begin, stop)
                cut = self._stable(text, left, start, right, begin, end)
                if cut is None:
                    self.widened += 1
                    if begin == floor:  # nothing stable since the last cut: encode both as one from there
                        left, start, done = self.edges(text, floor, stop), floor, 0
                        end, width = stop, self.overlap
                        if end == n:
                            return total + len(left)
                        continue
                    width *= 2
            self.resyncs += 1
            total += bisect_left(left, (cut - start,)) - done
            left, start, floor, end = right, begin, cut, stop
            done = bisect_left(left, (cut - start,))
        return total + len(left) - done

    @staticmethod
    def _stable(text: str, left: list, start: int, right: list, begin: int, end: int) -> int | None:
        """A white space character strictly inside both chunks with the same tokens after it up
        to the next one, as both encode them; the one nearest the middle of the overlap."""

        def near(tokens, first, spot, after):
            """Tokens that reach over ``spot`` or lie between it and ``after``, as places of the text."""
            at = bisect_left(tokens, (spot - first,))
            back = [t for t in tokens[max(at - 8, 0) : at] if t[1] > spot - first]
            return back, [(first + a, first + b) for a, b in tokens[at : bisect_left(tokens, (after - first,))]]

        middle = (begin + end) // 2
        spots = [begin + m.start() for m in re.finditer(f"[{_WHITE}]", text[begin:end])]
        spots = [s for s in spots if begin < s < end - 1]
        for spot in sorted(spots, key=lambda s: abs(s - middle))[:8]:
            after = next((s for s in spots if s > spot), None)
            if after is not None:
                (over, own), (across, theirs) = near(left, start, spot, after), near(right, begin, spot, after)
                if not over and not across and own == theirs:
                    return spot
        return None


def counter(path: str, **chunks) -> Counter:
    """One counter per Python worker and settings, kept for the worker's next tasks."""
    return kept("token counter", (path, *sorted(chunks.items())), lambda: Counter(path, **chunks))


def count_tokens(documents: DataFrame, tokenizer_path: str, limit: int = 2048, text: str = "text", **chunks) -> DataFrame:
    """``documents`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Defined results: null text counts as empty (0 and 0); strings of special tokens inside texts
    are handled as the tokenizer does by default; a file whose rules are not those of words with white
    space dropped is used on whole texts, huge ones too; repeated rows stay; an empty table gives no
    rows; columns of the input named like the new ones are replaced. ``tokenizer_path`` must be
    readable on every executor. Nothing is shuffled.
    """
    new = ["n_bytes", "n_tokens", "over_limit"]
    own = [c for c in documents.columns if c not in new]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path, **chunks)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            counts, sizes = [], []
            for value in texts:
                s = value.as_py() or ""
                counts.append(own.count(s))
                sizes.append(len(s.encode("utf-8", "surrogatepass")))
            columns = [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    rows = documents.select(*own, F.col(text).alias(unused("text", documents)))
    schema = StructType(list(rows.schema.fields[:-1])).add("n_bytes", LongType()).add("n_tokens", LongType())
    out = to_arrow_schema(schema)
    return rows.mapInArrow(tasks, schema).withColumn("over_limit", F.col("n_tokens") > limit).select(*own, *new)
