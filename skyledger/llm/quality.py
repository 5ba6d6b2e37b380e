"""A quality classifier learned without labels of its own.

Overlapping heuristics vote good, bad or nothing on each document. Expectation-maximisation
estimates from their agreement alone how often each of them is right in either class, and with
that the probability that a document is good for every pattern of votes. These posteriors train a
hashed linear scorer, which then judges every document by its words and their shapes.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.hashing import U, mix, word_hashes, word_spans

NAMES = ["case", "symbols", "digits", "variety", "repeats", "marks", "length", "words", "sentences"]


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a : b + 1] = True
    return out


_CAPITAL, _DIGIT, _HIGH = _bytes((65, 90)), _bytes((48, 57)), _bytes((128, 255))
_LETTER = _CAPITAL | _bytes((97, 122)) | _HIGH
_BLANK = _bytes((9, 13), (32, 32))
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK) & ~_bytes((44, 44), (46, 46))
_MARK = np.zeros(256, bool)
_MARK[list(b"|#*=~_")] = True


def votes(text: bytes, words: np.ndarray | None = None) -> list[int]:
    """A vote of each heuristic on a whole text: 1 good, 0 bad, -1 none. Each has a good and a bad
    range of one figure, and is silent between them; a text without words is bad to all."""
    words = word_hashes(text) if words is None else words
    n = len(words)
    if not n:
        return [0] * len(NAMES)
    raw = np.frombuffer(text, "u1")
    count = np.bincount(raw, minlength=256)
    of = lambda kind: int(count[kind].sum())
    shown = len(raw) - of(_BLANK)
    doubled = int(np.count_nonzero((raw[1:] == raw[:-1]) & ((raw[1:] == 33) | (raw[1:] == 63))))
    case, symbols, digits = of(_CAPITAL) / max(of(_LETTER), 1), of(_SYMBOL) / shown, of(_DIGIT) / shown
    variety, repeats = len(np.unique(words)) / n, np.count_nonzero(words[1:] == words[:-1]) / n
    marks, length, stops = (doubled + of(_MARK)) / n, shown / n, count[46] / n
    ranges = [
        (case < 0.12, case > 0.3),
        (symbols < 0.02, symbols > 0.06),
        (digits < 0.02, digits > 0.08),
        (variety > 0.25, n > 12 and variety < 0.3),
        (repeats < 0.05, repeats > 0.15),
        (marks < 0.02, marks > 0.1),
        (n >= 40, n < 15),
        (4 < length < 9, length < 3 or length > 14),
        (0.02 < stops < 0.3, stops > 0.5),
    ]
    return [0 if bad else 1 if good else -1 for good, bad in ranges]


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> dict:
    """Expectation-maximisation over vote patterns (rows; 1, 0, -1) with their counts.

    Returns ``prior`` of good, ``accuracy`` (labeller by class: how often a vote there is right)
    and the ``posterior`` of good of each pattern. Starts from the majority, which also fixes
    which class is called good."""
    good, bad = (patterns == 1).astype(float), (patterns == 0).astype(float)
    post = (good.sum(1) + 1) / (good.sum(1) + 2 * bad.sum(1) + 2)  # a bad vote counts twice
    for _ in range(rounds):
        w1, w0 = counts * post, counts * (1 - post)
        prior = np.clip(w1.sum() / counts.sum(), 0.02, 0.98)
        right1 = (w1 @ good + 1) / (w1 @ (good + bad) + 2)  # vote good given good
        right0 = (w0 @ bad + 1) / (w0 @ (good + bad) + 2)  # vote bad given bad
        ratio = np.log(prior / (1 - prior)) + good @ np.log(right1 / (1 - right0)) + bad @ np.log((1 - right1) / right0)
        new = 1 / (1 + np.exp(-np.clip(ratio, -50, 50)))
        done, post = np.abs(new - post).max() < 1e-7, new
        if done:
            break
    return {"prior": float(prior), "accuracy": np.stack([right1, right0], 1), "posterior": post}


def features(text: bytes, bits: int, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word shapes of a whole text: buckets and their shares."""
    words = word_hashes(text) if words is None else words
    if not len(words):
        return np.empty(0, "i8"), np.empty(0)
    raw = np.frombuffer(text, "u1")
    starts, ends = word_spans(raw)
    kinds = [(raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57), (raw < 128) & ~((raw | 32 >= 97) & (raw | 32 <= 122)) & (raw > 32)]
    shape = np.minimum(ends - starts, 15).astype(U)
    for kind in kinds:  # none, some, most of the word
        share = np.add.reduceat(kind.astype("i4"), starts) / np.maximum(ends - starts, 1)
        shape = shape * U(3) + np.where(share > 0.5, 2, share > 0).astype(U)
    same = np.append(False, words[1:] == words[:-1]).astype(U)
    hashed = np.concatenate([words, mix(shape + U(1 << 20)), mix(same + U(1 << 21))])
    buckets, n = np.unique((hashed >> U(64 - bits)).astype("i8"), return_counts=True)
    return buckets, n / len(words)


@dataclass
class Scorer:
    """A linear model over hashed features."""

    bits: int = 15
    bias: float = 0.0
    weights: np.ndarray = field(default=None)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], goal: np.ndarray, epochs: int = 30, rate: float = 0.5, decay: float = 1e-6):
        """Adaptive gradient steps, row by row, towards the soft labels; both classes weigh alike."""
        self.weights, g2, b2 = np.zeros(1 << self.bits), np.full(1 << self.bits, 1e-3), 1e-3
        rng, share = np.random.default_rng(1), np.clip(goal.mean(), 0.05, 0.95)
        weigh = goal * 0.5 / share + (1 - goal) * 0.5 / (1 - share)
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                at, x = rows[i]
                err = weigh[i] * (1 / (1 + np.exp(-np.clip(self.bias + self.weights[at] @ x, -30, 30))) - goal[i])
                g = err * x + decay * self.weights[at]
                g2[at] += g * g
                self.weights[at] -= rate * g / np.sqrt(g2[at])
                b2 += err * err
                self.bias -= rate * err / np.sqrt(b2)
        return self

    def score(self, text: bytes, words: np.ndarray | None = None) -> float:
        at, x = features(text, self.bits, words)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at] @ x, -30, 30)))) if len(at) else 0.0


def classify(documents: DataFrame, id_col: str = "doc_id", sample: int = 3000, threshold: float = 0.5) -> DataFrame:
    """``documents`` with ``weak_label`` (posterior of its votes), ``quality`` (0 to 1) and ``keep``.

    Vote patterns are counted over all documents; at most 3 ** 9 of them reach the driver. The
    scorer learns from at most ``sample`` documents, those of smallest MD5 of the id. Defined
    results: null text or text without words has quality 0; repeated rows score alike; an empty
    table gives no rows; columns of the input named like the new ones are replaced.
    """
    new = ["weak_label", "quality", "keep"]
    own = [c for c in documents.columns if c not in new]
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    pattern = lambda text, words=None: ",".join(map(str, votes(text, words)))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pattern(t) for t in batch.column(0).to_pylist()], pa.string())], ["pattern"])

    counts = documents.select(data.alias("data")).mapInArrow(voted, "pattern string").groupBy("pattern").count()
    counted = sorted((r["pattern"], r["count"]) for r in counts.collect())
    if not counted:
        return documents.select(*own, F.lit(0.0).alias("weak_label"), F.lit(0.0).alias("quality"), F.lit(False).alias("keep"))
    patterns = np.array([[int(v) for v in p.split(",")] for p, _ in counted])
    model = fit_labellers(patterns, np.array([n for _, n in counted], float))
    posterior = {p: float(x) for (p, _), x in zip(counted, model["posterior"], strict=True)}
    bits = Scorer().bits

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        for batch in batches:
            rows = [(pattern(t), *features(t, bits)) for t in batch.column(0).to_pylist()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["pattern", "at", "x"])

    ids = documents.select(F.col(id_col).alias("id"), data.alias("data"))
    order = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))

    def smallest(some: DataFrame) -> list:
        some = some.orderBy(order, "data").limit(sample).select("data")
        return some.mapInArrow(hashed, "pattern string, at array<long>, x array<double>").collect()

    # about twice the sample lies below this share of all MD5 sums, and the sample is the smallest
    # of those; where repeated ids leave fewer there, it is chosen from all rows
    share = 2 * sample / sum(n for _, n in counted)
    learned = smallest(ids.where(order < f"{int(share * 16**8):08x}")) if share < 1 else []
    if len(learned) < sample:
        learned = smallest(ids)
    rows = [(np.array(r["at"], "i8"), np.array(r["x"])) for r in learned]
    scorer = Scorer().fit(rows, np.array([posterior[r["pattern"]] for r in learned]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weak, quality = [], []
            for text in batch.column(1).to_pylist():
                words = word_hashes(text)
                weak.append(posterior[pattern(text, words)])
                quality.append(scorer.score(text, words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weak, pa.float64()), pa.array(quality, pa.float64())], ["row", *new[:2]])

    rows = documents.select(F.struct(*own).alias("row"), data.alias("data"))
    out = rows.mapInArrow(scored, f"row {rows.schema['row'].dataType.simpleString()}, weak_label double, quality double")
    return out.select("row.*", "weak_label", "quality", (F.col("quality") >= threshold).alias("keep"))
