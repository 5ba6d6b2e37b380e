"""Language identification by a bidirectional gated recurrent network over bytes.

Text is cut into segments of fixed length. A forward and a backward GRU read each segment, every
position gets a probability for each language from both states, and a document's probabilities
are the mean over all its positions. The network is small and trained here, in numpy, by
backpropagation through time on a bounded sample of labelled rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAD = 256  # its input is never counted


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the network's bounded function, a few times cheaper than exponentials."""
    d = np.abs(x)
    d += 1.0
    return np.divide(x, d, d)


def _slope(y: np.ndarray) -> np.ndarray:
    """The slope of :func:`squash` where it gives ``y``."""
    return (1.0 - np.abs(y)) ** 2


class Gru:
    """One direction. For each gate a table with the input part of each byte, and a matrix for the
    state; gates are (1 + squash) / 2."""

    def __init__(self, hidden: int, rng):
        self.h, self.p = hidden, {}
        for gate in "zrn":
            self.p["t" + gate] = rng.normal(0, 0.3, (PAD + 1, hidden)).astype("f4")
            self.p["u" + gate] = (rng.normal(0, 1, (hidden, hidden)) / np.sqrt(hidden)).astype("f4")

    def run(self, steps: np.ndarray, keep: bool = False):
        """``steps``: bytes, time by row. States after each step; with ``keep`` also what the way
        back needs."""
        p, h = self.p, np.zeros((steps.shape[1], self.h), "f4")
        states, tape = np.empty((*steps.shape, self.h), "f4"), []
        for t, codes in enumerate(steps):
            z = h @ p["uz"]
            z += p["tz"].take(codes, 0)
            z = squash(z)
            r = h @ p["ur"]
            r += p["tr"].take(codes, 0)
            r = squash(r)
            a = h @ p["un"]
            m = a * (r * np.float32(0.5) + np.float32(0.5))
            m += p["tn"].take(codes, 0)
            m = squash(m)
            new = m + (z * np.float32(0.5) + np.float32(0.5)) * (h - m)
            if keep:
                tape.append((codes, h, z, r, m, a))
            states[t] = h = new
        return states, tape

    def back(self, tape, grads):
        """Gradients of the parameters from those of the states: backpropagation through time."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        dh = np.zeros_like(grads[0])
        for t in range(len(tape) - 1, -1, -1):
            codes, h, z, r, m, a = tape[t]
            dh = dh + grads[t]
            gate_z, gate_r = (z + 1) / 2, (r + 1) / 2
            dn = dh * (1 - gate_z) * _slope(m)
            dz = dh * (h - m) / 2 * _slope(z)
            dr = dn * a / 2 * _slope(r)
            dh = dh * gate_z
            for gate, d, du in (("z", dz, dz), ("r", dr, dr), ("n", dn, dn * gate_r)):
                np.add.at(g["t" + gate], codes, d)
                g["u" + gate] += h.T @ du
                dh += du @ p["u" + gate].T
        return g


class Tagger:
    """Both directions and the output layer: a probability of each language at each position."""

    def __init__(self, langs: list[str], hidden: int = 8, segment: int = 64, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs, self.segment, self.hidden = langs, segment, hidden
        self.forward, self.backward = Gru(hidden, rng), Gru(hidden, rng)
        self.out = {"w": rng.normal(0, 0.3, (2 * hidden, len(langs))).astype("f4"), "b": np.zeros(len(langs), "f4")}

    def positions(self, steps: np.ndarray, keep: bool = False):
        """Probabilities, language by time by row, with what training needs."""
        ahead, tape = self.forward.run(steps, keep)
        behind, back_tape = self.backward.run(steps[::-1], keep)
        behind, n = behind[::-1], self.hidden
        logits = ahead.reshape(-1, n) @ self.out["w"][:n]
        logits += (behind @ self.out["w"][n:]).reshape(logits.shape)
        logits += self.out["b"]
        prob = np.ascontiguousarray(logits.T)
        prob -= prob.max(0)
        np.exp(prob, prob)
        prob /= prob.sum(0)
        return prob.reshape(-1, *steps.shape), (ahead, behind), tape, back_tape

    def learn(self, steps: np.ndarray, labels: np.ndarray, state: dict, rate: float) -> float:
        """One step of Adam on the mean cross entropy of all positions."""
        prob, states, tape, back_tape = self.positions(steps, keep=True)
        prob, both = np.moveaxis(prob, 0, 2), np.concatenate(states, 2)
        live = (steps != PAD)[:, :, None]
        hot = np.eye(len(self.langs), dtype="f4")[labels][None]
        loss = -float(np.sum(live * hot * np.log(prob + 1e-9)) / live.sum())
        d = (prob - hot) * live / np.float32(live.sum())
        gate = d @ self.out["w"].T
        grads = [
            (self.out, {"w": np.tensordot(both, d, ([0, 1], [0, 1])), "b": d.sum((0, 1))}),
            (self.forward.p, self.forward.back(tape, gate[:, :, : self.hidden])),
            (self.backward.p, self.backward.back(back_tape, gate[::-1, :, self.hidden :])),
        ]
        state["n"] = n = state.get("n", 0) + 1
        for i, (params, g) in enumerate(grads):
            for k in params:
                m, v = state.get((i, k), (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * g[k], 0.99 * v + 0.01 * g[k] ** 2
                state[i, k] = m, v
                params[k] -= (rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)).astype("f4")
        return loss

    def segments(self, data: bytes) -> np.ndarray:
        """The bytes in rows of one segment each, padded."""
        rows = -(-len(data) // self.segment)
        out = np.full(rows * self.segment, PAD, "i2")
        out[: len(data)] = np.frombuffer(data, "u1")
        return out.reshape(rows, self.segment)

    def pooled(self, texts: list[bytes], block: int = 4096) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        sums = np.zeros((len(texts), len(self.langs)))
        held, owners, n = [], [], 0

        def flush():
            rows, own = np.concatenate(held), np.concatenate(owners)
            for at in range(0, len(rows), block):
                steps = np.ascontiguousarray(rows[at : at + block].T)
                prob, *_ = self.positions(steps)
                prob *= steps != PAD
                np.add.at(sums, own[at : at + block], prob.sum(1).T)

        for i, data in enumerate(texts):
            for at in range(0, len(data), self.segment * block):
                rows = self.segments(data[at : at + self.segment * block])
                held.append(rows)
                owners.append(np.full(len(rows), i))
                n += len(rows)
                if n >= block:
                    flush()
                    held, owners, n = [], [], 0
        if n:
            flush()
        return sums / np.maximum([[len(t)] for t in texts], 1) if texts else sums


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_sample(labelled: DataFrame, per_lang: int = 600, windows: int = 4, chars: int = 64) -> list[tuple[str, str]]:
    """``(lang, piece of text)`` for the driver: at most ``per_lang`` different texts of each
    language, those with the smallest hashes, and of each ``windows`` pieces of ``chars`` characters at
    places fixed by the hash. Every language is learned; the three numbers bound the sample of each.

    Rows are reduced to a hash and their pieces where they are scanned, and all but about three times the
    sample are left out there; a text that many rows repeat counts once, so copies neither swell the
    sample nor crowd others out of it."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("mark", F.xxhash64("text"))
    spot = F.pmod(F.xxhash64("mark"), F.lit(1 << 30))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).select("lang", (F.lit(3.0 * per_lang) / F.col("n")).alias("share"))
    place = lambda k: (F.pmod(F.xxhash64(F.lit(k), F.col("mark")), F.greatest(F.length("text") - chars, F.lit(1))) + 1).cast("int")
    pieces = F.array(*[F.substring(F.col("text"), place(k), F.lit(chars)) for k in range(windows)])
    # one row a language, of each of which the driver gets up to ``per_lang`` texts anyway; without the hint, all rows
    # are first dealt by language
    drawn = rows.join(F.broadcast(counts), "lang").where(spot < F.col("share") * (1 << 30))
    drawn = drawn.select("lang", "mark", spot.alias("spot"), F.array_distinct(pieces).alias("pieces"))
    texts = drawn.groupBy("lang", "mark", "spot").agg(F.min("pieces").alias("pieces"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("spot", "mark"))
    chosen = texts.withColumn("nth", nth).where(F.col("nth") <= per_lang)
    got = chosen.select("lang", F.explode("pieces").alias("piece")).collect()
    return sorted((r["lang"], r["piece"]) for r in got)


def train(sample: list[tuple[str, str]], steps: int = 300, batch: int = 128, rate: float = 0.02, seed: int = 5, **shape) -> Tagger:
    """A network fitted to the sample; each batch draws every language alike often."""
    langs = sorted({lang for lang, _ in sample})
    model, rng, state = Tagger(langs, seed=seed, **shape), np.random.default_rng(seed), {}
    pools = []
    for lang in langs:
        cut = [model.segments(piece.encode("utf-8", "replace")[: model.segment]) for a, piece in sample if a == lang]
        pools.append(np.concatenate([c for c in cut if len(c)]))
    for n in range(steps):
        labels = np.sort(rng.integers(0, len(langs), batch))
        rows = np.stack([pools[k][rng.integers(0, len(pools[k]))] for k in labels])
        model.learn(np.ascontiguousarray(rows.T), labels, state, rate * (1 - 0.9 * n / steps))
    return model


def predict(documents: DataFrame, model: Tagger | None) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score``; only ``text`` is looked at.

    Defined results: null text, or text without a letter, is ``und`` with score 0, as is every
    text if there was nothing to learn from; repeated rows get equal answers; an empty table gives
    no rows; columns of the input named like the new ones are replaced.
    """
    new = ["lang_pred", "score"]
    own = [c for c in documents.columns if c not in new]
    if model is None:
        return documents.select(*own, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    letters = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    rows = documents.select(F.struct(*own).alias("row"), letters.alias("data"))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model  # some 50 kB, sent with the function
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            pooled = net.pooled(texts)
            best = pooled.argmax(1)
            lang = [net.langs[k] if t else "und" for k, t in zip(best, texts, strict=True)]
            score = [min(1.0, float(p[k])) if t else 0.0 for p, k, t in zip(pooled, best, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["row", *new]
            )

    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(tasks, f"row {kind}, lang_pred string, score double")
    return out.select("row.*", *new)


def identify(documents: DataFrame, id_col: str = "doc_id", **training) -> DataFrame:
    """``documents`` with ``held_out, lang_pred, score``, learned from the rows not held out."""
    model_rows = documents.where(~held_out(F.col(id_col))).select("text", "lang")
    sample = training_sample(model_rows)
    model = train(sample, **training) if sample else None
    own = [c for c in documents.columns if c != "held_out"]
    return predict(documents.select(*own), model).withColumn("held_out", held_out(F.col(id_col)))
