"""Hashes of bytes, words and runs of words as whole numpy arrays."""

import numpy as np
from pyspark.sql import DataFrame

U = np.uint64
_A, _B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits; one to one."""
    x = x ^ (x >> U(32))
    x *= _B
    x ^= x >> U(32)
    x *= _B
    x ^= x >> U(32)
    return x


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores in front as make it no column of the frames."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


_ODD: dict[tuple[int, int], np.ndarray] = {}


def odd(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    if (n, seed) not in _ODD:
        _ODD[n, seed] = mix(np.arange(1, n + 1, dtype=U) * _A + U(seed)) | U(1)
    return _ODD[n, seed]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32
_PLACE = odd(4096, 11)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and 0x09 to 0x0D."""
    inside = np.zeros(len(raw) + 2, "i1")
    inside[1:-1] = ~_SPACE[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lowered: a sum of byte times the multiplier of its place,
    places beyond the table being mixed block by block."""
    raw = _LOWER[np.frombuffer(text, "u1")]
    starts, ends = word_spans(raw)
    if not len(starts):
        return np.empty(0, U)
    # places count from the start of the word and run on over the white space behind it
    place = np.arange(len(raw))
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(raw))))
    term = (raw.astype(U) + U(1)) * _PLACE[place & 4095]
    far = place >= 4096
    if far.any():
        term[far] = mix(term[far] + (place[far] >> 12).astype(U) * _A)
    term[_SPACE[raw]] = 0
    return mix(np.add.reduceat(term, starts) + (ends - starts).astype(U) * _A)


def shingle_set(text: bytes | None, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``width`` words; with fewer words, of all of them
    as one; none without words."""
    words = word_hashes(text) if text else np.empty(0, U)
    n = len(words)
    if not n:
        return words
    w = min(width, n)
    ways = odd(width, 23)
    total = words[: n - w + 1] * ways[0]
    for j in range(1, w):
        total = total + words[j : n - w + 1 + j] * ways[j]
    return np.unique(mix(total + U(w)))
