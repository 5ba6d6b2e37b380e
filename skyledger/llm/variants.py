"""Spelling variants: words one inserted, deleted or replaced character apart.

Words are searched in FM-indexes of the vocabulary, written as ``#word#word#...``, by a scheme of
two searches. With one error, one half of a word is left whole. The first search matches the
first half from its delimiter on and extends to the right, the second matches the second half from
its delimiter back and extends to the left; either allows one error in the other half. An index
extends to one side only, so there is one over the words and one over the reversed words; as a
search never turns, their intervals need not be kept in step.

A word and its neighbour share a half, so a vocabulary is dealt over tasks by halves: every word
comes once as a query under each of its halves, and as a target under the halves that queries of its
length, one less and one more can have. Each task indexes its targets and searches its queries,
all in step. Halves with many targets are dealt over several tasks, and their queries go to each.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.storage import stored

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


# The query over documents as SQL: the checksum by its table, near words by what is left around each
# place, roots by following forms.
ORACLE = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)
),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL
),
bytes AS (SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
summed AS (
  SELECT run, times, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc_table
),
heard AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM summed
),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM heard WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
holes AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
gaps AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM holes),
near AS (
  SELECT g.word, o.word AS other, o.n FROM gaps g JOIN gaps o ON g.a = o.a AND g.b = o.b AND g.word <> o.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.a || g.b = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.a || g.b = w.word
),
best AS (SELECT word, count(*) AS n_near, min({'minus': -n, 'other': other}) AS top FROM near GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.minus >= 2 * n THEN top.other END AS form, CASE WHEN -top.minus >= 2 * n THEN -top.minus END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word
),
chain AS (
  SELECT word, word AS root, form AS further FROM forms
  UNION ALL
  SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.further = forms.word
)
SELECT forms.word, n, n_near, form, form_n, root FROM forms JOIN chain ON forms.word = chain.word AND further IS NULL
"""


def _words(least: int, noise: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number of occurrences, counted over stretches of ``most`` different ones."""
    total: Counter = Counter()

    def flushed():
        items = list(total.items())
        total.clear()
        for at in range(0, len(items), 1 << 16):
            word, n = zip(*items[at : at + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    for batch in batches:
        for own, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not data:
                continue
            seed = zlib.crc32(own + b":")
            found = Counter(w for w in _RUN.findall(data.decode("utf-8", "replace").translate(_LOWER)) if len(w) >= least)
            for word, n in found.items():
                h = zlib.crc32(word.encode(), seed)
                if h % noise == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < least:
                        continue
                total[word] += n
            if len(total) > most:
                yield from flushed()
    yield from flushed()


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 5, times: int = 3, noise: int = 97) -> DataFrame:
    """``word, n``: the words of ``least`` characters that occur ``times`` times over all texts.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered, of which one character is
    left out where ``noise`` divides the CRC-32 of the row's id, a colon and the run. A null id
    counts as empty."""
    own = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    rows = documents.select(own.alias("own"), F.col(text).cast("binary").alias("data"))
    counted = rows.mapInArrow(partial(_words, least, noise, 400_000), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Index:
    """An FM-index of sorted words.

    Delimiters count as different, in the words' order. The delimiter before word ``k`` then has
    row ``k``, and a search that ends in a delimiter has found words without a suffix array."""

    def __init__(self, chars: np.ndarray, ends: np.ndarray):
        """``chars``: all words' characters as codes from 1 on; ``ends``: where each word ends."""
        n = len(ends)
        self.n = n
        lengths = np.diff(ends, prepend=0)
        text = np.zeros(len(chars) + n + 1, "i8")
        place = np.arange(len(chars)) + np.repeat(np.arange(n), lengths) + 1
        text[place] = chars
        marks = np.append(0, ends + np.arange(n) + 1)
        size = len(text)
        rank = n + text  # delimiters: 0 to n in order; characters behind them
        rank[marks] = np.arange(n + 1)
        step = 1
        while True:  # suffixes in the order of their first 2, 4, 8, ... characters
            near = rank[np.minimum(np.arange(size) + step, size - 1)]
            key = rank * np.int64(size + int(text.max()) + 2) + near
            key[marks] = rank[marks]  # a delimiter is told apart from all others already
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(size, "i8")
            rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
            if rank[order[-1]] == size - 1:
                break
            step *= 2
        self.before = np.where(order > 0, text[order - 1], -1)  # the character before each suffix
        self.size = size
        self.sorted = np.sort((self.before + 1) * size + np.arange(size))

    def step(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes with ``code`` put before those of intervals [lo, hi)."""
        base, first = (code + 1) * self.size, code == 0  # nothing stands before the first delimiter
        return np.searchsorted(self.sorted, base + lo) - first, np.searchsorted(self.sorted, base + hi) - first


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner of each of ``sizes`` places, and 0, 1, ... within it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def _branches(index: Index, lo: np.ndarray, hi: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the characters (not delimiters) that stand before its suffixes: owner and
    code. Narrow intervals are read, in wide ones every character is tried."""
    narrow = hi - lo <= letters
    at = np.flatnonzero(narrow)
    owner, k = _spread((hi - lo)[at])
    owner = at[owner]
    seen = index.before[lo[owner] + k]
    pair = np.unique((owner * np.int64(letters + 1) + seen)[seen > 0])
    wide = np.flatnonzero(~narrow)
    owner = np.concatenate([pair // (letters + 1), np.repeat(wide, letters)])
    return owner, np.concatenate([pair % (letters + 1), np.tile(np.arange(1, letters + 1), len(wide))])


def search(index: Index, words: list[np.ndarray], exact: np.ndarray, itself: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Queries and the numbers of indexed words one error apart from them, the error being outside
    the last ``exact`` characters. Words are codes, read from their ends; ``letters + 1`` is a
    character that no indexed word has. ``itself``: 1 for queries that are indexed, else 0."""
    length = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    end = np.cumsum(length)
    query = np.arange(len(words))
    lo, hi = np.full(len(words), 1), np.full(len(words), index.n + 1)  # delimiters behind a word
    for t in range(int(exact.max())):
        on = np.flatnonzero((t < exact[query]) & (hi - lo > 0))
        a, b = index.step(flat[end[query[on]] - 1 - t], lo[on], hi[on])
        lo[on], hi[on] = a, b
    at = length - exact  # characters still to match
    found_q, found_k = [np.empty(0, "i8")], [np.empty(0, "i8")]
    # with an error left to make; what only one word matches is the query itself
    live = hi - lo > itself
    query, at, lo, hi = query[live], at[query][live], lo[live], hi[live]
    late = [np.empty(0, "i8")] * 4  # the error made: query, characters left, interval
    while len(query) or len(late[0]):
        made = [late]
        if len(query):
            owner, code = _branches(index, lo, hi, letters)
            a, b = index.step(code, lo[owner], hi[owner])
            own = np.where(at > 0, flat[np.maximum(end[query] - length[query] + at - 1, 0)], 0)
            inserted = [query[owner], at[owner], a, b]
            other = (at[owner] > 0) & (code != own[owner])
            replaced = [query[owner][other], at[owner][other] - 1, a[other], b[other]]
            more = at > 0
            deleted = [query[more], at[more] - 1, lo[more], hi[more]]
            a, b = index.step(own[more], lo[more], hi[more])
            stay = b - a > itself[query[more]]
            query, at, lo, hi = query[more][stay], at[more][stay] - 1, a[stay], b[stay]
            made += [inserted, replaced, deleted]
        q, left, a, b = (np.concatenate(x) for x in zip(*made, strict=True))
        some = b > a
        q, left, a, b = q[some], left[some], a[some], b[some]
        # exact to the end, a character for each round, and the delimiter last
        code = np.where(left > 0, flat[np.maximum(end[q] - length[q] + left - 1, 0)], 0)
        x, y = index.step(code, a, b)
        done = (left == 0) & (y > x)
        owner, k = _spread((y - x)[done])
        found_q.append(q[done][owner])
        found_k.append(x[done][owner] + k)
        go = (left > 0) & (y > x)
        late = [q[go], left[go] - 1, x[go], y[go]]
    q, k = np.concatenate(found_q), np.concatenate(found_k)
    both = np.unique(q * np.int64(index.n + 1) + k)
    return both // (index.n + 1), both % (index.n + 1)


def _codes(words: list[str], back: bool) -> list[np.ndarray]:
    """Characters as numbers, in the order in which an index reads: the first one last if ``back``."""
    return [np.frombuffer((w[::-1] if back else w).encode("utf-32-le"), "<u4").astype("i8") for w in words]


def near_in(targets: list[tuple], queries: list[tuple], back: bool, at_once: int) -> Iterator[tuple]:
    """``(query number, target number)`` of near words under the same key. Rows are (key, whether
    all targets of the key are here, word, ...); ``back`` matches first halves and extends to the
    right, in an index of reversed words."""
    order = sorted(range(len(targets)), key=lambda i: targets[i][2][::-1] if back else targets[i][2])
    coded = _codes([targets[i][2] for i in order], back)
    flat = np.concatenate(coded)
    alphabet, chars = np.unique(flat, return_inverse=True)
    index = Index(chars + 1, np.cumsum([len(c) for c in coded]))
    for start in range(0, len(queries), at_once):
        some = queries[start : start + at_once]
        words = []
        for c in _codes([row[2] for row in some], back):
            spot = np.minimum(np.searchsorted(alphabet, c), len(alphabet) - 1)
            words.append(np.where(alphabet[spot] == c, spot + 1, len(alphabet) + 1))
        length = np.array([len(w) for w in words])
        exact = length // 2 if back else length - length // 2
        itself = np.array([int(row[1]) for row in some])
        q, k = search(index, words, exact, itself, len(alphabet))
        for i, j in zip(q.tolist(), k.tolist(), strict=True):
            j = order[j]
            if some[i][0] == targets[j][0]:
                yield start + i, j


def _near(at_once: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a task: its targets are indexed, then its queries searched."""
    sides: dict = {}
    for batch in batches:
        for back, key, whole, target, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sides.setdefault(back, ([], []))[0 if target else 1].append((key, whole, word, n))
    for back, (targets, queries) in sides.items():
        if not targets or not queries:
            continue
        out = []
        for i, j in near_in(targets, queries, back, at_once):
            a, (*_, b, n) = queries[i][2], targets[j]
            # the second search leaves out what shares the first half as well
            if back or a[: len(a) // 2] != b[: len(a) // 2]:
                out.append((a, b, n))
            if len(out) >= 1 << 16:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    word, near, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], ["word", "near", "n"])


def near_words(words: DataFrame, a_task: int = 100_000, at_once: int = 20_000) -> DataFrame:
    """``word, near, n``: each pair of words (rows ``word, n``, words distinct) one inserted,
    deleted or replaced character apart, once in each direction, with the count of ``near``.

    ``a_task``: targets in a task, and the most under one half before it is dealt over several.
    ``at_once``: queries searched in step. Words of fewer than two characters have no halves that
    stay whole; they are not looked for."""
    size = F.length("word")
    halves = []
    for back in (True, False):
        own = size.cast("int")

        def cut(of, back=back):
            return F.floor(of / 2).cast("int") if back else (of - F.floor(of / 2)).cast("int")

        def key(width, back=back):
            part = F.substring(F.col("word"), F.lit(1), width) if back else F.expr("right(word, width)")
            return F.concat(width.cast("string"), F.lit("<" if back else ">"), part)

        lengths = F.array_distinct(F.array(cut(own), cut(own - 1), cut(own + 1)))
        target = words.select("word", "n", F.explode(lengths).alias("width")).where("width between 1 and length(word)")
        halves.append(target.select(F.lit(back).alias("back"), key(F.col("width")).alias("key"), F.lit(True).alias("target"), "word", "n"))
        query = words.select("word", "n", cut(own).alias("width")).where("width > 0")
        halves.append(query.select(F.lit(back).alias("back"), key(F.col("width")).alias("key"), F.lit(False).alias("target"), "word", "n"))
    rows = halves[0].unionByName(halves[1]).unionByName(halves[2]).unionByName(halves[3])
    sizes = rows.where("target").groupBy("key").agg(F.count("*").alias("many"))
    hot = sizes.where(F.col("many") > a_task).select("key", F.ceil(F.col("many") / a_task).cast("int").alias("parts"))
    rows = rows.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = F.when(F.col("target"), F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("part", F.explode(dealt))
    tasks = max(1, -(-4 * words.count() // a_task))
    rows = rows.repartition(tasks, "key", "part")
    whole = F.col("parts") == 1
    rows = rows.select("back", F.concat_ws("|", "part", "key").alias("key"), whole.alias("whole"), "target", "word", "n")
    return rows.mapInArrow(partial(_near, at_once), "word string, near string, n long")


def variants(words: DataFrame, factor: int = 2, **search) -> DataFrame:
    """``words`` (``word, n``) with ``n_near`` (near words), ``form`` and ``form_n`` (the near word of
    largest n, the smallest of equals in code-point order, if that n is ``factor`` times the word's
    or more, else null) and ``root`` (where following the forms ends; the word itself if none).

    Defined results: null words and other columns are left out; words must be distinct; an
    empty table gives no rows. Counts grow along the forms, so they never run in a circle; they
    are followed by looking up the form's form, which doubles the way in each round.
    """
    words = stored(words.where("word is not null").select("word", "n"), "variants-words")
    near = near_words(words, **search)
    # the largest n first, then the smallest word; strings stand in the order of code points
    top = F.min(F.struct((-F.col("n")).alias("minus"), "near"))
    found = near.groupBy("word").agg(F.count("*").alias("n_near"), top.alias("top"))
    enough = -F.col("top.minus") >= factor * F.col("n")
    rows = stored(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("top.near")).alias("form"),
            F.when(enough, -F.col("top.minus")).alias("form_n"),
        ),
        "variants-forms",
    )
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(roots.join(above, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "variants-roots")
        if further.where("next is not null").isEmpty():
            break
        roots = further.select("word", "root")
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
