"""Encoding, alignment and spelling variants against the libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import align, pieces, queries, variants

SF = "/root/testdata/sf0.01"
BYTES, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\nb\n", "▁x y", "</s><s><unk> <0x41>", "héé\x00x", "日本語 😀", "﻿x", "x" * 5001,
    " " * 4003, "ab" * 3000, "= = =" * 9 + "=" * 3000, "'s it's I'll", "a　b\tc", "<|endoftext|> d", "é" * 40, "end\r\n \r\n",
]
KIND = "doc_id long, text string, ids string, row string, links string, at long, groups string, n_best string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Odd texts, null, repeated rows and ids, no id, columns whose names clash."""
    rows = [*enumerate(ODD), (100, None), (None, "no id"), (None, None), (3, "a"), (3, "a"), (3, "another text")]
    return spark.createDataFrame([(i, t, "ids", "row", "links", 5, "groups", "n") for i, t in rows], KIND).repartition(3)


def texts(spark, sf=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- encoding ------------------------------------------------------------------------------------


def test_encoding_equals_the_library(spark, library):
    want = set()
    for i, t in texts(spark):
        ids = library.encode(t or "")
        want.add((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = [tuple(r) for r in queries.op11_sentencepiece(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want


def test_encoding_odd_rows(odd_rows, library):
    out = pieces.encode_texts(odd_rows, MODEL)
    rows = out.collect()
    assert len(rows) == odd_rows.count() and set(out.columns) == {*odd_rows.columns, "decoded"}
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids) and r.row == "row"
    assert pieces.encode_texts(odd_rows.limit(0), MODEL).collect() == []


def test_prefix_table_on_made_up_texts(library):
    coder, rnd = pieces.Pieces(MODEL, kept=50), random.Random(3)
    names = list(coder.ids)
    for _ in range(4000):
        some = [rnd.choice(names) if rnd.random() < 0.8 else rnd.choice(ODD[:12]) for _ in range(rnd.randint(1, 8))]
        text = "".join(some).replace("▁", rnd.choice("▁ "))
        assert coder.encode(text) == library.encode(text)
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(259), 28705]) for _ in range(rnd.randint(0, 7))]
        if ids:
            assert coder.decode(np.array(ids)) == library.decode(ids)


def test_each_prefix_has_the_last_token_of_its_encoding(library):
    coder = pieces.Pieces(MODEL)
    text = "▁unbelievably"
    for end, last in enumerate(coder.table(text)[1:], 1):
        assert library.encode(text[1:end])[-1:] in ([last], []) or end == 1


def test_other_models_are_refused(tmp_path):
    with pytest.raises((OSError, RuntimeError, ValueError)):
        pieces.Pieces(BYTES)


# -- alignment -----------------------------------------------------------------------------------


class Plain:
    """Alignment token by token."""

    def __init__(self, library):
        self.a, self.b = Tokenizer.from_file(BYTES), library
        self.a.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.raw_a = {i: bytes(byte_of[c] for c in s) for s, i in self.a.get_vocab().items() if not s.startswith("<|")}

    def raw_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        whole = f" {text}".encode()
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text or "")
        bytes_a, bytes_b = [self.raw_a[i] for i in a], [self.raw_b(i) for i in b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            out.append((a[i:x], b[j:y]))
            i, j = x, y
        return out

    def table(self, documents):
        """Every column but the id, for each document."""
        found = [self.groups(t) for _, t in documents]
        pairs = [Counter(p for x, y in g for p in ((m, n) for m in x for n in y)) for g in found]
        n = Counter(p for c in pairs for p in c)
        top = defaultdict(int)
        for (a, _), count in n.items():
            top[a] = max(top[a], count)
        for (i, _), g, c in zip(documents, found, pairs, strict=True):
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            best = sum(k for p, k in c.items() if n[p] == top[p[0]])
            sides = sum(len(x) for x, _ in g), sum(len(y) for _, y in g)
            yield (i, *sides, len(g), c.total(), sha(shown) if g else "", best, sum(k * n[p] for p, k in c.items()))


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_alignment_equals_brute_force(spark, library):
    want = sorted(Plain(library).table(texts(spark, "/root/testdata/sf0.001")))
    for hot in (200_000, 100, 0):
        got = queries.op12_cross_tokenizer_alignment(spark, "/root/testdata/sf0.001", hot=hot).select(*ALIGNED)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_alignment_odd_rows(odd_rows, library):
    out = align.align(odd_rows, BYTES, MODEL)
    n_b = align.vocabulary_size(MODEL)
    got = align.scored(out.withColumn("groups_sha256", F.sha2(F.col("groups").cast("binary"), 256)), n_b, hot=3)
    assert {"ids", "row", "at"} <= set(got.columns)
    rows = [tuple(r) for r in odd_rows.select("doc_id", "text").collect()]
    blank = lambda r: tuple(v if v != sha("") else "" for v in r)
    assert sorted((blank(r) for r in got.select(*ALIGNED).collect()), key=str) == sorted(Plain(library).table(rows), key=str)
    none = align.scored(align.align(odd_rows.limit(0), BYTES, MODEL), n_b)
    assert none.collect() == []


def test_cuts_and_large_groups():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = sorted(rnd.sample(range(1, 60), rnd.randint(1, 30))), sorted(rnd.sample(range(1, 60), rnd.randint(1, 30)))
        a, b = np.array([*a, 60]), np.array([*b, 60])
        cuts = align.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
        assert a[cuts].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    ids_a, ids_b = np.array([5, 5, 6, 7] * 3), np.array([1, 2, 2, 3] * 3)
    small = align.links(ids_a, ids_b, np.array([8, 4]), np.array([4, 8]), 10)
    large = align.links(ids_a, ids_b, np.array([8, 4]), np.array([4, 8]), 10, most=3)
    assert all((x == y).all() for x, y in zip(small, large, strict=True)) and small[1].sum() == 64
    wide = np.array([3, 9, 1 << 40]), np.array([1, 300, 2])
    assert all((x == y).all() for x, y in zip(align._unpacked(align._packed(*wide)), wide, strict=True))


# -- spelling variants ---------------------------------------------------------------------------


def plain_words(documents):
    count = Counter()
    for i, t in documents:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def plain_variants(n):
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
            if (short := w[:k] + w[k + 1 :]) in n:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: f if f and n[f] >= 2 * n[w] else None for w, f in form.items()}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        yield w, n[w], len(near[w]), form[w], n.get(form[w]), root


SPELLED = ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("options", [{}, {"a_task": 40, "at_once": 7}])
def test_variants_equal_brute_force(spark, options):
    sf = SF if not options else "/root/testdata/sf0.001"
    got = queries.op13_spelling_variants(spark, sf, **options).select(*SPELLED).collect()
    want = list(plain_variants(plain_words(texts(spark, sf))))
    assert len(got) == len(want) > 1000 and {tuple(r) for r in got} == set(want)


def test_variants_of_words_under_one_half(spark):
    """Half of all words begin alike, and words repeat their own characters."""
    rnd = random.Random(4)
    words = {"aaaaa" + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 6))) for _ in range(300)}
    words |= {"".join(rnd.choice("abé") for _ in range(rnd.randint(2, 7))) for _ in range(300)} | {"z" * 300, "z" * 301}
    n = {w: rnd.randint(1, 40) for w in words}
    df = spark.createDataFrame([(w, c, "x") for w, c in n.items()] + [(None, 9, "x")], "word string, n long, n_near string")
    want = set(plain_variants(n))
    for a_task in (100_000, 30):
        got = variants.variants(df.repartition(3), a_task=a_task, at_once=50).select(*SPELLED)
        assert {tuple(r) for r in got.collect()} == want


def test_variants_odd_rows(spark, odd_rows):
    text = "Straße straße STRAßE strase strase strase Éclair éclair"
    more = spark.createDataFrame([(i, text) for i in (None, None, 7, 7)] + [(8, "")], "doc_id long, text string")
    both = odd_rows.select("doc_id", "text").union(more)
    got = variants.variants(variants.vocabulary(both)).select(*SPELLED)
    rows = [tuple(r) for r in both.collect()]
    assert {tuple(r) for r in got.collect()} == set(plain_variants(plain_words(rows)))
    assert variants.variants(variants.vocabulary(odd_rows.limit(0))).collect() == []
