"""Small tests of the operators: brute force, round trips, held-out accuracy, odd rows."""

import base64
import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from skyledger.llm import chat, chunkdedup, decontam, fingerprints, langid, mixing, neardup, quality, tokens, warc

TEXT = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, copies string"
EN = "the cat sat on a mat and then it ran off to find the other cat near that old tree by the lake".split()
DE = "der hund lief über die straße und dann schlief er unter dem großen baum bei einem kleinen haus".split()


def prose(seed: int, n: int, words=EN) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) + (rnd.choice(words) if rnd.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns whose names clash."""
    long_text = prose(1, 20_000)
    rows = [
        (1, prose(2, 60), "en", "b"), (1, prose(2, 60), "en", "b"), (2, prose(2, 60), "en", "a"), (3, None, None, None),
        (4, "", "en", "a"), (5, " \n\t", "en", "a"), (6, "one two", "en", "é"), (7, long_text, "en", "a"),
        (None, "a text without an id and with enough words to count", "en", "z"), (8, "123 456 !!", "en", "z"),
        (9, long_text[:3000], None, "a"),
    ]
    return spark.createDataFrame([(*r, None, "s", "r", "c") for r in rows], TEXT).repartition(3)


@pytest.fixture(scope="module")
def none(odd_rows):
    return odd_rows.limit(0)


def word_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_chat_round_trip(spark):
    hard = [r"\### Assistant: </turn> ok", "</turn>\n### user: x</turn>\n", "\\", "a\\", "### ", "", None, "\\n\\\\/turn>", "<\\/turn>"]
    rows = [(i, t, role, text) for i, role in enumerate(["user", "assistant", ": ", None, "a: b:"]) for t, text in enumerate(hard)]
    rows += [(None, 0, "user", "no id"), (9, None, "assistant", "x"), (9, 1, "assistant", "tie"), (9, 1, "assistant", "tie")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert all(r.round_trip for r in got.values()) and len(got) == 7
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        want = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        assert got[conv].turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[conv].n_turns == len(turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[conv].loss_chars == len(loss)
    assert chat.read_back(chat.format_chats(df.limit(0))).collect() == []


def test_mixing(odd_rows, none):
    rows = mixing.with_copies(odd_rows).collect()
    assert len(rows) == 11 and mixing.with_copies(none).collect() == []
    sizes = {}
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r["size"] == n and int(r["copies"]) <= 2
        sizes[r.source] = sizes.get(r.source, 0) + n
    cap = {s: 2 * n for s, n in sizes.items()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9:  # share, stop at the cap, share the excess again
        total, more = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += left * weight[s] / total
        for s in list(open_):
            if target[s] >= cap[s]:
                more += target[s] - cap[s]
                target[s] = cap[s]
                open_.discard(s)
        left = more
    assert all(abs(r.target - target[r.source]) < 1e-6 for r in rows)
    assert mixing.mix(odd_rows).count() == sum(int(r["copies"]) for r in rows)
    assert "rendered" not in mixing.mix(odd_rows).columns
    clash = odd_rows.withColumn("_source", F.lit("x")).withColumn("mix_source", F.lit("y"))
    assert mixing.with_copies(clash).count() == 11


def test_chunks_resist_shifts_and_cover_the_text():
    method, text = chunkdedup.Chunks(), prose(5, 3000, EN + DE).encode()
    for data in (text, b"a" * 5000, b"", b"x", "é".encode() * 4000):
        cuts = method.cuts(np.frombuffer(data, "u1"))
        assert (not len(data) and not len(cuts)) or cuts[-1] == len(data)
        assert all(np.diff(np.append(0, cuts)) > 0) and all((data[c] & 0xC0) != 0x80 for c in cuts[:-1])
    pieces = lambda d: {d[a:b] for a, b in zip(np.append(0, method.cuts(np.frombuffer(d, "u1"))), method.cuts(np.frombuffer(d, "u1")), strict=False)}
    moved = pieces(b"some words put in front " + text)
    assert len(pieces(text) - moved) <= 3


def repeated_words(rows, width=50):
    """By word windows alone: for each text, in order of ids, which bytes lie in runs of ``width`` words that
    occurred before, and which words."""
    seen = set()
    for i, text in rows:
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", text.encode())]
        data, inside = text.encode(), bytearray(len(text.encode()))
        for k in range(len(words) - width + 1):
            key = tuple(data[a:b] for a, b in words[k : k + width])
            if key in seen:
                a, b = words[k][0], words[k + width - 1][1]
                inside[a:b] = b"\1" * (b - a)
            seen.add(key)
        yield i, data, inside


def test_substring_dedup_against_brute_force(spark, odd_rows, none):
    """Nearly all bytes in runs of 50 words that were there before go, and little else."""
    passages = [prose(70 + k, n, EN + DE) for k, n in enumerate((51, 60, 90, 400))] + ["again " * 700]
    near = [prose(100, 300)] + [" ".join(w if k % 90 else f"w{i}x{k}" for k, w in enumerate(prose(100, 300).split())) for i in range(4)]
    rows = [(i, f"{prose(110 + i, 80)} {passages[i % 5]}{' ' * (i % 2)}\n{prose(200 + i, 80)}") for i in range(30)]
    rows += [(50 + i, t) for i, t in enumerate(near)] + [(60 + i, prose(300 + i, 200)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {r.doc_id: r for r in chunkdedup.dedup_substrings(frame).collect()}
    spans = {r.id: r for r in chunkdedup.repeated_spans(frame).collect()}
    repeated = met = beyond = 0
    for i, data, inside in repeated_words(rows):
        gone = bytearray(len(data))
        for s in spans[i].gone if i in spans else []:
            assert not any(gone[s.start : s.end])
            gone[s.start : s.end] = b"\1" * (s.end - s.start)
        assert out[i].kept_text.encode() == bytes(c for c, g in zip(data, gone, strict=True) if not g)
        assert out[i].removed_bytes == sum(gone) <= out[i].repeated_bytes and set(out[i].kept_text.split()) <= set(data.decode().split())
        assert i < 60 or not any(gone)
        repeated += sum(inside)
        met += sum(g and r for g, r in zip(gone, inside, strict=True))
        beyond += sum(gone) if not any(inside) and "again" not in data.decode() else 0
    assert met >= 0.97 * repeated > 20_000 and beyond <= 0.05 * repeated
    got = {(r.doc_id, r.kept_text is None) for r in chunkdedup.dedup_substrings(odd_rows).collect()}
    assert (3, True) in got and chunkdedup.dedup_substrings(odd_rows).count() == 11
    assert chunkdedup.dedup_substrings(none).collect() == []


def test_shared_bytes_are_whole_words():
    shared = lambda a, b, right: chunkdedup._shared(a, b, right, 16)
    assert shared(b"foo bar", b"foo bar", True) == 7 and shared(b"foo bar", b"foo bar", False) == 7  # ends of texts
    assert shared(b"foo", b"foobar", True) == 0 and shared(b"foo ba", b"foo bo", True) == 4
    assert shared(b"x foo ", b"y foo ", False) == 4 and shared(b"xfoo ", b"foo ", False) == 0
    assert shared(b"a" * 16, b"a" * 16, True) == 0 == shared(b"", b"foo", True)  # the word may go on


def test_common_endings_stay(spark):
    """Unrelated documents that end in the same word lose nothing, and no text ends in a short chunk."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(60)) + " finally.") for i in range(400)]
    out = chunkdedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept_text) for r in out} == set(rows)
    method = chunkdedup.Chunks()
    for data in [t.encode() for _, t in rows] + [b"a" * n for n in range(500, 1200, 7)]:
        cuts = method.cuts(np.frombuffer(data, "u1"))
        assert len(cuts) == 1 or cuts[-1] - cuts[-2] > method.reach


def test_passages_are_found_by_length(spark):
    """Of a passage that a second document repeats, how much goes, by its words; clean text stays."""
    rnd = random.Random(15)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 6)))
    some = lambda n: " ".join(word() for _ in range(n))
    rows, inside = [], {}
    for n in (51, 60, 100, 400):
        for _ in range(60):
            passage = some(n)
            rows.append((len(rows), f"{some(40)} {passage} {some(40)}"))
            before = some(40)
            inside[len(rows)] = (n, len(before) + 1, len(before) + 1 + len(passage))
            rows.append((len(rows), f"{before} {passage} {some(40)}"))
    share = {}
    for r in chunkdedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.doc_id not in inside:
            assert r.kept_text == rows[r.doc_id][1] and r.removed_bytes == 0
            continue
        n, a, b = inside[r.doc_id]
        text = rows[r.doc_id][1]
        # what stays is the text on both sides of one cut, which lies within the passage
        assert r.removed_spans == 1 and r.kept_text.startswith(text[:a]) and r.kept_text.endswith(text[b:])
        share.setdefault(n, []).append(r.removed_bytes / (b - a))
    assert min(share[51]) > 0.8 and np.mean(share[51]) > 0.97 and np.mean(share[100]) > 0.98 and np.mean(share[400]) > 0.99


def test_short_repeats_stay(spark):
    """What is repeated is short of ``least`` bytes: clean text that chunks alone would cut."""
    phrase = "as has been said before in other places and by others as well"  # 62 bytes
    rows = [(i, f"{prose(400 + i, 40, EN + DE)} {phrase} {prose(500 + i, 40, EN + DE)}") for i in range(30)]
    out = chunkdedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept_text) for r in out} == set(rows)


def test_near_duplicates_against_brute_force(spark, odd_rows, none):
    rnd, rows = random.Random(3), []
    for g in range(6):
        base = prose(g, 120, EN + DE).split()
        for _ in range(12):
            words = [w if rnd.random() > 0.01 * g else "new" + str(rnd.random()) for w in base]
            rows.append((len(rows), " ".join(words)))
    rows += [(1000 + i, t) for i, t in enumerate([None, "", " ", "One  two", "one two", "a b c d e", "a b c d f"])]
    for frame, plain in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (odd_rows, [(r.doc_id, r.text) for r in odd_rows.collect()])):
        sets, root = [word_set(t) for _, t in plain], list(range(len(plain)))
        find = lambda i: i if root[i] == i else find(root[i])
        for i in range(len(plain)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
        low = {}
        for i, (doc, _) in enumerate(plain):
            low.setdefault(find(i), []).append(doc)
        want = sorted(
            ((str(d), len(sets[i]), str(min((x for x in low[find(i)] if x is not None), default=None))) for i, (d, _) in enumerate(plain))
        )
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.near_duplicates(frame).collect())
        assert got == want
    assert neardup.near_duplicates(none).collect() == []


def test_large_nodes_go_deeper(spark):
    """More unlinked members than a node compares exhaustively, all alike in part."""
    rnd, base, rows = random.Random(8), prose(9, 150, EN + DE).split(), []
    for _ in range(40):
        rows.append((len(rows), " ".join(w if rnd.random() > 0.04 else f"n{rnd.random()}" for w in base)))
    rows += [(100 + i, t + " end") for i, t in rows]
    method = neardup.ChosenPath(few=2, step=2)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), method=method).collect()}
    sets = {i: word_set(t) for i, t in rows}
    linked = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(linked) >= 40 and all(got[i] == got[j] for i, j in linked)


@pytest.mark.parametrize("deeper", [1, 3, 8])
def test_trees_keep_pairs_together_at_any_depth(deeper):
    """Pairs at the similarity, of which every order agrees with that chance: nearly all still share
    a node 5, 11 and 26 levels down."""
    method, rng, missed = neardup.ChosenPath(), np.random.default_rng(4), 0

    def alike(orders, most):
        a = rng.integers(0, most, orders).astype("u4")
        return a, np.where(rng.random(orders) < method.similarity / 100, a, a + 1).astype("u4")

    def together(nodes, pair, levels, chance):
        sides = [method.descend(nodes, np.tile(s, (len(nodes), 1)), levels, chance)[0].tolist() for s in pair]
        return np.array(sorted(set(sides[0]) & set(sides[1])), "u8")

    for _ in range(300):
        nodes = together(method.roots(), alike(method.orders, 1 << 32), method.depth, method.even)
        below = alike(method.sketch // 2, 1 << 8)
        for _ in range(deeper):
            nodes = together(nodes, below, method.step, method.lively) if 0 < len(nodes) < 3000 else nodes
        missed += not len(nodes)
    assert missed <= 3


def test_links_of_a_large_loose_family_are_found(spark):
    """240 texts, each pair at a similarity of about a half, in nodes that hold far more unlinked
    members than are compared at once; each of the first 100 has one partner just above the bound."""
    rnd, base, rows = random.Random(12), prose(13, 200, EN + DE).split(), []
    for k in range(240):
        rows.append((k, " ".join(w if rnd.random() > 0.06 else f"n{rnd.random()}" for w in base)))
    for k, text in rows[:100]:
        words = text.split()
        words[20::40] = [f"m{rnd.random()}" for _ in words[20::40]]  # 5 of 200 words, some 25 shingles of 196
        rows.append((1000 + k, " ".join(words)))
    method = neardup.ChosenPath(few=24)
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), method=method)
    got = {r.doc_id: r.component_id for r in found.collect()}
    sets = {i: word_set(t) for i, t in rows}
    near = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert 0.3 < near(0, 1) < 0.7
    linked = [(k, 1000 + k) for k in range(100) if near(k, 1000 + k) >= 0.75]
    assert len(linked) >= 95 and sum(got[i] == got[j] for i, j in linked) >= 0.99 * len(linked)
    assert sum(i != c for i, c in got.items()) <= 110  # unlinked members stay apart


def test_order_min_hash():
    method = fingerprints.OrderMinHash()
    a, b = prose(1, 400), prose(2, 400)
    near = lambda x, y: method.likeness(method.lanes_of(x), method.lanes_of(y))
    assert near(a, a) == 1 and near(a, b) < 0.2 < near(a, fingerprints.edited(a, b)) < near(a, a[:-20] + "x" * 20)
    halves = a[len(a) // 2 :] + a[: len(a) // 2]
    assert near(a, halves) < 0.9  # the same k-mers in another order
    for text in ("", "a", "ab" * 5000, "日本語 テキスト"):
        assert near(text, text) == 1


def test_short_texts_show_their_edits():
    """All nine k-mers of 16 code points take part: lanes differ, and an edit anywhere shows."""
    method, rnd = fingerprints.OrderMinHash(), random.Random(6)
    prints, between = set(), 0
    for _ in range(300):
        text = "".join(rnd.choice("abcdefghij klmnop") for _ in range(16))
        lanes = method.lanes_of(text)
        assert len(method.kmers(text)) == 9 and len(set(lanes.tolist())) > 4
        for at in (0, 15):
            changed = method.lanes_of(text[:at] + "Z" + text[at + 1 :])
            assert (changed != lanes).any()
            between += bool((changed == lanes).any())
        prints.add(method.as_text(lanes))
    assert len(prints) == 300 and between > 500


def test_fingerprints_of_neighbours(spark, odd_rows, none):
    rows = [(i, t) for i, t in enumerate([prose(1, 50), "", None, "short", prose(2, 90), prose(3, 30)])]
    got = {r.doc_id: r for r in fingerprints.with_neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        text, following = text or "", rows[(i - 1) % len(rows)][1] or ""
        want = fingerprints.edited(text, following)
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert fingerprints.with_neighbours(odd_rows).count() == 11 and fingerprints.with_neighbours(none).collect() == []
    assert fingerprints.fingerprint(odd_rows).count() == 11


def plain_order_min_hash(text, k=8, take=2, lanes=64, seed=3):
    """Order MinHash by its definition, one lane and one k-mer at a time."""
    big = lambda x: int(x) & (1 << 64) - 1

    def mixed(x):
        for _ in range(2):
            x ^= x >> 32
            x = big(x * 0xD6E8FEB86659FD93)
        return x ^ x >> 32

    multipliers = lambda n, s: [mixed(big(i * 0x9E3779B97F4A7C15 + s)) | 1 for i in range(1, n + 1)]
    if not text:
        return "0" * 4 * lanes
    codes = [ord(c) + 1 for c in text]
    codes += [0] * (k - len(codes))
    ways = multipliers(k, seed)
    factor = [1] * k  # as places are doubled: place i has the product of the factors of its bits
    for i in range(1, k):
        factor[i] = big(factor[i - (1 << i.bit_length() - 1)] * ways[1 << i.bit_length() - 1])
    kmers = [mixed(big(sum(codes[j + i] * factor[i] for i in range(k)))) for j in range(len(codes) - k + 1)]
    seen, numbered = {}, []
    for h in kmers:
        numbered.append(mixed(big(h + seen.setdefault(h, 0) * 0x9E3779B97F4A7C15)) >> 32)
        seen[h] += 1
    out, joint = "", multipliers(take, seed + 2)
    for way in multipliers(lanes, seed + 1):
        order = sorted(range(len(kmers)), key=lambda j: (numbered[j] * (way & 0xFFFFFFFF) & 0xFFFFFFFF, j))
        chosen = sorted(order[: min(take, len(kmers))])
        out += f"{mixed(big(sum(kmers[j] * w for j, w in zip(chosen, joint)))) >> 48:04x}"
    return out


def test_fingerprints_against_brute_force(spark):
    rows = [(i, prose(600 + i, 3 + 40 * i, EN + DE)) for i in range(6)] + [(6, "ab"), (7, ""), (8, "again " * 600), (9, "é" * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: plain_order_min_hash(t) for i, t in rows}
    assert {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(frame).collect()} == want
    assert {r.doc_id: r.fingerprint for r in fingerprints.with_neighbours(frame).collect()} == want


def test_rows_without_an_id_are_dealt_to_all_tasks(spark):
    """A third of the rows lack an id, half of those have one text: no range gets them all."""
    rows = [(None if i % 3 == 0 else i, "the same words" if i % 6 == 0 else f"text {i}") for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = fingerprints.with_neighbours(frame)
    got = out.collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((i or -1, len(t)) for i, t in rows)
    ranged = fingerprints.ranged(frame.select("doc_id", "text"))
    sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8


def test_decontamination_against_brute_force(spark, odd_rows, none):
    items = [(1, prose(900, 30, EN + DE)), (2, prose(901, 12, EN + DE)), (3, "two words"), (4, None), (5, "  ")]
    rnd, rows = random.Random(4), []
    for i in range(20):
        item = items[i % 2][1].split()
        if i >= 10:
            item[rnd.randrange(len(item))] = "changed"
        rows.append((i, prose(i, 40) + " " + " ".join(item) + ("" if i % 4 == 0 else " " + prose(50 + i, 40))))
    rows += [(30, prose(31, 100)), (31, "TWO\nwords"), (32, None)]
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, text in rows:
        w = (text or "").lower().split()
        for t, item in items:
            v = (item or "").split()
            k = min(5, len(v))
            if not v:
                continue
            count = lambda x: {s: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)].count(s) for s in {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}}
            b = count(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                a = count(w[s : s + len(v)])
                both = sum(min(n, b.get(x, 0)) for x, n in a.items())
                sim = both / (sum(a.values()) + sum(b.values()) - both)
                if sim >= 0.75 and sim > want.get((d, t), (0,))[0]:
                    want[d, t] = (sim, s)
    for limit in (200_000, 0):  # by broadcast and by shuffle
        got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs, tests, broadcast_rows=limit).collect()}
        assert got == {k: v[0] for k, v in want.items()} and len(want) > 10
    assert decontam.contaminated(odd_rows, tests).count() == 0
    assert decontam.contaminated(none, tests).collect() == [] == decontam.contaminated(docs, tests.limit(0)).collect()


def test_language_id(spark, odd_rows, none):
    rows = [(i, prose(i, 30, (EN, DE)[i % 2]), ("en", "de")[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df, steps=120).join(df.select("doc_id", F.col("lang").alias("truth")), "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r.lang_pred == r.truth for r in got]) > 0.97
    odd = langid.identify(odd_rows, steps=5).collect()
    assert len(odd) == 11 and {r.lang_pred for r in odd if r.doc_id in (3, 4, 5, 8)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd) and langid.identify(none).collect() == []


def test_gradients_are_those_of_the_loss():
    model, rng = langid.Tagger(["a", "b"], hidden=3, segment=6), np.random.default_rng(0)
    for part in (model.forward, model.backward):
        part.p = {k: v.astype("f8") for k, v in part.p.items()}
    steps, labels = rng.integers(97, 100, (6, 4)), np.array([0, 1, 0, 1])
    loss = lambda: -np.mean([np.log(model.positions(steps)[0][labels[i], :, i]) for i in range(4)])
    prob, states, tape, back = model.positions(steps, keep=True)
    d = (np.moveaxis(prob, 0, 2) - np.eye(2)[labels][None]) / steps.size
    g = model.forward.back(tape, (d @ model.out["w"].T)[:, :, :3])["ur"]
    at, h = (1, 2), 1e-2
    model.forward.p["ur"][at] += h
    up = loss()
    model.forward.p["ur"][at] -= 2 * h
    assert abs((up - loss()) / (2 * h) - g[at]) < 2e-4


def test_warc(spark):
    pages = [(1, "u", "same"), (2, "u\r\nX: y", "same"), (2, None, "same"), (3, None, None), (4, "v", ""), (5, "w", "ü" * 50_000), (None, "n", "z")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string").repartition(3)
    got = warc.round_trip(df, archive_bytes=20_000).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(p[0]) for p in pages)
    by = {r.page_id: r for r in got}
    assert by[1].record_type == "response" and (by[2].record_type, by[2].refers_to) == ("revisit", 1)
    assert (by[4].record_type, by[4].refers_to, by[4].payload_bytes) == ("revisit", 3, 0) and by[5].payload_bytes == 100_000
    assert warc.round_trip(df.limit(0)).collect() == []


def test_bad_archives():
    import zstandard

    good = warc.dictionary_frame(b"") + zstandard.compress(warc.record(1, "u", b"data", None))
    assert [r["payload"] for r in warc.read_archive(good)] == [b"data"]
    wrong = warc.record(1, "u", b"data", None).replace(b"data", b"date")
    for bad in (b"", good[8:], good[:-3], warc.dictionary_frame(b"") + zstandard.compress(wrong), warc.dictionary_frame(b"") + zstandard.compress(b"WARC/1.1\r\n\r\n")):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(bad))


def test_quality(spark, odd_rows, none):
    good = [(i, ". ".join(" ".join(prose(i * 9 + j, 12).split()).capitalize() for j in range(6)) + ".") for i in range(150)]
    bad = [(1000 + i, (" ".join(["BUY!!", "NOW!!", str(i) * 3]) + " ") * 20) for i in range(60)]
    got = quality.classify(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()
    assert np.mean([r.keep == (r.doc_id < 1000) for r in got]) > 0.97
    assert quality.classify(odd_rows).count() == 11 and quality.classify(none).collect() == []


def test_labellers_recover_their_accuracies():
    rng = np.random.default_rng(2)
    truth, right = rng.random(20_000) < 0.7, np.array([0.9, 0.8, 0.7, 0.85])
    seen = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    patterns, counts = np.unique(seen, axis=0, return_counts=True)
    model = quality.fit_labellers(patterns, counts.astype(float))
    assert abs(model["prior"] - 0.7) < 0.05 and np.abs(model["accuracy"].mean(1) - right).max() < 0.05


def test_token_counts(spark, odd_rows, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd, alphabet = random.Random(3), "ab'sé́ \t\n  <|endoftext|>İΣς1.,!日本"
    plain = tokens.Counter(path).tokenizer
    for chunk, overlap in ((100_000, 10), (37, 5), (20, 3)):
        counter = tokens.Counter(path, chunk, overlap)
        for i in range(120):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))
            text = text if i % 3 else re.sub(r"\s", "", text)
            assert counter.count(text) == len(plain.encode(text, add_special_tokens=False).ids)
        assert chunk > 1000 or counter.resyncs
    got = tokens.count_tokens(odd_rows, path).collect()
    assert len(got) == 11
    for r in got:
        assert r.n_tokens == len(plain.encode(r.text or "", add_special_tokens=False).ids) and r.over_limit == (r.n_tokens > 2048)
    assert tokens.count_tokens(none, path).collect() == []
    clash = odd_rows.withColumn("__text", F.lit("x")).withColumn("_TEXT", F.lit("y"))
    assert {r.n_tokens for r in tokens.count_tokens(clash, path).collect()} == {r.n_tokens for r in got}


def test_long_texts_are_spliced_by_default(spark):
    """Texts of the tables' length go in chunks, spliced at their overlaps, and count as the library says."""
    path = public_tokenizers.path("word_bpe_49k.json")
    counter, plain = tokens.Counter(path), tokens.Counter(path).tokenizer
    for n in (3000, 9000):
        text = prose(n, n, EN + DE)
        assert counter.count(text) == len(plain.encode(text, add_special_tokens=False).ids)
    assert counter.resyncs > 5
    blank = "x" * 10_000 + " " + "é" * 10_000  # no white space in most overlaps: widened until both chunks are one
    assert counter.count(blank) == len(plain.encode(blank, add_special_tokens=False).ids) and counter.widened


def test_components_extended(spark):
    """Connecting new links to known components gives what connecting all links at once gives."""
    from skyledger.llm.components import components, extended

    old, new = [(1, 2), (2, 3), (7, 8), (20, 21)], [(3, 8), (8, 3), (30, 31), (31, 20), (1, 3), (5, 5)]
    frame = lambda rows: spark.createDataFrame(rows, "a int, b int")
    got = {tuple(r) for r in extended(components(frame(old)), frame(new)).collect()}
    assert got == {tuple(r) for r in components(frame(old + new)).collect()}
    assert {k: r for k, r in got} == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 20: 20, 21: 20, 30: 20, 31: 20}
    none = {tuple(r) for r in extended(components(frame(old)), frame([])).collect()}
    assert none == {tuple(r) for r in components(frame(old)).collect()}


def test_archive_pages_against_plain_python(spark):
    """All six columns, with a hot group of equal payloads, empty and long ones, a null url and a null
    payload; records are HTTP messages, and revisits name the record they refer to."""
    rnd = random.Random(21)
    rows = [(i, f"http://h/{i}", "<p>hot</p>" if i % 3 == 0 else f"<p>{rnd.random()} ü</p>" * rnd.randint(1, 40)) for i in range(300)]
    rows += [(300, None, "x" * 300_000 + "\r\n\r\n"), (301, "u", ""), (302, "u", None), (303, "u", "\r\n\r\n<p>")]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(5)
    first, want = {}, {}
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        origin = first.setdefault(digest, i)
        want[i] = (len(data), digest, "response" if origin == i else "revisit", None if origin == i else origin)
    got = warc.round_trip(frame, archive_bytes=4_000)
    found = got.collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == want and len(found) == len(rows)
    kept = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response"}
    assert all(kept[i] == (html or "").encode() for i, _, html in rows if i in kept)
    assert warc.round_trip(frame.limit(0)).dtypes == got.dtypes
    one, two = warc.parse_record(warc.record(1, "u", b"<p>", None)), warc.parse_record(warc.record(2, "u", b"<p>", 1))
    assert one["block"].startswith(b"HTTP/1.1 200 OK\r\n") and two["warc-refers-to"] == one["warc-record-id"] != two["warc-record-id"]


def test_archives_are_read_in_one_pass():
    """Four times the records take about four times as long; handing on the rest of the archive for
    every record took sixteen times."""
    taken = []
    for n in (2_000, 8_000):
        rnd = random.Random(n)
        data = warc.dictionary_frame(b"") + b"".join(zstandard.compress(warc.record(i, "u", rnd.randbytes(2_000), None)) for i in range(n))
        began = time.perf_counter()
        assert sum(1 for _ in warc.read_archive(data)) == n
        taken.append(time.perf_counter() - began)
    assert taken[1] < 8 * taken[0]


def test_dictionary_sample_is_bounded(spark):
    """A payload that a third of the rows hold comes once, and no more than the sample is fetched."""
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("<p>hot</p>" * 50)).otherwise(F.concat(F.lit("<p>the page number "), F.col("id"))).cast("binary").alias("payload"))
    assert warc.train_dictionary(rows, samples=100) == warc.train_dictionary(rows.repartition(7), samples=100)
    assert warc.train_dictionary(rows.limit(0)) == b""


def test_language_sample_is_bounded_and_leaves_no_language_out(spark):
    """A text that a third of the rows repeat gives its pieces once, and rare languages are learned."""
    rows = [("en", prose(1, 40))] * 1_000 + [("en", prose(100 + i, 40)) for i in range(1_500)]
    rows += [(f"l{i}", f"{prose(5_000 + i, 30, DE)} {i}") for i in range(250)] + [(None, "no language"), ("en", None), ("zz", "12 34")]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    sample = langid.training_sample(frame, per_lang=100)
    assert {lang for lang, _ in sample} == {"en", *(f"l{i}" for i in range(250))}
    english = [piece for lang, piece in sample if lang == "en"]
    assert 350 <= len(english) <= 400 and len(set(english)) == len(english)
    assert sample == langid.training_sample(frame.repartition(2), per_lang=100)
    assert langid.training_sample(frame.limit(0)) == []
