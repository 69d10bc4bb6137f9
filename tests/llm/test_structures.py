"""Collocations, the conversation trie and fingerprints against plain Python, with nulls, ties, repeats and hot groups."""

import collections
import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from listwell.llm import catalog, collocations, fingerprints, prefix_trie

CLASH = "number string, word string, id string, size string, tile string, head string, tie string, text2 string, chunk string"
DOCS = f"doc_id bigint, text string, lang string, {CLASH}"
TURNS = "conv_id bigint, turn bigint, role string, text string, pos string, digest string, number string, id string, low string"


def same(df, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 9) for r in rows], DOCS)


# 11 ------------------------------------------------------------------------------------


def plain_collocations(rows, most, least, percent, top):
    words, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for m in range(1, most + 1):
                counts[lang].update(tuple(found[i : i + m]) for i in range(len(found) - m + 1))
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            result.append((lang, i + 1, phrase.decode(), -a, left, right, words[lang], -score))
    return result


def some_texts():
    rnd = random.Random(3)
    stock = "the of And été König 東京 data base new york city in on a\x85b x y".split(" ") + [f"w{i}" for i in range(40)]
    rows = [(None, None, None), (1, "", "en"), (2, " \t\n\x0b", "en"), (3, "a", None), (3, "a", None)]
    for i in range(4, 120):
        n = rnd.randint(1, 120)
        text = "".join(rnd.choice(stock[: rnd.choice([6, 16, 56])]) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\r\n", "!"]) for _ in range(n))
        rows.append((i, text, rnd.choice(["en", "en", "fr", None, ""])))
    rows.append((200, "New York City " * 9_000 + "no end", "en"))
    rows += [(201, "copies of one text, copies", "en")] * 60
    return rows


@pytest.mark.parametrize("most,least,percent,top", [(3, 10, 50, 2000), (4, 3, 30, 25), (2, 2, 50, 5)])
def test_collocations(spark, monkeypatch, most, least, percent, top):
    if most == 4:  # small tiles, chunks and rounds: every way of counting
        monkeypatch.setattr(collocations, "SLICE_BYTES", 50)
        monkeypatch.setattr(collocations, "CHUNK_BYTES", 400)
        monkeypatch.setattr(collocations, "FAN", 3)
        monkeypatch.setattr(collocations, "SLICE_WORDS", 2_000)
    rows = some_texts()
    found = collocations.collocations(docs_of(spark, rows).repartition(4), most, least, percent)
    got = collocations.best_per_language(found, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    same(got, plain_collocations(rows, most, least, percent, top))


def test_collocations_of_nothing(spark):
    assert collocations.best_per_language(collocations.collocations(docs_of(spark, []))).count() == 0
    assert collocations.best_per_language(collocations.collocations(docs_of(spark, [(1, "once only", "en")]))).count() == 0


def test_tiles_dense_and_sparse_agree(monkeypatch):
    import numpy as np

    rnd = np.random.default_rng(1)
    monkeypatch.setattr(collocations, "COMPACT_FROM", 1_000)
    for a, b in ((0, 0), (1, 0), (2, 1), (9, 7)):  # the last are too large for so few entries
        low, wide = collocations.BANDS, collocations.WIDTHS
        tile, plain = collocations._Tile((a << 5 | b) << 32), collections.Counter()
        for n in (5, 90_000, 80_000, 7):
            left, right = rnd.integers(low[a], low[a] + wide[a], n, np.uint64), rnd.integers(low[b], low[b] + wide[b], n, np.uint64)
            pairs = np.unique(left << np.uint64(32) | right)
            counts = rnd.integers(1, 9, len(pairs)).astype(np.uint32)
            assert (collocations._pairs_in(collocations._pairs_out(pairs)) == pairs).all()
            assert set(collocations._tile_of(pairs, 1)) == {(a << 5 | b) << 32}
            for p, c in zip(pairs.tolist(), counts.tolist()):
                plain[p] += c
            tile.add(pairs, counts)
            got = tile.totals()
            assert got[0].tolist() == sorted(plain) and got[1].tolist() == [plain[p] for p in sorted(plain)]
        assert (tile.dense is not None) == (a < 2)
    pairs = rnd.integers(0, 1200, 400_000).astype(np.uint64) << np.uint64(32) | rnd.integers(0, 1200, 400_000).astype(np.uint64)
    for x, y in zip(collocations._counted_pairs(pairs), np.unique(pairs, return_counts=True)):
        assert (x == y).all()


def test_slices_part_the_left_ids():
    import numpy as np

    pairs = np.arange(1024, 4096).astype(np.uint64) << np.uint64(32) | np.uint64(5)
    tiles = collocations._tile_of(pairs, 4)
    assert len(set(tiles)) == 8 and (np.diff(tiles) >= 0).all()
    assert set(collocations._tile_of(np.arange(1024).astype(np.uint64), 4)) == {0}


def test_scores_are_exact(spark):
    f = collocations.best_per_language
    rows = [("en", f"p{i}", 10, 1, 1, 5, s) for i, s in enumerate([3, 3, 9])]
    got = f(spark.createDataFrame(rows, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"), 2)
    assert [(r.phrase, r["rank"]) for r in got.orderBy("rank").collect()] == [("p2", 1), ("p0", 2)]


# 12 ------------------------------------------------------------------------------------


def plain_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, v in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        made[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = collections.defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1]) if p else 0
    ends = collections.defaultdict(list)
    for c, v in made.items():
        ends[v].append(c)
    return [
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, who in members.items()
    ]


def some_conversations():
    rnd = random.Random(8)
    rows = [(None, 1, "user", "nobody's"), (1, None, None, None), (1, None, "user", "x"), (1, 0, "user", "é"), (1, 0, "assistant", "é"), (1, 0, "user", "é"), (-7, 1, "user", "below"), (-100, 0, "user", "hi")]
    rows += [(10**15 + 3, 2, "user", "far"), (10**15, 1, "user", "base of far")]
    for c in range(100, 330):
        if c == 300:
            continue  # no base
        deep = 40 if c % 31 == 0 else 5
        rows += [(c, t if rnd.random() < 0.97 else None, rnd.choice(["user", None]) if t > 20 else "user", rnd.choice("ab") if t > 3 else "hello") for t in range(rnd.randint(1, deep))]
    copy = [(t, "user", f"turn {t}") for t in range(35)]
    for c in range(400, 460):  # a group of copies that differ late
        rows += [(c, t, r, x if t < 30 or c % 3 else f"{x} {c}") for t, r, x in copy]
    rows += [(500, t, "user", "long " * (t % 3)) for t in range(1400)]
    rows += [(507, t, "user", "long " * (t % 3)) for t in range(1390)]
    return rows


@pytest.mark.parametrize("block,fan", [(8, 64), (3, 4)])
def test_trie(spark, monkeypatch, block, fan):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    rows = some_conversations()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], TURNS).repartition(5)
    got = catalog.rebuilt_trie(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    same(got, plain_trie(rows))


def test_trie_without_turns(spark):
    df = lambda rows: spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], TURNS)
    assert catalog.rebuilt_trie(df([])).count() == 0
    # 4: crc32 takes turns away and the base is absent, so nothing is left.
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(lone, 0, "user", "gone")]
    same(catalog.rebuilt_trie(df(rows)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"), plain_trie(rows))


def test_digest_of_many_ids_streams(spark):
    ids = [*range(-9_000, 9_000, 2), 10**14]
    ends = spark.createDataFrame([(i, "n") for i in ids] + [(5, "m")], "conv_id bigint, id string").repartition(6)
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    same(prefix_trie.ids_digests(ends), [("n", sha(ids)), ("m", sha([5]))])


# 13 ------------------------------------------------------------------------------------


def xx(i, text):
    seed = xxhash.xxh64_intdigest(struct.pack("<i", i), 42)
    return xxhash.xxh64_intdigest(text.encode(), seed)


def plain_vector(text):
    paragraphs = (text or "").split("\n")
    n, uniform, counters = 0, [0] * 8, [0] * 124
    for p in paragraphs:
        words = re.findall(r"[^\x20\x09-\x0D]+", p)
        for i in range(4):
            h = xx(i, p)
            uniform[2 * i] += h & 0xFFFFFFFF
            uniform[2 * i + 1] += h >> 32
        for found in re.finditer(r"[^\x20\x09-\x0D]+(?:[\x20\x09\x0B-\x0D]+[^\x20\x09-\x0D]+){0,2}", p):
            n += 1
            for i in range(2):
                h = xx(i, found.group())
                for bit in range(62):
                    counters[62 * i + bit] += h >> bit & 1
        assert words or not found_any(p)
    packed = []
    for i in range(2):
        for shift in range(31):
            packed.append(sum((counters[62 * i + shift + 31 * lane] % 2**30) << 31 * lane for lane in range(2)))
    return [n % 2**30, *[u % 2**32 for u in uniform], *packed]


def found_any(p):
    return re.search(r"[^\x20\x09-\x0D]", p)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    signed = lambda v: [2 * ((p >> 31 * lane) % 2**30) - v[0] for p in v[9:] for lane in range(2)]
    x, y = signed(a), signed(b)
    dot = lambda p, q: sum(i * j for i, j in zip(p, q))
    if not dot(x, x) or not dot(y, y):
        return 0.0
    return max(0.0, min(1.0, dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5))


def edited(text, following):
    text, following = text or "", following or ""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def some_documents():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeéß東🙂") for _ in range(rnd.randint(1, 6)))
    rows = [(None, "null id\nfirst of all", "en"), (1, None, "en"), (2, "", None), (3, "\n", "en"), (5, "x", "en"), (8, "two\nlines", "en")]
    for i in range(20, 70):
        rows.append((i, "\n".join(" ".join(word() for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 8))), "en"))
    text = rows[-1][1]
    rows += [(70, text, "fr"), (71, text, "fr"), (72, "\n".join(reversed(text.split("\n"))), "fr"), (90, " ".join(word() for _ in range(20_000)), "en")]
    return rows


def test_fingerprints(spark):
    rows = some_documents()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected = []
    for i, (doc_id, text, _) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        new = edited(text, following)
        own, other, after = plain_vector(text), plain_vector(new), plain_vector(following)
        hexed = lambda v: "".join(f"{x:016x}" for x in v)
        expected.append((doc_id, len(text or ""), hashlib.sha256(new.encode()).hexdigest(), hexed(own), hexed(other), round(plain_likeness(own, other), 9), round(plain_likeness(own, after), 9)))
    got = fingerprints.fingerprints(docs_of(spark, rows).repartition(4))
    text = fingerprints.as_text
    same(got.select("doc_id", "n_chars", "edited_sha256", text(F.col("vector")), text(F.col("edited_vector")), F.round("near_edited", 9), F.round("near_next", 9)), expected)
    by_id = {r[0]: r[3] for r in expected}
    assert by_id[70] == by_id[71] == by_id[72] and len(set(by_id.values())) == len(rows) - 4  # null is empty, copies, another order


def test_paragraphs_go_in_and_out(spark):
    df = spark.createDataFrame([("one two three four\nfive", "six\n\nseven eight", "one two three four\nfive\nsix\n\nseven eight")], "a string, b string, both string")
    df = df.withColumn("k", F.lit(1))
    for name in ("a", "b", "both"):
        df = df.join(fingerprints.vectors(df, name, ["k"], f"v_{name}"), "k")
    a, b, both = F.col("v_a"), F.col("v_b"), F.col("v_both")
    assert df.select(fingerprints.plus(a, b) == both, fingerprints.minus(both, b) == a, fingerprints.minus(both, a) == b).first() == (True, True, True)
    zero = fingerprints.minus(a, a)
    assert df.select(F.exists(zero, lambda x: x != 0), fingerprints.plus(zero, b) == b).first() == (False, True)
    assert df.select(fingerprints.minus(zero, b) == b, fingerprints.plus(fingerprints.minus(zero, b), both) == a).first() == (False, True)


def test_counters_wrap_and_likeness_goes_on(spark):
    df = spark.createDataFrame([("a b c\nd e f\ng h", "a b c\nd e f\nx y")], "a string, b string").withColumn("k", F.lit(1))
    df = df.join(fingerprints.vectors(df, "a", ["k"], "va"), "k").join(fingerprints.vectors(df, "b", ["k"], "vb"), "k")
    # Without as many equal paragraphs as there are on either side and then some: counters below 0, wrapped.
    df = df.join(fingerprints.vectors(df.withColumn("c", F.repeat(F.lit("a b c\n"), 8)), "c", ["k"], "vc"), "k")
    df = df.withColumns({"wa": fingerprints.minus(F.col("va"), F.col("vc")), "wb": fingerprints.minus(F.col("vb"), F.col("vc"))})
    row = df.select("va", "wa", fingerprints.signed(F.col("wa")).alias("s"), fingerprints.signed(F.col("va")).alias("t"), fingerprints.signed(F.col("vc")).alias("u"), fingerprints.plus(F.col("wa"), F.col("vc")).alias("back")).first()
    assert row.wa[0] == 3 - 8 + 2**30 and row.back == row.va
    assert row.s == [x - y for x, y in zip(row.t, row.u)]


def test_fingerprints_of_few(spark):
    assert fingerprints.fingerprints(docs_of(spark, [])).count() == 0
    one = fingerprints.fingerprints(docs_of(spark, [(1, "ab cd", "en")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest() and one.near_next == 1.0
    # Rows of one id have one next document; the least hash speaks for the id.
    rows = [(1, "first text", "en"), (1, "second text", "en"), (1, "second text", "en"), (2, "other", "en")]
    got = fingerprints.fingerprints(docs_of(spark, rows)).collect()
    speaker = min(("first text", "second text"), key=lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64)
    assert sorted((r.doc_id, r.edited_sha256) for r in got) == sorted(
        (i, hashlib.sha256(edited(t, "other" if i == 1 else speaker).encode()).hexdigest()) for i, t, _ in rows
    )
