"""Corpus operators against plain Python on small tables with nulls, empty texts, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listwell.llm import bpe, catalog, common, mixing, near_lines, near_vectors, ngram_trie, quality, secrets, shingle_join, token_files, url_templates

SF = "/root/testdata/sf0.001"
CLASH = "tie string, row string, size string, at string, s string, w string, copies string, batch string, class string, line string, _row string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE.findall(text or "")


def lower(text):
    return (text or "").encode().lower().decode()


def sentence(rnd, n):
    return " ".join(rnd.choice("the of and tion ering hat was over lorem ipsum dolor sit amet König été 東京".split()) + rnd.choice(["", "a", "er", "on"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    own = [(None, "odd words here"), (7, None), (8, ""), (9, " \n\t "), (10, "Same text again"), (10, "Same text again"), (11, "Same text again"), (12, "a b")]
    for i in range(20, 60):
        own.append((i, "\n".join(sentence(rnd, rnd.randint(1, 30)) for _ in range(rnd.randint(1, 6)))))
    for i in range(60, 90):  # near copies
        text = own[rnd.randint(10, 40)][1].split(" ")
        for _ in range(rnd.randint(0, 2)):
            text[rnd.randrange(len(text))] = rnd.choice(["changed", "", "x\ny"])
        own.append((i, " ".join(text)))
    own.append((95, sentence(rnd, 20_000)))
    return [(i, t, rnd.choice(["en", "fr", None]), rnd.choice(["b", "a", "é", None, "a"]), len(t or ""), *["clash"] * 11) for i, t in own]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


# 1 -------------------------------------------------------------------------------------


def test_transducer_agrees_with_the_library():
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = catalog.tokenizer_file("byte_bpe_multi_50k.tiktoken"), catalog.tokenizer_pattern()
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    ours, rnd = bpe.Codec(path, pattern), random.Random(1)
    texts = ["".join(rnd.choice("abÀ中\x1c\x85  \n't sz1é🙂👩‍💻—$") for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    texts += ["", "a" * 3000, " " * 700 + "x", "中" * 900, "".join(rnd.choice("abcdef") for _ in range(20_000)), "<|endoftext|>"]
    for text in texts:
        ids = ours.encode(text)
        assert list(ids) == theirs.encode_ordinary(text) and ours.decode(ids) == text


def test_whole_token_beats_merges():
    machine = bpe.Transducer({b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"abc": 5})  # no merge makes abc from a and bc's ranks
    assert machine.encode(b"abc") == (5,) and machine.encode(b"abcb") == tuple(bpe.merged(b"abcb", machine.ranks))


def test_utf8_machine_waits_and_replaces():
    assert bpe.utf8_step(b"", "é🙂".encode()[:4]) == ("é", "🙂".encode()[:2])
    assert bpe.utf8_step("🙂".encode()[:2], "🙂".encode()[2:] + b"x") == ("🙂x", b"")
    assert bpe.utf8_step(b"", b"\xc0\xe2a\xff") == ("��a�", b"")


def test_tokens_of_documents(docs, none):
    path, pattern = catalog.tokenizer_file("byte_bpe_multi_50k.tiktoken"), catalog.tokenizer_pattern()
    own, sha = bpe.Codec(path, pattern), lambda x: hashlib.sha256(x).hexdigest()
    expected = []
    for r in docs.collect():
        ids = own.encode(r.text or "")
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    same(bpe.token_digests(docs, path, pattern), expected)
    same(bpe.decode_documents(bpe.encode_documents(docs, path, pattern), path, pattern), [(r.doc_id, r.text or "") for r in docs.collect()])
    assert bpe.token_digests(none, path, pattern).count() == 0


# 2 -------------------------------------------------------------------------------------


def test_rules_and_urls(spark):
    urls = [
        (1, "https://a.b.example.net/en/3", "a.b.example.net", "/en/3", "example.net/en/", "allow"), (2, "http://EXAMPLE.net/fr/", "example.net", "/fr/", "net/", "block"),
        (3, "x://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"), (4, "http://example.com/de/1?x=/#y", "example.com", "/de/1", "example.com/de/", "block"),
        (5, "http://example.com/De/1", "example.com", "/De/1", None, "allow"), (6, None, "", "", None, "allow"), (7, "no scheme", "", "", None, "allow"),
        (8, "a://org/fr/#x://b", "org", "/fr/", "org/fr/", "allow"), (9, "http://h.org?x=1/fr/", "h.org", "", None, "allow"), (9, "http://net", "net", "", None, "allow"),
        (None, "http://a.net/x", "a.net", "/x", "net/", "block"),
    ]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u, *_ in urls], "page_id bigint, url string, host string, template string")
    labels = spark.createDataFrame([], "page_id bigint, bad boolean")
    same(url_templates.judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict"), [(i, h, p, r, v) for i, _, h, p, r, v in urls])
    assert url_templates.judge_urls(pages.limit(0), labels).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    paths = [(i, f"http://h.de/{lang}/{i}", lang == "spam") for i, lang in enumerate(["en", "de", "spam"] * 100)]
    pages = spark.createDataFrame([p[:2] for p in paths], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in paths if i % 2], "page_id bigint, bad boolean")
    judged = url_templates.judge_urls(pages, labels).select("page_id", "template", "verdict").collect()
    assert {r.template for r in judged if paths[r.page_id][2]} == {"/=spam/*/$"}
    assert all((r.verdict == "block") == paths[r.page_id][2] for r in judged)
    twins = spark.createDataFrame([(i, f"http://h.de/{'ab'[i % 2]}/{i}") for i in range(80)], "page_id bigint, url string")
    even = spark.createDataFrame([(i, i % 4 < 1) for i in range(80)] + [(5, False)], "page_id bigint, bad boolean").withColumn("bad", F.col("page_id") % 10 < 2)
    assert {r.template for r in url_templates.judge_urls(twins, even).collect()} == {"/~/*/$"}


def plain_templates(paths, min_share=0.02, min_rows=4, z=1.96, eager=8):
    """Templates of {(host, path): (n, bad, labelled)}, node by node from the top."""
    found = {}

    def split(host, template, level, rows):
        ended = [r for r in rows if len(r[0]) <= level]
        found.update({(host, r[1]): template + "/$" for r in ended})
        rows = [r for r in rows if len(r[0]) > level]
        bad, labelled = sum(r[3] for r in rows), sum(r[4] for r in rows)
        if level >= eager and not 0 < bad < labelled:
            found.update({(host, r[1]): template + "/..." for r in rows})
            return
        n, share, groups = sum(r[2] for r in rows), bad / labelled if labelled else None, collections.defaultdict(list)
        for name, own in itertools.groupby(sorted(rows, key=lambda r: r[0][level]), key=lambda r: r[0][level]):
            own = list(own)
            m, b, k = (sum(r[i] for r in own) for i in (2, 3, 4))
            if m < min_rows or m < min_share * n:
                step = "*"
            elif not k or share is None or abs(b / k - share) <= z * math.sqrt(share * (1 - share) / k):
                step = "~"
            else:
                step = "=" + name
            groups[step] += own
        for step, own in groups.items():
            split(host, f"{template}/{step}", level + 1, own)

    for host in {h for h, _ in paths}:
        split(host, "", 0, [(re.sub("^/", "", p).split("/"), p, *v) for (h, p), v in paths.items() if h == host])
    return found


@pytest.mark.parametrize("eager", [8, 2])
def test_templates_equal_brute_force_at_any_depth(spark, eager):
    rnd = random.Random(7)
    deep = "/".join("abcdefghij")
    paths = {("h", f"/{deep}/{'bad' if i % 2 else 'good'}/x{i}"): (1, i % 2, 1) for i in range(60)}
    for i in range(500):
        path = "".join(f"/{rnd.choice(['a', 'b', 'news', str(rnd.randint(0, 99))])}" for _ in range(rnd.randint(0, 14)))
        labelled = rnd.randint(0, 3)
        bad = sum(rnd.random() < (0.8 if "/b/" in path else 0.1) for _ in range(labelled))
        paths[rnd.choice(["h", "é", ""]), path or "/"] = (labelled + rnd.randint(1, 3), bad, labelled)
    df = spark.createDataFrame([(*k, *v) for k, v in paths.items()], "host string, path string, n bigint, bad bigint, labelled bigint")
    got = {(r.host, r.path): r.template for r in url_templates.templates(df, eager_depth=eager).collect()}
    assert got == plain_templates(paths, eager=eager)
    # A bad branch that begins at the eleventh segment is told from its good sibling.
    assert {t for (h, p), t in got.items() if deep in p and "/bad/" in p}.isdisjoint({t for (h, p), t in got.items() if deep in p and "/good/" in p})


# 3 -------------------------------------------------------------------------------------


def test_elias_fano_and_trie(tmp_path):
    rnd = np.random.default_rng(2)
    for top, n in ((5, 200), (1 << 40, 3000), (1 << 61, 1000), (3, 1)):
        values = np.sort(rnd.integers(0, top, n).astype(np.uint64))
        n_, width, low, high = ngram_trie.EliasFano.code(values)
        own = ngram_trie.EliasFano(n_, width, low, high)
        assert (own.at(np.arange(n)) == values).all()
        asked = np.concatenate([values, rnd.integers(0, top + 2, 500).astype(np.uint64)])
        assert (own.search(asked) == np.searchsorted(values, asked)).all()
    pairs = {(int(c), int(s)): int(k) for c, s, k in zip(rnd.integers(0, 60, 2000), rnd.integers(0, 1 << 40, 2000), rnd.integers(1, 5000, 2000))}
    keys = sorted(pairs)
    c, s = (np.array(x, np.uint64) for x in zip(*keys))
    ngram_trie.Trie.write(str(tmp_path / "t"), c, s, np.array([pairs[k] for k in keys]))
    trie = ngram_trie.Trie(str(tmp_path / "t"))
    assert (trie.look_up(c, s) == ngram_trie.quantised(np.array([pairs[k] for k in keys]), max(pairs.values()))).all()
    assert (trie.look_up(c, s + np.uint64(1)) == 0).all() and (trie.look_up(c + np.uint64(100), s) == 0).all()


def plain_scores(rows, mass):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    single, double = collections.Counter(), collections.Counter()
    for r in rows:
        if not held(r.doc_id):
            own = [*words(lower(r.text)), "\0end"]
            single.update(own)
            double.update(zip(["\0start", *own], own))
    n, v, out = sum(single.values()), len(single), []
    ends = single["\0end"]
    for r in rows:
        own = [*words(lower(r.text)), "\0end"]
        p1 = [(single[w] + 0.5) / (n + 0.5 * (v + 1)) for w in own]
        of = [ends, *(single[w] for w in own)]
        p2 = [(double[a, b] + mass * p) / (c + mass) for a, b, p, c in zip(["\0start", *own], own, p1, of)]
        out.append((r.doc_id, held(r.doc_id), len(own), sum(single[w] > 0 for w in own), n, round(sum(map(math.log10, p1)), 5), sum(map(math.log10, p2))))
    return out


def test_scores_equal_counting(docs, none, monkeypatch):
    monkeypatch.setattr(ngram_trie, "PART_BYTES", 20_000)  # many batches and shards
    found = ngram_trie.score_documents(docs).withColumn("base_score", F.round("base_score", 5)).cache()
    wanted = plain_scores(docs.collect(), ngram_trie.MASS)
    same(found.drop("score"), [r[:-1] for r in wanted])
    # Counts over 127 are rounded: by a hundredth at most here, in single tokens of a text.
    key = lambda r: (r[0] is None, str(r[:-1]))
    for got, own in zip(sorted(map(tuple, found.collect()), key=key), sorted(wanted, key=key)):
        assert abs(got[-1] - own[-1]) <= 1e-9 + 0.005 * own[2]
    assert ngram_trie.score_documents(none).count() == 0


def test_counts_of_any_size_keep_their_share(tmp_path):
    counts = np.array([1, 127, 128, 5_000, 8_323_072, 9_000_000_000, 3], np.int64)
    context, successor = np.arange(7, dtype=np.uint64) * np.uint64(9), np.arange(7, dtype=np.uint64) + np.uint64(1)
    ngram_trie.Trie.write(str(tmp_path / "t"), context, successor, counts)
    trie = ngram_trie.Trie(str(tmp_path / "t"))
    got = ngram_trie.levels(trie.top)[trie.look_up(context, successor)]
    assert trie.top == counts.max() and (np.abs(got / counts - 1) <= [0, 0, 1e-9, 0.08, 0.08, 1e-9, 0]).all()
    assert trie.look_up(context, successor + np.uint64(1)).tolist() == [0] * 7
    small = np.arange(1, 300)
    assert (np.abs(ngram_trie.levels(299)[ngram_trie.quantised(small, 299)] / small - 1) < 0.004).all()


# 4 -------------------------------------------------------------------------------------


def plain_links(vectors, threshold=0.98):
    def sound(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, links = len(vectors), collections.defaultdict(set)
    for i in range(n):
        for j in range(i):
            (_, v, a), (_, w, b) = vectors[i], vectors[j]
            if sound(v, a) and sound(w, b) and a == b and len(v) == len(w):
                v, w = np.array(v, np.float64), np.array(w, np.float64)
                if v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    return links


def reach(n, links):
    group = [None] * n
    for i in range(n):
        if group[i] is None:
            todo, group[i] = [i], i
            while todo:
                for j in links[todo.pop()]:
                    if group[j] is None:
                        group[j] = i
                        todo.append(j)
    return group


def test_vectors_of_any_scale_link(spark):
    """Components near the ends of double precision: squares overflow or vanish, the cosine does not."""
    own = [(i, [(3.0 + i % 2 * 0.01) * s, 4.0 * s, -2.0 * s], 1) for i, s in enumerate(s for s in (1.0, 1e160, 1e-170, 1.7e307, 5e-300) for _ in range(2))]
    own += [(50, [1e160, -1e160, 1e160], 1), (51, [1e-170, 0.0, 0.0], 1), (None, [3.0, 4.0, -2.0], 1), (0, [3.0, 4.0, -2.0], 1)]
    df = spark.createDataFrame(own, "vec_id bigint, embedding array<double>, label int")
    got = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_vectors(df).collect()}
    assert got == {(i, 11, 0) for i in [*range(10), None, 0]} | {(50, 0, 50), (51, 0, 51)}


@pytest.mark.parametrize("tile", [3, 1000])
def test_vectors_equal_brute_force(spark, tile):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 20))
    own = [(i, (centres[i % 12] + rnd.normal(size=20) * rnd.choice([0, 0.1, 0.2])).astype(np.float32).tolist(), int(i % 12 > 5)) for i in range(240)]
    own += [(300 + i, own[0][1], 0) for i in range(30)] + [(400, [2 * x for x in own[0][1]], 0), (401, own[0][1], None), (402, None, 1), (403, [0.0] * 20, 1), (404, [], 1)]
    own += [(405, [float("nan")] * 20, 1), (406, [None, 1.0], 1), (407, [1.0, 1.0], 1), (408, [2.0, 2.0], 1), (409, [-0.0, 1.0], 0), (410, [0.0, 1.0], 0), (411, [1e30, 1e30], 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in own], "vec_id bigint, embedding array<float>, label int, id string, key string").repartition(4)
    links = plain_links(own)
    group = reach(len(own), links)
    ids = [r[0] for r in own]
    low = {g: min(i for i, h in zip(ids, group) if h == g) for g in set(group)}
    same(near_vectors.near_vectors(df, tile_rows=tile), [(i, len(links[k]), low[group[k]], low[group[k]] == i) for k, i in enumerate(ids)])
    assert near_vectors.near_vectors(df.limit(0)).count() == 0 and near_vectors.near_vectors(df.where("embedding is null")).count() == 1


# 5 -------------------------------------------------------------------------------------


def word_edits(a, b):
    if abs(len(a) - len(b)) > 1:
        return 2
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return 0 if a == b else 1 if a[i + 1 :] == b[i + 1 :] and len(a) == len(b) or a[i:] == b[i + 1 :] else 2


def test_lines_equal_brute_force(spark, docs, none):
    rnd, lines = random.Random(8), []
    for _ in range(60):
        base = [rnd.choice("ab") for _ in range(rnd.choice([9, 10, 11, 12, 13]))]
        lines.append(base)
    table = [(d, "\n".join([" ".join(lines[rnd.randrange(60)]), "", sentence(rnd, 4), "short one"][: rnd.randint(1, 4)]), *["x"] * 2) for d in range(120)]
    own = spark.createDataFrame(table, "doc_id bigint, text string, number string, line string").repartition(6)
    for df in (own, docs.select("doc_id", "text", "tie", "line", "row")):
        hashed = {(r.doc_id, r.text): r.h for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
        everything = sorted({(r.doc_id is None, r.doc_id or 0, hashed[r.doc_id, r.text], k, tuple(words(line))) for r in df.collect() for k, line in enumerate((r.text or "").split("\n")) if words(line)})
        seen, gone = [], collections.defaultdict(list)
        for no_id, i, h, k, line in everything:
            if any(line == s or min(len(line), len(s)) >= 10 and word_edits(line, s) <= 1 for s in seen):
                gone[no_id, i, h].append(k)
            seen.append(line)
        expected = []
        for r in df.collect():
            numbers = gone.get((r.doc_id is None, r.doc_id or 0, hashed[r.doc_id, r.text]))
            text = r.text if not numbers else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in numbers)
            expected.append((r.doc_id, text, numbers))
        same(near_lines.near_lines(df).select("doc_id", "text", "dropped_numbers"), expected)
    assert near_lines.near_lines(none).count() == 0


def test_repeated_rows_lose_the_same_lines(spark):
    """Rows equal in id and text whose line came earlier, or comes twice within the row."""
    table = [(1, "seen before\nfirst own line"), *[(2, "kept one\nseen before\nlast one")] * 3, *[(3, "twice here\nother line\ntwice here")] * 2, *[(None, "seen before")] * 2, (4, "kept one")]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    earlier, lost = set(), {}
    for d, text in sorted(set(table), key=lambda r: (r[0] is None, r[0] or 0)):
        lost[d] = []
        for k, line in enumerate(text.split("\n")):
            lost[d] += [k] if line in earlier else []
            earlier.add(line)
    expected = [(d, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost[d]), lost[d] or None) for d, t in table]
    same(near_lines.near_lines(df), expected)
    assert [lost[2], lost[3], lost[None], lost[4]] == [[1], [2], [0], [0]]


def test_texts_without_an_id_keep_their_own_lines(spark):
    """Rows that share an id, null here, are told apart by their whole texts, not by few bits of a hash."""
    table = [(None, f"unique words of text number {i}\nand one line that all have") for i in range(400)] + [(1, "and one line that all have"), (None, None), (None, "")]
    got = near_lines.near_lines(spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r.text, r.dropped_numbers) for r in got if r.text and "unique" in r.text) == sorted((t.split("\n")[0], [1]) for _, t in table if t and "unique" in t)
    ranks = near_lines._ranked_texts(spark.createDataFrame(table, "_d bigint, t string"), "t").where("_d IS NULL").select("_t").distinct().count()
    assert ranks == 401


# 6 -------------------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, target, open_, left = {s: i % 3 + 1 for i, s in enumerate(order)}, {}, set(sizes), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mix_of_documents(docs, none):
    found = mixing.mix(docs, block_words=8).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    targets, taken = plain_targets(sizes), collections.Counter()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(r.doc_id), len(words(r.text))) for r in docs.collect())
    for r in found:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.02 * targets[s] + 40, s
    again = mixing.mix(docs.repartition(3), block_words=8).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert mixing.mix(none).count() == 0
    texts = mixing.mixed_documents(docs, block_words=8)
    assert texts.columns == docs.columns
    by_id = collections.Counter()
    for r in texts.collect():
        by_id[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    wanted = collections.Counter()
    for r in found:
        wanted[r.doc_id] += r.taken
    assert +by_id == +wanted
    assert mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("mixing_of", [mixing.mix, mixing.mixed_documents])
def test_blocks_of_a_mix_are_not_broadcast(docs, mixing_of):
    """A row of a source makes any number of slots: what is joined by block or by document meets by key."""
    plan = mixing_of(docs, block_words=8)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line]
    by_block = [line for line in joins if "block#" in line]
    by_document = [line for line in joins if "isnull(" in line]  # ids are compared with nulls
    assert len(by_block) == 1 and len(by_document) == 1
    assert all("SortMergeJoin" in line for line in by_block + by_document)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_permutations(spark, n):
    got = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3)).alias("x"))
    assert sorted(r.x for r in got.collect()) == list(range(n))


# 7 -------------------------------------------------------------------------------------


def test_shingle_join_equals_brute_force(spark, docs, none):
    rnd = random.Random(3)
    base = [sentence(rnd, 60).split() for _ in range(6)]
    own = []
    for i in range(150):
        text = list(base[i % 6])
        for _ in range(rnd.randint(0, 4)):
            text[rnd.randrange(60)] = f"w{rnd.randrange(9)}"
        own.append((i, " ".join(text[: rnd.choice([60, 60, 58, 50, 3])]), "x", "y"))
    table = spark.createDataFrame(own, "doc_id bigint, text string, class string, token string").repartition(4)
    for df, n, percent in ((table, 4, 85), (table, 5, 80), (docs, 4, 85), (table, 4, 50)):
        rows = df.select("doc_id", "text").collect()
        sets = []
        for r in rows:
            w = words(lower(r.text))
            sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
        links = collections.defaultdict(set)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    links[i].add(j)
                    links[j].add(i)
        group = reach(len(rows), links)
        low = {g: min((r.doc_id for r, h in zip(rows, group) if h == g and r.doc_id is not None), default=None) for g in set(group)}
        found = shingle_join.shingle_join(df, n, percent)
        same(found.select("doc_id", "n_shingles", "component_id"), [(r.doc_id, len(s), low[g]) for r, s, g in zip(rows, sets, group)])
        assert found.where("first").select("component_id").distinct().count() == len(set(low.values()))
    assert shingle_join.shingle_join(none).count() == 0


# 8 -------------------------------------------------------------------------------------


def test_quality_measures(docs, none):
    expected = []
    for r in docs.collect():
        w, t = words(r.text), r.text or ""
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        in_again = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        lines = [x for x in t.split("\n") if words(x)]
        expected.append((r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(in_again), len(w) < 50 or 100 * len(in_again) > 50 * len(w)))
    same(quality.quality(docs).select("doc_id", *quality.BASE, "base_failed"), expected)
    assert quality.quality(none).count() == 0


def test_quality_distances(spark):
    rnd = random.Random(4)
    good = [sentence(rnd, 200) for _ in range(30)]
    bad = [" ".join(w + "$$$" for w in good[0].split()), good[1].upper(), " ".join(f"{rnd.random()}" for _ in range(200))]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in quality.quality(df).collect()}
    assert all(found[i].kept for i in range(30)) and not any(found[i].kept for i in range(30, 33))
    share = collections.defaultdict(collections.Counter)
    for t in good + bad:
        share["all"].update(lower(t).split())
    top = sorted(share["all"].items(), key=lambda x: (-x[1], x[0].encode()))[: quality.COMMON]
    total = sum(share["all"].values())
    own = collections.Counter(lower(good[5]).split())
    p, q = [own[w] / 200 for w, _ in top], [k / total for _, k in top]
    p, q = [*p, 1 - sum(p)], [*q, 1 - sum(q)]
    js = sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)) / 2
    assert found[5].word_distance == pytest.approx(math.sqrt(js))


def plain_divergence(p, q):
    half = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum(half(a, b) + half(b, a) for a, b in zip(p, q)) / 2))


def plain_quality(rows):
    """[(char distance, word distance, kept)] of (text, lang) rows, by the definitions: every distinct good text of a language weighs one."""

    def bars(t):
        w = "".join(words(t))
        kind = lambda c: (
            "upper" if unicodedata.category(c) == "Lu" else "letter" if unicodedata.category(c)[0] == "L" else "digit" if c in "0123456789"
            else "mark" if c in ".,;:!?'\"()-" else "symbol" if c in "#*$%&|<>" else "other"
        )
        count = collections.Counter(map(kind, w))
        return [len(t) - len(w), *(count[k] for k in ("letter", "upper", "digit", "mark", "symbol", "other"))]

    def failed(w):
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        again = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        return len(w) < 50 or 100 * len(again) > 50 * len(w)

    bad = {t: failed(words(t)) for t, _ in rows}
    chars, shares = {}, {}
    for lang in {lang for _, lang in rows}:
        good = sorted({t for t, own in rows if own == lang and not bad[t]})
        shapes = [[x / sum(bars(t)) for x in bars(t)] for t in good]
        chars[lang] = [sum(x) / len(good) for x in zip(*shapes)] if good else None
        weight = collections.Counter()
        for t in good:
            for w, n in collections.Counter(words(lower(t))).items():
                weight[w] += n / len(words(t))
        top = sorted(weight.items(), key=lambda x: (-round(x[1], 9), x[0].encode()))[: quality.COMMON]
        shares[lang] = [(w, x / len(good)) for w, x in top]
    out = []
    for t, lang in rows:
        w = words(lower(t))
        if len(w) < 50 or chars[lang] is None:
            out.append((None, None, not bad[t]))
            continue
        count = collections.Counter(w)
        p, q = [count[x] / len(w) for x, _ in shares[lang]], [x for _, x in shares[lang]]
        own = bars(t)
        char, word = plain_divergence([x / sum(own) for x in own], chars[lang]), plain_divergence([*p, max(0, 1 - sum(p))], [*q, max(0, 1 - sum(q))])
        out.append((char, word, not (bad[t] or char > 0.27 or word > 0.19 + 1.3 / math.sqrt(len(w)))))
    return out


def test_quality_equals_brute_force(spark):
    rnd = random.Random(12)
    texts = [sentence(rnd, rnd.randint(30, 400)) for _ in range(80)]
    texts += [" ".join(w + rnd.choice(["", "$", "9", "!"]) for w in texts[i].split()) for i in range(10)] + [t.upper() for t in texts[:5]] + [" ".join(f"{rnd.random()}" for _ in range(120))] * 7
    texts += ["\n".join([texts[0]] * 3), sentence(rnd, 20_000), "", " \n ", "東京 " * 80, " ".join(rnd.choice("αβγδε") * 4 + str(i) for i in range(90))]
    rows = [(t, rnd.choice(["en", "fr"]) if i % 9 else None) for i, t in enumerate(texts)] + [(texts[3], "en")] * 4 + [("x y z " * 40, "only bad")] * 2
    df = spark.createDataFrame([(i, t or None, lang) for i, (t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string").repartition(5)
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    wanted = plain_quality(rows)
    assert len(got) == len(rows) and {r.kept for r in got.values()} == {True, False}
    for i, (char, word, kept) in enumerate(wanted):
        assert got[i].kept == kept and (got[i].char_distance is None) == (char is None)
        if char is not None:
            assert got[i].char_distance == pytest.approx(char, abs=1e-6) and got[i].word_distance == pytest.approx(word, abs=1e-6)


@pytest.mark.parametrize("junk", ["copies", "long", "failed"])
def test_quality_reference_is_not_moved_by_junk(spark, junk):
    """Over a third of a language is one junk text, many times or a long one, or junk that fails the base rules."""
    rnd = random.Random(9)
    good = [sentence(rnd, 200) for _ in range(30)]
    word = lambda: "".join(rnd.choice("BCDFGHJKLM#$%") for _ in range(9))
    bad = {"copies": [" ".join(word() for _ in range(200))] * 20, "long": [" ".join(word() for _ in range(6000))], "failed": [" ".join(["$$$$ #### BUY NOW"] * 60 + [str(i)]) for i in range(60)]}[junk]
    table = [(i, t, "en") for i, t in enumerate(good + bad)] + [(900, "xx xx xx " * 60, "fr"), (901, "few words", "fr")]
    found = {r.doc_id: r for r in quality.quality(spark.createDataFrame(table, "doc_id bigint, text string, lang string").repartition(4)).collect()}
    assert len(found) == len(table)
    assert [i for i in range(30) if not found[i].kept] == []
    assert not any(found[i].kept for i in range(30, len(good + bad)))
    assert [(found[i].kept, found[i].char_distance, found[i].word_distance) for i in (900, 901)] == [(False, None, None)] * 2


# 9 -------------------------------------------------------------------------------------


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 12 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return out


def plain_entropy(found):
    for pattern, window, least in secrets.CLASSES:
        if re.search(pattern, found):
            break
    hot = []
    for i in range(len(found) - window + 1):
        counts = collections.Counter(found[i : i + window])
        if -sum(c / window * math.log2(c / window) for c in counts.values()) >= least:
            hot.append(i)
    return (hot[0], hot[-1] + window) if hot else None


def plain_added(text):
    """Entropy spans: what is no base span and no part with an allowed word is looked through."""
    blank = lambda m: " " * len(m[0])
    rest = re.sub(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}""", blank, text)
    words = "example sample dummy placeholder xxxx abcdefgh 01234567 12345678".split()
    rest = re.sub("[A-Za-z0-9+_=-]+", lambda m: blank(m) if any(w in m[0].lower() for w in words) else m[0], rest)
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", rest):
        public = re.match("(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|sha(1|256|512)[-_=]", m[0])
        hot = re.search("[0-9]", m[0]) and not public and plain_entropy(m[0])
        if hot:
            out.append((m.start() + hot[0], 3, m.start() + hot[1]))
    return [x for x in out if not any(s < x[2] and x[0] < e for s, _, e in plain_secrets(text))]


def test_long_runs_and_many_hits_take_time_in_proportion(spark):
    rnd = random.Random(9)
    run = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(300_000))
    hits = " ".join(f"{rnd.getrandbits(80):020x}" for _ in range(20_000))
    start = time.time()
    got = secrets.secrets(spark.createDataFrame([(None, run), (2, hits), (3, "a" * 300_000)], "doc_id bigint, text string")).collect()
    assert time.time() - start < 60
    assert {(r.doc_id, r.n_hex, r.n_entropy) for r in got} == {(None, 0, 1), (2, 20_000, 0), (3, 1, 0)}
    assert next(r.spans for r in got if r.doc_id == 2).split(",")[-1] == f"hex:{len(hits) - 20}:{len(hits)}"


def test_secrets(spark):
    rnd = random.Random(6)
    key = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    alphabet = "ABCabcxyz019+/_=-"
    parts = ["password=", "Token : '", "api_key", "APIKEY=", "AKIA", "secret==", "0123456789abcdef", "é🙂", "\n", "example", "9" * 30, "Zq8vT2mK4pX7wL1nB6cR3", "AKIA" + "Q7" * 9]
    texts = [None, "", "token=secret=abcdefghijkl", "password: token = abcdefghijklmnop", "AKIAAKIA" + "A" * 11, "aB3dE5fG7hI9jK1lM3nO5pQ7 and abcdefgh1jklmnopqrstuvw"]
    texts += ["".join(rnd.choice([rnd.choice(parts), " ", "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40)))]) for _ in range(rnd.randint(1, 25))) for _ in range(300)]
    texts += [f"AKIA{'Q7' * 8}/{key}", f"api/examples/{key}", f"{key}-0123456789abcdef", f"my-sample-{key}", f"x/{key}/y"]
    df = spark.createDataFrame([(i % 50, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, a string, spans string")
    line = lambda spans: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    expected = []
    for i, t in enumerate(texts):
        base, extra = plain_secrets(t or ""), plain_added(t or "")
        count = collections.Counter(k for _, k, _ in base)
        expected.append((i % 50, count[0], count[1], count[2], len(extra), line(base), line(base + extra)))
    assert [r[4] for r in expected[-5:]] == [1, 1, 1, 0, 1]
    same(secrets.secrets(df), expected)
    assert sum(r[4] for r in expected) > 20 and secrets.secrets(df.limit(0)).count() == 0


# 10 ------------------------------------------------------------------------------------


def test_planes_round_trip():
    rnd = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 1 << 32), (token_files.BLOCK + 3, 49408)):
        ids = rnd.integers(0, top, n).astype("<u4")
        assert (token_files.from_planes(token_files.to_planes(ids), n) == ids).all()


def test_words_encoded_apart_equal_the_whole_text():
    path, rnd = catalog.tokenizer_file("word_bpe_49k.json"), random.Random(4)
    theirs = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    theirs.encode_special_tokens = True
    letters = "abzAZ09'stremvdl.,!-_<|>/w\x00\x01\x1c\x7f\x85\xa0éÉßΣσςİıﬁǺ\u030a가각👍🏽½Ⅷ٣ \n\t"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["", "<|endoftext|>a <|startoftext|>", "ΟΔΟΣ ΑΣ", "don't 'tis 'S it'S", "x" * 500 + " é" * 500]
    own = token_files.encoder(path)
    for text in texts + texts[:50]:
        assert own(text.encode().split()).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_words_of_a_batch_go_to_the_library_once(monkeypatch):
    """They went one by one, and again in each document once the memo was full."""
    path, rnd = catalog.tokenizer_file("word_bpe_49k.json"), random.Random(6)
    theirs = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    theirs.encode_special_tokens = True
    for most in (1_000_000, 7):
        monkeypatch.setattr(token_files, "MEMO_WORDS", most)
        monkeypatch.setattr(token_files, "MEMO_PIECES", most)
        own = token_files.Encoder(path)
        pieces, work = [], own.pieces.work
        own.pieces.work = lambda some: (pieces.extend(some.to_pylist()), work(some))[1]
        vocabulary = ["".join(rnd.choice("abcdé'0K,.東") for _ in range(rnd.randint(1, 9))) for _ in range(900)] + ["x" * 200, "0", "it's", "\x01", "a\x85b"]
        batches = [[None, "", " \t", *(" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 80))) + rnd.choice(["", "\n", "\x1c"]) for _ in range(60))] for _ in range(4)]
        for texts in batches:
            before = len(pieces)
            column = pa.array(["left out", *texts]).slice(1)
            assert [x.tolist() for x in own.of_texts(column)] == [theirs.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert len(pieces) - before == len(set(pieces[before:]))
        short = [p for p in pieces if len(p) <= 64]
        assert most < 10 or len(short) == len(set(short))
        assert own.of_texts(pa.array([], pa.string())) == [] and own([]).tolist() == []


def test_token_files(spark, docs, none, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_file("word_bpe_49k.json")
    theirs = Tokenizer.from_file(path)
    token_files.write_token_files(docs, str(tmp_path / "t"), path)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, hashes[r.doc_id, r.text]))
    expected, start = [], 0
    for r in ordered:
        ids = [*theirs.encode(r.text or "", add_special_tokens=False).ids, 2]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same(token_files.read_digests(spark, str(tmp_path / "t")), expected)
    read = token_files.read_token_files(spark, str(tmp_path / "t")).collect()
    assert sorted((str(r.doc_id), r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in read) == sorted((str(a), *b) for a, *b in expected)
    token_files.write_token_files(none, str(tmp_path / "e"), path)
    assert token_files.read_digests(spark, str(tmp_path / "e")).count() == 0


# pipeline ------------------------------------------------------------------------------


def test_stages_keep_columns(spark, docs, none):
    import corpus_pipeline

    for frame in (docs, none):
        own = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, own, SF).cache()
            assert after.columns == frame.columns, name
            assert after.count() >= 0
            own = after
        corpus_pipeline.STAGES[-1][1](spark, own, SF).count()


def test_near_duplicate_stage_keeps_one(spark, docs):
    import corpus_pipeline

    kept = corpus_pipeline.keep_one_of_each(spark, docs, SF).collect()
    same_text = [r for r in kept if r.text == "Same text again"]
    assert [r.doc_id for r in same_text] == [10]


def plain_without_repeated_lines(rows):
    """{doc_id: text} without the lines of which an equal one, or one that differs in a word, came earlier."""
    seen, out = [], {}
    for i, text in sorted(rows.items()):
        kept = []
        for line in text.split("\n"):
            own = words(line)
            if not own or not any(own == s or min(len(own), len(s)) >= 10 and word_edits(own, s) <= 1 for s in seen):
                kept.append(line)
            if own:
                seen.append(own)
        if words("\n".join(kept)) or not words(text):
            out[i] = "\n".join(kept)
    return out


def plain_one_of_each(rows, n=5, share=0.8):
    sets = {}
    for i, text in rows.items():
        w = words(lower(text))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    low = {i: i for i in rows}
    for _ in rows:
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and len(a & b) >= share * len(a | b) - 1e-12:
                    low[i] = low[j] = min(low[i], low[j])
    return {i: text for i, text in rows.items() if low[i] == i}


def test_pipeline_equals_brute_force(spark, tmp_path):
    """All stages but the mix against plain Python; of the mix, what it may take from where."""
    import corpus_pipeline
    import tiktoken

    rnd = random.Random(21)
    table = []
    for i in range(70):
        lines = [sentence(rnd, rnd.randint(8, 40)) for _ in range(rnd.randint(2, 7))]
        if table and rnd.random() < 0.4:  # a near copy, or a line from elsewhere, or nearly
            lines = table[rnd.randrange(len(table))][1].split("\n")[: rnd.choice([2, 9])] + lines[:1]
        if rnd.random() < 0.3:
            w = lines[0].split(" ")
            w[rnd.randrange(len(w))] = "changed"
            lines[0] = " ".join(w)
        if rnd.random() < 0.1:
            lines = ["$$$ 1 2 3 ### 4 5 6 &&& %%%" * 12]
        table.append((i, "\n".join(lines)))
    table += [(200 + i, table[3][1] + f" tail{i}") for i in range(5)]
    for i in range(8):  # long lines, two words apart
        w = sentence(rnd, 200).split(" ")
        table.append((300 + 2 * i, " ".join(w)))
        table.append((301 + 2 * i, " ".join([*w[:90], "other", *w[91:150], "words", *w[151:]])))
    full = [(i, t, rnd.choice(["en", "fr"]), rnd.choice(["a", "b", None]), len(t)) for i, t in table]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(full, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))

    good = {r[0]: r[1] for r, (_, _, kept) in zip(full, plain_quality([(r[1], r[2]) for r in full])) if kept}
    cut = plain_without_repeated_lines(good)
    one = plain_one_of_each(cut)
    assert 5 < len(one) < len(cut) <= len(good) < len(full) and cut != good
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, str(tmp_path)))
        seen[name] = docs.collect()
    told = {r[0]: r for r in full}
    for name, wanted in (("quality", good), ("line_dedup", cut), ("near_duplicates", one)):
        assert sorted((r.doc_id, r.text, r.lang, r.n_chars) for r in seen[name]) == sorted((i, t, told[i][2], len(t)) for i, t in wanted.items())
    mixed = seen["mix"]
    assert {r.doc_id for r in mixed} <= set(one) and max(collections.Counter(r.doc_id for r in mixed).values()) <= 3
    assert all(set(words(r.text)) <= set(words(one[r.doc_id])) and len(words(r.text)) <= len(words(one[r.doc_id])) for r in mixed)
    theirs = tiktoken.Encoding("own", pat_str=catalog.tokenizer_pattern(), mergeable_ranks=bpe.read_ranks(catalog.tokenizer_file("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    expected = [(r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())) for r in mixed for ids in [theirs.encode_ordinary(r.text or "")]]
    assert sorted(map(tuple, seen["tokens"])) == sorted(expected)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(expected)
