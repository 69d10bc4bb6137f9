import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listwell.functions import similarity as sim
from listwell.operators.fuzzy import candidate_pairs, similar_pairs


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


words = st.text(alphabet="abc ", max_size=12).map(lambda s: " ".join(s.split()))


@given(words, words)
@settings(max_examples=300, deadline=None)
def test_lcs_and_score_properties(a, b):
    assert sim.lcs_length(a, b) == slow_lcs(a, b)
    score = sim._fuzz(a, b)
    assert 0 <= score <= 100
    assert score == sim._fuzz(b, a)
    assert sim._fuzz(a, a) == 100


def test_scores_of_names(spark):
    pairs = [("Joe's Pizza", "Joe's Pizza"), ("Joe's Pizza", "Joe's Famous Pizza"), ("Joe's Pizza", "Thai Garden"), ("JOE'S PIZZA", "joe's pizza"), ("", ""), ("", "x")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r.s for r in df.select("i", sim.name_similarity(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()]
    assert got[0] == 1.0 and got[1] >= 0.8 and got[2] < 0.5 and got[3] == 1.0 and got[4:] == [1.0, 0.0]


def test_distance_and_score(spark):
    lit = F.lit
    row = spark.range(1).select(
        sim.geo_distance_m(lit(40.7128), lit(-74.006), lit(40.7128), lit(-74.006)).alias("same"),
        sim.geo_distance_m(lit(40.7128), lit(-74.006), lit(40.7137), lit(-74.006)).alias("near"),
        sim.geo_distance_m(lit(40.7128), lit(-74.006), lit(None).cast("double"), lit(None).cast("double")).alias("none"),
        sim.score_match(lit(1.0), lit(0.0), lit(True)).alias("perfect"),
        sim.score_match(lit(0.9), lit(None).cast("double"), lit(False)).alias("name_only"),
        sim.score_match(lit(0.9), lit(10.0), lit(False)).alias("close"),
        sim.score_match(lit(0.9), lit(140.0), lit(False)).alias("far"),
    ).first()
    assert row.same == 0.0 and 90 < row.near < 110 and row.none is None
    assert row.perfect == 1.0 and row.name_only == 0.9 and row.close > row.far


def test_geo_point_needs_two_nonzero_numbers(spark):
    df = spark.createDataFrame([(1.5, 2.0), (0.0, 2.0), (None, 2.0), (float("nan"), 2.0)], "lat double, lng double")
    assert [r[0] for r in df.select(sim.geo_point(F.col("lat"), F.col("lng"))).collect()] == ["SRID=4326;POINT(2.0 1.5)", None, None, None]
    assert [r[0] for r in df.select(sim.geo_valid(F.col("lat"), F.col("lng"))).collect()] == [True, True, False, False]


def dictionaries(seed):
    """Small dictionaries of many kinds: short and long texts, one-letter words, shared words, typos."""
    rng = random.Random(seed)
    makers = [
        lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 7))),
        lambda: " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 2))) for _ in range(rng.randint(1, 6))),
        lambda: " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(1, 4))),
        lambda: " ".join(rng.choice(["de", "pizza", "pizzeria", "roma", "romana", "sushi", "house", "x", "la"]) for _ in range(rng.randint(1, 5))),
    ]
    for block in range(60):
        make = makers[block % len(makers)]
        texts = {make() for _ in range(25)}
        for t in list(texts)[:8]:  # typos
            i = rng.randrange(len(t))
            texts.add(" ".join((t[:i] + rng.choice("abxz ") + t[i + rng.randint(0, 1):]).split()) or t)
        for t in sorted(texts):
            yield block, t


def test_similarity_join_finds_every_pair(spark):
    rows = list(dictionaries(11))
    df = spark.createDataFrame(rows, "block int, value string")
    found = {(r.block, r.value_a, r.value_b): r.score for r in similar_pairs(df, df, ["block"], ["block"]).collect()}
    by_block = {}
    for block, text in rows:
        by_block.setdefault(block, []).append(text)
    wanted = {
        (block, *sorted((x, y))): sim._fuzz(x, y)
        for block, texts in by_block.items()
        for i, x in enumerate(texts)
        for y in texts[i + 1:]
        if sim._fuzz(x, y) >= 80
    }
    assert set(found) == set(wanted)
    assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)
    assert len(wanted) > 500


def test_a_word_in_every_text_does_not_pair_them_all(spark):
    """All texts share one word and differ in a longer one: candidates stay near the number of texts."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = {"pizza " + "".join(rng.choice(letters) for _ in range(12)) for _ in range(400)}
    df = spark.createDataFrame([(1, t) for t in texts], "block int, value string")
    through_words = candidate_pairs(df, df, ["block"], ["block"])
    total = len(texts) * (len(texts) - 1) // 2
    assert through_words.count() < total / 2
