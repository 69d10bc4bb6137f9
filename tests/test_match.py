import random

import pytest
from pyspark.sql import functions as F

from listwell.functions import similarity as sim
from listwell.operators import components, fuzzy
from listwell.operators import incremental as inc
from listwell.operators import match as mt
from listwell.operators.components import connected_components

SCHEMA = "id bigint, platform string, name string, address string, lat double, lng double, market string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(fields):
    """All matching pairs by comparing every row with every other."""
    out = {}
    for i, a in enumerate(fields):
        for b in fields[i + 1:]:
            if a.market != b.market or a.platform == b.platform:
                continue
            scores = [sim._fuzz(a.name, b.name)]
            if scores[0] < 80:
                continue
            for part in mt.PARTS:
                if a[part] and b[part]:
                    scores.append(sim._fuzz(a[part], b[part]))
            if min(scores) >= 80:
                out[tuple(sorted((a.id, b.id)))] = sum(scores) / len(scores) / 100
    return out


def clusters_of(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root}


def test_matches_across_platforms(spark):
    df = frame(spark, [
        (1, "doordash", "Joe's Pizza", "123 Main St", 40.71, -74.0, "nyc"),
        (2, "grubhub", "Joe's Famous Pizza", "123 Main Street", 40.71, -74.0, "nyc"),
    ])
    rows = mt.rule_based_match(df).collect()
    assert [(r.id_a, r.id_b) for r in rows] == [(1, 2)] and rows[0].name_similarity >= 0.7


@pytest.mark.parametrize("platforms, markets", [(("doordash", "grubhub"), ("nyc", "la")), (("doordash", "doordash"), ("nyc", "nyc"))])
def test_no_match_across_markets_or_within_a_platform(spark, platforms, markets):
    df = frame(spark, [(i + 1, platforms[i], "Joe's Pizza", "", None, None, markets[i]) for i in (0, 1)])
    assert mt.rule_based_match(df).count() == 0
    assert mt.resolve_entities(df)[1].count() == 0


def random_listings(seed, n):
    rng = random.Random(seed)
    names = ["Pizza Roma", "Pizzeria Roma", "Roma", "Sushi Su", "Sushi Su Bar", "De Sushi", "Cafe X", "Cafe", "a b", "b a c", ""]
    streets = ["Overtoom", "Overtoon", "Main Street", "Main", "Kade"]
    rows = []
    for i in range(n):
        number, street, city = rng.choice(["1", "12", "12a", "120", ""]), rng.choice([*streets, ""]), rng.choice(["Amsterdam", "Amsterdm", "Utrecht", ""])
        address = ", ".join(x for x in (f"{street} {number}".strip(), city) if x)
        rows.append((i + 1, rng.choice(["ubereats", "doordash", "grubhub"]), rng.choice(names), address, None, None, rng.choice(["m1", "m2", None])))
    return rows


def test_pairs_are_made_heap_by_heap(spark, monkeypatch):
    monkeypatch.setattr(mt, "HEAP", 4, raising=False)
    df = frame(spark, random_listings(3, 90))
    fields = mt.match_fields(mt.fill_market(df)).collect()
    expected = {pair: round(score, 3) for pair, score in brute_force(fields).items()}
    pairs = mt.rule_based_match(df, digits=3)
    rows = pairs.collect()
    assert len(rows) == len(expected) and {(r.id_a, r.id_b): r.confidence for r in rows} == pytest.approx(expected, abs=0.0011)
    assert all(r.confidence == round(r.confidence, 3) for r in rows)
    assert "heap_a" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_signatures_of_one_platform_are_not_paired(spark):
    df = frame(spark, [(1, "doordash", "Pizza Roma", "", None, None, "m"), (2, "doordash", "Pizza Romas", "", None, None, "m"), (3, "grubhub", "Cafe", "", None, None, "m")])
    sigs = mt.signatures(mt.match_fields(df))
    assert mt.match_signatures(mt.matching_sides(sigs)).count() == 0


@pytest.mark.parametrize("seed, n", [(1, 140), (2, 60)])
def test_equal_to_brute_force(spark, seed, n):
    df =frame(spark, random_listings(seed, n))
    wanted = brute_force(mt.match_fields(mt.fill_market(df)).orderBy("id").collect())
    found = {(r.id_a, r.id_b): r.confidence for r in mt.rule_based_match(df).collect()}
    assert set(found) == set(wanted) and len(wanted) > 30
    assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)
    assert mt.pair_count(df).first().pairs == len(wanted)
    entities, matches = mt.resolve_entities(df)
    got = {r.platform_merchant_id: (r.merchant_id, r.confidence, r.match_method) for r in matches.collect()}
    roots = clusters_of(wanted)
    assert {k: v[0] for k, v in got.items()} == roots
    for member, (root, confidence, method) in got.items():
        direct = wanted.get((root, member))
        assert (method == "field_fuzzy") == (direct is not None)
        assert abs(confidence - (1.0 if direct is None else direct)) < 1e-9
    platform = {r.id: r.platform for r in df.collect()}
    ours = {r.id: r.is_on_our_platform for r in entities.collect()}
    assert ours == {root: any(platform[m] == "ubereats" for m, r in roots.items() if r == root) for root in set(roots.values())}


def test_copies_of_one_listing_are_one_signature(spark):
    """A third of the rows are copies: the cluster graph does not grow with them."""
    copies = [(i, ["ubereats", "doordash"][i % 2], "Pizza Roma", "Overtoom 1, Amsterdam", None, None, "m1") for i in range(1, 3001)]
    others = [(10000 + i, ["ubereats", "doordash"][i % 2], f"Place number {i:05d} {i * 7919 % 10007}", "", None, None, "m1") for i in range(60)]
    fields = mt.match_fields(frame(spark, copies + others))
    sigs = mt.signatures(fields)
    assert sigs.where("name = 'pizza roma'").count() == 1
    edges = mt.key_edges(mt.matching_sides(sigs))
    assert edges.count() < 10 * sigs.count()
    members, _ = mt.cluster_listings(frame(spark, copies + others))
    assert members.where("entity_id = 1").count() == 3000


def test_target_confidence(spark):
    df = frame(spark, [
        (1, "ubereats", "Pizza Roma", "", None, None, "m"), (2, "doordash", "Pizza Roma", "", None, None, "m"),
        (3, "ubereats", "Pizza Roma", "", None, None, "m"), (4, "doordash", "Zzz", "", None, None, "m"),
    ])
    got = {r.id: r.confidence for r in mt.confidence_to_target(df, 1).collect()}
    assert got[1] == 1.0 and got[2] == 1.0 and got[3] == 0.0 and got[4] < 0.5
    assert [r.id for r in mt.rank_by_confidence(mt.confidence_to_target(df, 1), 2).collect()] == [1, 2]


@pytest.mark.parametrize("pairs, count", [([(1, 2), (2, 3)], 1), ([(1, 2), (3, 4)], 2), ([], 0)])
def test_small_clusters(spark, pairs, count):
    labels = connected_components(spark.createDataFrame(pairs, "src bigint, dst bigint"))
    assert labels.select("entity_id").distinct().count() == count
    if pairs == [(1, 2), (2, 3)]:
        assert {r.member_id for r in labels.collect()} == {1, 2, 3}


def test_components_equal_union_find_in_any_edge_order(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    loose = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(170)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + loose]
    rng.shuffle(edges)
    wanted = clusters_of(edges)
    got = {r.member_id: r.entity_id for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == wanted


def test_candidates_are_few_where_names_are_alike(spark):
    """Short names of few syllables in one block, without addresses: what meets is near what matches."""
    rng = random.Random(1)
    syllables = "ro ma su shi piz za ka fe ta co bu rger li no ba mi san to wok thai".split()
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 3))) for _ in range(400)]
    vocabulary += ["restaurant", "cafe", "bar", "the", "pizza", "sushi"] * 6
    names = sorted({" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 3))) for _ in range(900)} | {"a b a", "a a b", "b a a a", "é é", "é"})
    df = spark.createDataFrame([(n, "m") for n in names], "value string, market string")
    wanted = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if sim._fuzz(a, b) >= 80}
    met = {(r.value_a, r.value_b) for r in fuzzy.candidate_pairs(df, df, ["market"], ["market"]).collect()}
    assert wanted <= met and len(met) <= 10 * len(wanted)


def test_cleaning_lies_on_all_cores(spark):
    pm = spark.createDataFrame(
        [(i, "pq"[i % 2], f"Shop {i}", "1 Mill Lane, Hull", 1.0, 1.0, "m") for i in range(64)], "id bigint, platform string, name string, address string, lat double, lng double, market string"
    ).coalesce(1)
    for cleaned in (mt._resolvable(pm), inc._cleaned(pm)):
        spread_over = cleaned._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [id#" in spread_over and f"], {2 * spark.sparkContext.defaultParallelism}" in spread_over
        assert cleaned.count() == 64


def test_rounds_of_components_keep_few_edges_in_few_files(spark, monkeypatch):
    """Each round left a file for every partition of its shuffle, most with no edge or one."""
    parts, keep = [], components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df: (kept := keep(df), parts.append(kept.rdd.getNumPartitions()))[0])
    monkeypatch.setattr(components, "EDGES_A_TASK", 100)
    edges = [(i, i + 1) for i in range(0, 300) if i % 7]
    wanted = clusters_of(edges)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.member_id: r.entity_id for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint").repartition(5)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == wanted
    assert len(parts) > 2 and max(parts[1:]) <= 1 + len(edges) // 100
