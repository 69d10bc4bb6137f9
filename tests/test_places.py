import math
import random

import pytest

from listwell.operators import places as pl

SCHEMA = "id bigint, platform string, lat double, lng double"


def apart(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(h)))


def spots(seed, radius):
    """Points in clumps of about the radius, at the poles, the date line, the equator and elsewhere."""
    rnd, step = random.Random(seed), math.degrees(radius / 6371008.8)
    found = [(90.0, 10.0), (90.0, -170.0), (-90.0, 5.0), (52.3, 180.0), (52.3, -180.0), (0.001, 0.001)]
    for lat, lng in ((90 - step, 0), (-90 + step, 100), (52.3, 180), (-17.0, -180), (0.0005, 0.0005), (40.0, -74.0), (71.0, 179.9999)):
        for _ in range(25):
            y = max(-90.0, min(90.0, lat + rnd.uniform(-2, 2) * step))
            x = lng + rnd.uniform(-2, 2) * step / max(math.cos(math.radians(y)), 1e-3)
            found.append((y, (x + 180) % 360 - 180))
    return [p for p in found if p[0] != 0 and p[1] != 0]


@pytest.mark.parametrize("radius, crowd", [(400.0, 4_000), (400.0, 3), (25_000.0, 10), (0.0, 4_000), (3e7, 50)])
def test_links_equal_brute_force(spark, monkeypatch, radius, crowd):
    monkeypatch.setattr(pl, "CUBE_PLACES", crowd)
    points = list(dict.fromkeys(spots(1, min(radius, 25_000) or 1.0)))
    df = spark.createDataFrame(points, "lat double, lng double").repartition(4)
    got = [tuple(r) for r in pl.near_links(df, radius).collect()]
    wanted = {(*a, *b): apart(a, b) for a in points for b in points if apart(a, b) <= radius}
    assert len(got) == len(wanted) > len(points) // 2
    assert all(abs(wanted[r[:4]] - r[4]) < 1e-3 for r in got)


def rows_of(seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", None]), *p) for i, p in enumerate(spots(seed, 400.0))]
    rows += [(1000 + i, rnd.choice(["a", "b"]), 52.37, 4.9) for i in range(200)]  # a hot place
    rows += [(2000, "a", None, 4.9), (2001, "a", float("nan"), 4.9), (2002, "b", 91.0, 4.9), (2003, "b", 0.0, 4.9), (2004, None, 52.37, 4.9)]
    return rows


def test_nearest_and_pairs(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    usable = [r for r in rows if r[0] < 2000 or r[0] == 2004]
    wanted = {r[0]: (0, None, None) for r in rows}
    for a in usable:
        near = [(round(apart(a[2:], b[2:]), 3), b[0]) for b in usable if a[1] != b[1] and apart(a[2:], b[2:]) <= 400]
        if near:
            wanted[a[0]] = (len(near), min(near)[1], min(near)[0])
    got = {r.id: (r.near, r.nearest_id, r.nearest_m) for r in pl.nearest_elsewhere(df).collect()}
    assert got.keys() == wanted.keys()
    for i, (n, other, distance) in wanted.items():
        assert got[i][:2] == (n, other) and (distance is None) == (got[i][2] is None)
        assert distance is None or abs(distance - got[i][2]) < 1e-2
    pairs = pl.near_places(df).collect()
    seen = {((r.lat_a, r.lng_a), (r.lat_b, r.lng_b)): (r.listings_a, r.listings_b) for r in pairs}
    at = {}
    for r in usable:
        at.setdefault(r[2:], []).append(r[0])
    wanted = {(p, q): (len(at[p]), len(at[q])) for p in at for q in at if p < q and apart(p, q) <= 400}
    assert seen == wanted and len(pairs) == len(seen)


def test_nothing_and_bad_distance(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pl.near_places(none).count() == 0 and pl.nearest_elsewhere(none).count() == 0
    with pytest.raises(ValueError):
        pl.near_links(none, -1.0)
