import json

import pytest
from pyspark.sql import functions as F

from listwell.operators import extract as ex

def card(n, street="", inner="ul"):
    """A store card of our own making: the link wraps nothing but a heading, the address stands in a list further down."""
    return f"""<div class="_hs tile">
  <b><a data-testid="store-card" href="/be-fr/store/chez-margot-{n}/mgt{n:03d}?mod=2#top"><h3>Chez Margot {n}</h3></a></b>
  <em data-test="store-title">Chez Margot {n}</em><i>Crêpes</i>
  <{inner}><li><span>{street}</span></li></{inner}>
</div>"""


def script(script_id, value):
    body = value if isinstance(value, str) else json.dumps(value)
    return f'<html><script id="{script_id}" type="application/json">{body}</script></html>'


STORE = {
    "id": "st-81", "name": "Noodle Barn", "address": {"formattedAddress": "9 Quay Lane, Hull", "lat": 53.74, "lng": -0.33}, "priceRange": "$$$",
    "tags": [{"name": "Noodles"}, {}, {"name": "Soup"}], "averageRating": 3.9, "numRatings": "41", "deliveryFee": 1.25, "estimatedDeliveryTime": 35, "isSponsored": True,
}
SHOP = {
    "name": "Bakkerij Zuid", "uniqueName": "bakkerij-zuid", "rating": {"score": 4.1, "count": 77},
    "address": {"firstLine": "Meir 8", "postalCode": "2000 AN", "city": "Antwerpen", "location": {"coordinates": [4.4, 51.22]}},
}
FAR_STATE = json.dumps({"feed": [{"card": {"uuid": "FF9", "note": "n" * 2400, "location": {"latitude": "50.9", "longitude": "-1.4"}, "address": "Dock Road 4"}}]})

PAGES = {
    "stores": ("doordash", script("__NEXT_DATA__", {"props": {"pageProps": {"stores": [STORE]}}})),
    "nested stores": ("doordash", script("__NEXT_DATA__", {"props": {"pageProps": {"stores": [], "searchResults": {"items": [{"storeId": 7, "name": "S", "address": "flat 1", "averageRating": "4.1 stars"}]}}}})),
    "cards": ("doordash", '<article><h2>Curry Corner</h2><p><a href="/store/4411/">Menu</a></p></article>'),
    "broken state": ("doordash", script("__NEXT_DATA__", "{oops") + '<article><h3>Kept</h3></article>'),
    "map": ("justeattakeaway", script("__NEXT_DATA__", {"restaurantData": {"r-17": SHOP, "bare": {"name": "Bare"}, "no": 1}})),
    "deep map": ("justeattakeaway", script("__REACT_QUERY_STATE__", {"queries": [{"state": {"data": {"restaurantData": {"r-99": SHOP}}}}]})),
    "places": ("justeattakeaway", script("__NEXT_DATA__", {"q": [{"name": "Loose", "id": 5, "location": {"lat": 1.5, "lng": "-2.5"}, "address": {"streetName": "S"}}]})),
    "card": ("ubereats", "<main>" + "".join(card(n, f"Nieuwe Kade {n}, 1000 Brussel, NL") for n in range(1, 31)) + card(31, inner="ol") + "</main>"),
    "link": ("ubereats", '<nav><a href="/be-fr/store/quick-lunch/Q_1-x">\n Quick  Lunch • 12 min</a></nav><a href="/store/">none</a>'),
    "twice": ("ubereats", '<a href="/store/x/AA"></a><p><a href="/store/x/AA">second</a></p><p><a href="/store/x/BB" aria-label="Bee"></a></p>'),
    "near": ("ubereats", '<a href="/store/x/NN7">A</a>' + script("__REACT_QUERY_STATE__", {"s": [{"uuid": "NN7", "latitude": 52.5, "lng": -4.25}]})),
    "far": ("ubereats", '<a href="/store/x/FF9">A</a>' + script("__REDUX_STATE__", '"' + FAR_STATE.replace('"', "\\u0022") + '"')),
    "placeholder": ("grubhub", script("x", {"restaurants": [{"name": "Wrap Stop"}]})),
    "unknown": ("elsewhere", "<html></html>"),
    **{f"empty {p}": (p, "<html></html>") for p in ("doordash", "grubhub", "justeattakeaway", "ubereats")},
    "comment": ("doordash", "<!-- " + script("__NEXT_DATA__", {"props": {"pageProps": {"stores": [STORE]}}}) + " -->"),
}


@pytest.fixture(scope="module")
def listings(spark):
    rows = [(name, platform, "amsterdam", html) for name, (platform, html) in PAGES.items()]
    df = spark.createDataFrame(rows, "page_key string, platform string, market string, html string").coalesce(2)
    out = {}
    for r in ex.extract_listings(df).orderBy("page_key", "pos").collect():
        out.setdefault(r.page_key, []).append(r)
    assert [r.page_key for r in ex.unknown_platforms(df).collect()] == ["unknown"]
    return out


def test_store_list(listings):
    (m,) = listings["stores"]
    assert (m.platform, m.platform_id, m.name, m.lat, m.lng) == ("doordash", "st-81", "Noodle Barn", 53.74, -0.33)
    assert (m.cuisine_tags, m.rating, m.review_count, m.delivery_fee) == (["Noodles", "Soup"], 3.9, 41, 1.25)
    assert (m.price_bucket, m.estimated_delivery_min, m.is_promoted) == ("$$$", 35, True)
    assert m.raw_url == "https://www.doordash.com/store/st-81/" and m.market == "amsterdam"


def test_nested_store_list(listings):
    (m,) = listings["nested stores"]
    assert (m.platform_id, m.address, m.rating) == ("7", "flat 1", 4.1)
    assert (m.price_bucket, m.estimated_delivery_min, m.is_promoted) == (None, None, False)


def test_cards_only_without_stores(listings):
    (m,) = listings["cards"]
    assert (m.name, m.platform_id, m.raw_url) == ("Curry Corner", "4411", "https://www.doordash.com/store/4411/")
    assert [m.name for m in listings["broken state"]] == ["Kept"]
    assert listings["broken state"][0].platform_id == "Kept"


def test_restaurant_maps(listings):
    m, bare = listings["map"]
    assert (m.platform_id, m.name, m.address) == ("r-17", "Bakkerij Zuid", "Meir 8, 2000 AN, Antwerpen")
    assert (m.rating, m.review_count, m.lat, m.lng) == (4.1, 77, 51.22, 4.4)
    assert m.raw_url == "https://www.thuisbezorgd.nl/en/menu/bakkerij-zuid"
    assert (bare.platform_id, bare.address, bare.lat, bare.raw_url) == ("bare", "", 0.0, "https://www.thuisbezorgd.nl/en/menu/bare")
    assert [m.platform_id for m in listings["deep map"]] == ["r-99"]


def test_loose_places(listings):
    (m,) = listings["places"]
    assert (m.platform_id, m.name, m.lat, m.lng, m.address) == ("5", "Loose", 1.5, -2.5, "S")


def test_store_card(listings):
    got = [(m.platform_id, m.name, m.address) for m in listings["card"]]
    assert got == [(f"mgt{n:03d}", f"Chez Margot {n}", f"Nieuwe Kade {n}, 1000 Brussel, NL" if n < 31 else "") for n in range(1, 32)]
    assert listings["card"][0].raw_url == "https://www.ubereats.com/be-fr/store/chez-margot-1/mgt001?mod=2#top"


def test_bare_links(listings):
    (m,) = listings["link"]
    assert (m.platform_id, m.name) == ("Q_1-x", "Quick Lunch")


def test_first_link_of_a_store_counts(listings):
    # All three links share the body as card but the first has no name of its own.
    assert [(m.platform_id, m.name) for m in listings["twice"]] == [("BB", "Bee")]


def test_coordinates_near_the_id_and_from_the_object(listings):
    (m,) = listings["near"]
    assert (m.lat, m.lng) == (52.5, -4.25)
    (m,) = listings["far"]
    assert (m.lat, m.lng, m.address) == (50.9, -1.4, "Dock Road 4")


def test_pages_without_listings(listings):
    assert not [k for k in listings if k.startswith("empty") or k in ("placeholder", "unknown", "comment")]


def test_details(spark):
    ld = lambda x: f'<script type="application/ld+json">{json.dumps(x)}</script>'
    business = {"@type": "Restaurant", "address": {"streetAddress": "A 1", "postalCode": "1011AA", "addressLocality": "Ams"}, "geo": {"latitude": "52.1", "longitude": -4}}
    no_geo = {"@type": "Store", "address": {"streetAddress": "B 2"}}
    state = script("__REDUX_STATE__", {"q": [{"address": {"formattedAddress": "F 1"}, "location": {"lat": 1.0, "lng": 2.0}}]})
    shop = script("__NEXT_DATA__", {"props": {"pageProps": {"initialState": {"restaurant": {"restaurant": {"location": {"streetName": "S", "postalCode": "1000", "lat": 1.5, "lng": 2.5}}}}}}})
    cases = [
        ("ubereats", ld({"@type": "Thing"}) + ld([business]), ("A 1, 1011AA, Ams", 52.1, -4.0)),
        ("ubereats", ld(no_geo) + state, ("F 1", 1.0, 2.0)),
        ("ubereats", ld(no_geo), ("B 2", None, None)),
        ("ubereats", '<button aria-label="Adres"><b>Foo</b> 12</button>', ("Foo, 12", None, None)),
        ("ubereats", "<p>Opening info<span>Kade 12</span></p>", ("Opening infoKade 12", None, None)),
        ("ubereats", "<html></html>", (None, None, None)),
        ("justeattakeaway", ld(business), ("A 1, 1011AA, Ams", 52.1, -4.0)),
        ("justeattakeaway", shop, ("S, 1000", 1.5, 2.5)),
        ("justeattakeaway", "<section><h2>The details</h2><p>a</p><p>b</p><p>c</p><p>d</p></section>", ("a, b, c", None, None)),
    ]
    df = spark.createDataFrame([(i, p, h) for i, (p, h, _) in enumerate(cases)] + [(99, "doordash", "")], "id int, platform string, html string").coalesce(2)
    got = {r.id: (r.address, r.lat, r.lng) for r in ex.extract_details(df).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_many_stores_of_one_page_state(spark):
    """Two hundred cards and a state of a megabyte: searched once, opened once, and nothing of it goes along with a card."""
    stores = [{"id": f"u{n:03d}x", "pad": "p" * 2_500, "location": {"latitude": 50 + n / 1000, "longitude": -(n + 1) / 1000}, "address": {"streetAddress": f"Row {n}"}, "more": "m" * 2_500} for n in range(200)]
    html = "".join(f'<a href="/store/s/u{n:03d}x">Store {n}</a>' for n in range(200)) + script("__REDUX_STATE__", {"stores": stores})
    df = spark.createDataFrame([("k", "ubereats", "m", html)], "page_key string, platform string, market string, html string")
    rows = ex.ubereats_listings(df.withColumnRenamed("market", "page_market"))
    got = {r.m.platform_id: (r.m.lat, r.m.lng) for r in rows.collect()}
    # No coordinates are within reach of an id: each store's object gives its own.
    assert got == {f"u{n:03d}x": (50 + n / 1000, -(n + 1) / 1000) for n in range(200)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "s0" not in plan.split("Generate")[0] and "s1" not in plan.split("Generate")[0]


def test_ids_found_in_one_pass():
    from listwell.functions import jsonwalk

    text = "xx ab abc é bc ab"
    ids = ["ab", "abc", "bc", "é", "none"]
    assert jsonwalk.first_places(text, ids) == {i: text.index(i) for i in ids if i in text}
    root = {"a": [{"id": 1}, {"uuid": "u", "slug": "1", "n": 2}], "b": '{"id": "u", "late": true}'}
    for wanted in ("1", "u", "zz"):
        one = jsonwalk.object_with_id(root, wanted)
        assert jsonwalk.objects_with_ids(root, ["1", "u", "zz"]).get(wanted, jsonwalk.ABSENT) == one


# ---- Work per page: once, and on all cores ---------------------------------------------


def _planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_state_is_made_once_for_all_that_is_read_of_it(spark, table):
    import __spark_entry__ as entry
    from listwell.plans.catalog.pages import STATE

    plan = _planned(entry.queries()["coords_near_id"](spark, "/root/testdata/sf0.001"))
    assert plan.count("repeat(") == STATE.count("repeat(")
    spot = spark.range(1).select(ex.coords_in(ex.window_near(F.lit('"lat": 1.5, x1 "lng": 2.5'), F.lit("x1"))).alias("p")).first().p
    assert (spot.lat, spot.lng) == (1.5, 2.5)
    none = spark.range(1).select(ex.coords_in(ex.window_near(F.lit("x1"), F.lit("y"))).alias("p"), ex.window_near(F.lit(None).cast("string"), F.lit("y")).alias("w")).first()
    assert none.p is None and none.w is None


def test_a_page_is_searched_for_its_scripts_once(spark, table):
    from listwell.plans.catalog.pages import FAR, as_page

    pages = as_page(spark.read.parquet("/root/testdata/sf0.001/part.parquet"), FAR).select("page_key", F.lit("m").alias("page_market"), "html")
    assert _planned(ex.ubereats_listings(pages)).count("regexp_extract_all(") == 2


def test_pages_made_of_rows_lie_on_all_cores(spark, table):
    from listwell.plans.catalog.pages import CARDS, as_page

    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    assert part.rdd.getNumPartitions() == 1
    assert as_page(part, CARDS, "doordash").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
