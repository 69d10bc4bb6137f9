"""From page tables to listing rows.

Everything about a page happens within its row, so the jobs have no shuffle. A page is
read once whatever its platform; the Arrow helpers get null for pages that are not theirs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions import dom, jsonwalk
from listwell.functions import text as tx

# Script ids, JSON keys and URL patterns of the pages.
NEXT, REACT, REDUX = "__NEXT_DATA__", "__REACT_QUERY_STATE__", "__REDUX_STATE__"
STORE_KEYS = ("stores", "storeList", "searchResults", "initialData")
NESTED_KEYS = ("stores", "items", "results")
BUSINESS_TYPES = ("Restaurant", "FoodEstablishment", "Store")
MARKER_KEYS = ("restaurantData", NEXT, REACT)
LAT_IN_STATE = r'(?i)(?:latitude|lat)["\\]*:\s*(-?\d+\.\d+)'
LNG_IN_STATE = r'(?i)(?:longitude|lng)["\\]*:\s*(-?\d+\.\d+)'
STATE_WINDOW = 1000

# A comment matches as a whole and leaves both groups empty.
SCRIPT = r"(?is)<!--.*?-->|<(script\b[^>]*)>(.*?)</script\s*>"


# ---- Scripts -----------------------------------------------------------------------


def _attribute(attrs: Column, name: str) -> Column:
    pattern = rf"""(?is)(?:^|\s){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(attrs, pattern, g) for g in (1, 2, 3)])


def scripts(html: Column) -> Column:
    """Array of (id, type, body) of the script elements outside comments."""
    both = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1)).alias("attrs"),
        F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(2)).alias("body"),
    )
    return F.transform(
        F.filter(both, lambda s: s["attrs"] != ""),
        lambda s: F.struct(
            _attribute(s["attrs"], "id").alias("id"), _attribute(s["attrs"], "type").alias("type"), s["body"].alias("body")
        ),
    )


def script_body(found: Column, script_id: str) -> Column:
    """Body of the first script with the id; null if there is none or it is empty."""
    first = F.get(F.filter(found, lambda s: s["id"] == script_id), F.lit(0))
    return F.nullif(first["body"], F.lit(""))


def script_payloads(pages: DataFrame, key: str = "page_key") -> DataFrame:
    """One row per script element."""
    return pages.select(key, F.posexplode(scripts(F.col("html"))).alias("pos", "s")).select(
        key, "pos", F.col("s.id").alias("script_id"), F.col("s.type").alias("script_type"), F.col("s.body").alias("payload")
    )


def page_script_profile(pages: DataFrame, key: str = "page_key") -> DataFrame:
    """Script ids with their lengths, and which marker keys a page holds."""
    with_id = F.filter(scripts(F.col("html")), lambda s: s["id"] != "")
    marks = [F.col("html").contains(k).alias(f"has_{k.strip('_').lower()}") for k in MARKER_KEYS]
    lengths = F.transform(with_id, lambda s: F.concat(s["id"], F.lit(":"), F.length(s["body"]).cast("string")))
    return pages.select(key, lengths.alias("script_ids"), *marks)


# ---- Variant access ----------------------------------------------------------------


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _filled(v: Column, path: str) -> Column:
    return F.nullif(_text(v, path), F.lit(""))


def _float(v: Column, path: str) -> Column:
    """Number as it is; text by :func:`text.safe_float`."""
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", tx.safe_float(_text(v, path))).otherwise(F.try_variant_get(v, path, "double"))


def _coord(v: Column, path: str) -> Column:
    """Number as it is; text with its sign kept."""
    return F.coalesce(F.try_variant_get(v, path, "double"), tx.safe_coord(_text(v, path)))


def _int(v: Column, path: str) -> Column:
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", tx.safe_int(_text(v, path))).otherwise(F.try_variant_get(v, path, "double").cast("bigint"))


def _truthy(c: Column) -> Column:
    """Null and 0 count as absent."""
    return F.nullif(c, F.lit(0.0))


def listing(
    platform: str, platform_id: Column, name: Column, raw_url: Column, *, address: Column | None = None, lat: Column | None = None,
    lng: Column | None = None, tags: Column | None = None, rating: Column | None = None, reviews: Column | None = None, fee: Column | None = None,
    price_bucket: Column | None = None, minutes: Column | None = None, promoted: Column | None = None,
) -> Column:
    """Struct of the listing columns; what a page does not say is empty."""
    none = lambda kind: F.lit(None).cast(kind)
    or_none = lambda c, kind: none(kind) if c is None else c.cast(kind)
    return F.struct(
        F.lit(platform).alias("platform"),
        F.coalesce(platform_id, F.lit("")).alias("platform_id"),
        F.coalesce(name, F.lit("")).alias("name"),
        (F.lit("") if address is None else F.coalesce(address, F.lit(""))).alias("address"),
        or_none(lat, "double").alias("lat"),
        or_none(lng, "double").alias("lng"),
        (F.array().cast("array<string>") if tags is None else F.coalesce(tags, F.array().cast("array<string>"))).alias("cuisine_tags"),
        tx.clamp_rating(or_none(rating, "double")).alias("rating"),
        or_none(reviews, "bigint").alias("review_count"),
        or_none(price_bucket, "string").alias("price_bucket"),
        or_none(fee, "double").alias("delivery_fee"),
        or_none(minutes, "int").alias("estimated_delivery_min"),
        (F.lit(False) if promoted is None else F.coalesce(promoted, F.lit(False))).alias("is_promoted"),
        raw_url.alias("raw_url"),
    )


# ---- Structured business data --------------------------------------------------------


def business(found: Column) -> Column:
    """(address, lat, lng) from ld+json scripts: the first with an address, else the last business."""
    lists = F.filter(found, lambda s: (s["type"] == "application/ld+json") & (s["body"] != ""))

    def read(s: Column) -> Column:
        def fields(v: Column) -> Column:
            parts = F.concat_ws(
                ", ", *[_filled(v, f"$.address.{k}") for k in ("streetAddress", "postalCode", "addressLocality")]
            )
            return F.when(
                _text(v, '$["@type"]').isin(*BUSINESS_TYPES),
                F.struct(
                    F.nullif(parts, F.lit("")).alias("address"),
                    _coord(v, "$.geo.latitude").alias("lat"),
                    _coord(v, "$.geo.longitude").alias("lng"),
                ),
            )

        parsed = F.try_parse_json(s["body"])
        return tx.let(F.coalesce(F.try_variant_get(parsed, "$[0]", "variant"), parsed), fields)

    typed = F.filter(F.transform(lists, read), lambda b: b.isNotNull())
    return tx.let(typed, lambda bs: F.coalesce(F.get(F.filter(bs, lambda b: b["address"].isNotNull()), F.lit(0)), F.try_element_at(bs, F.lit(-1))))


def ldjson_business(pages: DataFrame, key: str = "page_key") -> DataFrame:
    return pages.select(key, business(scripts(F.col("html"))).alias("b")).where("b IS NOT NULL").select(key, "b.*")


# ---- Platform extractors ------------------------------------------------------------


def _store_array(state: Column) -> Column:
    """First non-empty list among the known places."""
    lists = []
    for key in STORE_KEYS:
        at = [f"$.props.pageProps.{key}", *[f"$.props.pageProps.{key}.{k}" for k in NESTED_KEYS]]
        lists.append(F.coalesce(*[F.try_variant_get(state, p, "array<variant>") for p in at]))
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])


def _store_listing(s: Column) -> Column:
    tags = F.transform(F.try_variant_get(s, "$.tags", "array<variant>"), lambda t: _filled(t, "$.name"))
    flat = F.when(F.schema_of_variant(F.try_variant_get(s, "$.address", "variant")) == "STRING", _text(s, "$.address"))
    return listing(
        "doordash", F.coalesce(_text(s, "$.id"), _text(s, "$.storeId")), _text(s, "$.name"),
        F.concat(F.lit("https://www.doordash.com/store/"), F.coalesce(_text(s, "$.id"), F.lit("")), F.lit("/")),
        address=F.coalesce(_text(s, "$.address.formattedAddress"), flat), lat=_coord(s, "$.address.lat"), lng=_coord(s, "$.address.lng"),
        tags=F.filter(tags, lambda t: t.isNotNull()), rating=_float(s, "$.averageRating"), reviews=_int(s, "$.numRatings"),
        fee=_float(s, "$.deliveryFee"), price_bucket=_filled(s, "$.priceRange"), minutes=_int(s, "$.estimatedDeliveryTime"),
        promoted=F.try_variant_get(s, "$.isSponsored", "boolean"),
    )


def _card_listing(c: Column) -> Column:
    path = F.regexp_replace(c["href"], "/+$", "")
    absolute = F.when(c["href"].startswith("/"), F.concat(F.lit("https://www.doordash.com"), c["href"])).otherwise(c["href"])
    sid = F.when(c["href"] == "", c["name"]).otherwise(F.element_at(F.split(path, "/"), -1))
    return listing("doordash", sid, c["name"], absolute)


def doordash_listings(pages: DataFrame) -> DataFrame:
    """Stores of the page state; only where there are none, the cards."""
    staged = pages.withColumn("state", F.try_parse_json(script_body(scripts(F.col("html")), NEXT)))
    staged = staged.withColumn("stores", _store_array(F.col("state")))
    staged = staged.withColumn("cards", dom.store_cards_of(F.when(F.col("stores").isNull(), F.col("html"))))
    either = F.coalesce(
        F.transform("stores", lambda s: F.struct(s.alias("store"), F.lit(None).cast("struct<name: string, href: string>").alias("card"))),
        F.transform("cards", lambda c: F.struct(F.lit(None).cast("variant").alias("store"), c.alias("card"))),
    )
    rows = staged.select("page_key", "page_market", F.posexplode(either).alias("pos", "e"))
    m = F.when(F.col("e.card").isNotNull(), _card_listing(F.col("e.card"))).otherwise(_store_listing(F.col("e.store")))
    return rows.select("page_key", "page_market", "pos", m.alias("m"))


def _jet_known(key: Column, v: Column) -> Column:
    """Listing of one ``restaurantData`` entry."""
    slug = F.coalesce(_text(v, "$.uniqueName"), _text(v, "$.primarySlug"), key)
    parts = F.concat_ws(", ", *[_filled(v, f"$.address.{k}") for k in ("firstLine", "postalCode", "city")])
    point = F.try_variant_get(v, "$.address.location.coordinates", "array<variant>")
    at = lambda i: F.when(point.isNull(), 0.0).otherwise(_coord(v, f"$.address.location.coordinates[{i}]"))
    return listing(
        "justeattakeaway", key, _text(v, "$.name"), F.concat(F.lit("https://www.thuisbezorgd.nl/en/menu/"), slug),
        address=parts, lat=at(1), lng=at(0), rating=_float(v, "$.rating.score"), reviews=_int(v, "$.rating.count"),
    )


def _jet_place(s: Column) -> Column:
    """Listing of an object with a name and a location."""
    sid = F.coalesce(_text(s, "$.id"), _text(s, "$.primarySlug"), _text(s, "$.name"))
    slug = F.coalesce(_text(s, "$.primarySlug"), _text(s, "$.id"), F.lit("None"))
    either = lambda a, b: F.coalesce(_truthy(_coord(s, f"$.location.{a}")), _coord(s, f"$.location.{b}"))
    return listing(
        "justeattakeaway", sid, _text(s, "$.name"), F.concat(F.lit("https://www.thuisbezorgd.nl/en/menu/"), slug),
        address=_text(s, "$.address.streetName"), lat=either("lat", "latitude"), lng=either("lng", "longitude"),
        rating=_float(s, "$.rating.score"), reviews=_int(s, "$.rating.count"),
    )


def jet_listings(pages: DataFrame) -> DataFrame:
    """The known map or loose objects, of the first script that has either."""
    found = F.col("scripts")
    staged = pages.withColumn("scripts", scripts(F.col("html")))
    staged = staged.withColumn("r", jsonwalk.restaurants_of(script_body(found, NEXT), script_body(found, REACT)))
    known = F.transform(
        F.map_entries(F.from_json("r.known", "map<string, variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("v"))
    )
    loose = F.transform(F.col("r.places"), lambda t: F.struct(F.lit(None).cast("string").alias("key"), F.try_parse_json(t).alias("v")))
    rows = staged.select("page_key", "page_market", F.posexplode(F.coalesce(known, loose)).alias("pos", "e"))
    rows = rows.where(F.schema_of_variant("e.v").startswith("OBJECT"))
    key, v = F.col("e.key"), F.col("e.v")
    return rows.select("page_key", "page_market", "pos", F.when(key.isNotNull(), _jet_known(key, v)).otherwise(_jet_place(v)).alias("m"))


def window_near(state: Column, store_id: Column) -> Column:
    """Up to a thousand characters on both sides of the first mention of the id; null if there is none."""

    def around(s: Column) -> Column:
        start = lambda at: F.greatest(at - 1 - STATE_WINDOW, F.lit(0))
        return tx.let(F.instr(s, store_id), lambda at: F.when(at > 0, F.substring(s, start(at) + 1, at - 1 + STATE_WINDOW - start(at))))

    return tx.let(state, around)


def coords_in(window: Column) -> Column:
    """(lat, lng) written in the text, if both are there and neither is 0."""
    number = lambda w, pattern: F.nullif(F.regexp_extract(w, pattern, 1), F.lit("")).try_cast("double")
    both = lambda w: F.struct(number(w, LAT_IN_STATE).alias("lat"), number(w, LNG_IN_STATE).alias("lng"))
    return tx.let(window, lambda w: tx.let(both(w), usable))


def usable(at: Column) -> Column:
    """(lat, lng) if both are there and neither is 0."""
    spot = F.struct(at["lat"].alias("lat"), at["lng"].alias("lng"))
    return F.when((at["lat"] != 0) & (at["lng"] != 0), spot)


def _place_of(store: Column) -> Column:
    """(lat, lng, address) of a store object given as JSON text."""

    def fields(v: Column) -> Column:
        either = lambda a, b: F.coalesce(
            *[F.coalesce(_truthy(_coord(v, f"$.{p}{a}")), _coord(v, f"$.{p}{b}")) for p in ("location.", "")]
        )
        flat = F.when(F.schema_of_variant(F.try_variant_get(v, "$.address", "variant")) == "STRING", _text(v, "$.address"))
        return F.struct(
            either("latitude", "lat").alias("lat"), either("longitude", "lng").alias("lng"),
            F.coalesce(_filled(v, "$.address.streetAddress"), _filled(v, "$.address.formattedAddress"), flat).alias("address"),
        )

    return tx.let(F.try_parse_json(store), fields)


def store_id_of(href: Column) -> Column:
    path = F.regexp_replace(F.substring_index(href, "?", 1), "/+$", "")
    return F.element_at(F.split(path, "/"), -1)


def address_of_card(texts: Column) -> Column:
    """Shortest text of a card that looks like an address."""
    return tx.shortest(F.filter(F.transform(texts, tx.collapse), tx.looks_like_address))


def first_named(links: Column) -> Column:
    """Links with their store id, the first of each store, though it may turn out to have no name."""
    known = F.filter(
        F.transform(links, lambda c: c.withField("id", store_id_of(c["href"]))),
        lambda c: (c["id"] != "") & (c["id"] != "store"),
    )

    def first(cards: Column) -> Column:
        return tx.let(
            F.transform(cards, lambda c: c["id"]),
            lambda ids: F.filter(cards, lambda c, i: F.array_position(ids, c["id"]) == i + 1),
        )

    return tx.let(known, first)


def card_name(c: Column) -> Column:
    options = [c["title"], F.substring_index(c["link_text"], "•", 1), c["link_label"]]
    return F.coalesce(*[F.nullif(tx.collapse(o), F.lit("")) for o in options])


def ubereats_listings(pages: DataFrame) -> DataFrame:
    """Store cards; coordinates from the page states, by nearness and else by the store's object.

    The states are searched once for the ids of all cards, and opened once for those that have no
    coordinates nearby. Only what was found goes on when the page is split into its cards.
    """
    # The scripts are a column of their own, so that the page is searched for them once.
    found = F.col("scripts")
    staged = pages.withColumn("scripts", scripts(F.col("html"))).withColumns({"s0": script_body(found, REACT), "s1": script_body(found, REDUX)})
    staged = staged.withColumn("links", dom.store_links_of(F.col("html"))).withColumn("cards", first_named(F.col("links")))
    ids = F.transform("cards", lambda c: c["id"])
    told = jsonwalk.stores_in_states(ids, F.col("s0"), F.col("s1"), STATE_WINDOW, LAT_IN_STATE, LNG_IN_STATE)
    each = F.arrays_zip(F.col("cards").alias("c"), told.alias("t"))
    rows = staged.select("page_key", "page_market", F.posexplode(each).alias("pos", "e"))
    rows = rows.select("page_key", "page_market", "pos", "e.c", *[F.col(f"e.t.{x}").alias(x) for x in ("n0", "n1", "o0", "o1")])
    rows = rows.withColumns({n: usable(F.col(n)) for n in ("n0", "n1")})
    rows = rows.withColumn("name", card_name(F.col("c"))).where("name IS NOT NULL")
    rows = rows.withColumns({f"d{i}": F.when(F.col(f"o{i}").isNotNull(), _place_of(F.col(f"o{i}"))) for i in (0, 1)})
    at = F.coalesce("n0", usable(F.col("d0")), "n1", usable(F.col("d1")))
    stated = F.coalesce(F.nullif(F.col("d0.address"), F.lit("")), F.col("d1.address"))
    href, label = F.col("c.href"), F.col("c.rating_label")
    m = listing(
        "ubereats", F.col("c.id"), F.col("name"),
        F.when(href.startswith("/"), F.concat(F.lit("https://www.ubereats.com"), href)).otherwise(href),
        address=F.coalesce(address_of_card(F.col("c.texts")), stated), lat=at["lat"], lng=at["lng"],
        rating=tx.rating_in_label(label), reviews=tx.reviews_in_label(label),
    )
    return rows.select("page_key", "page_market", "pos", m.alias("m"))


def no_listings(pages: DataFrame) -> DataFrame:
    """A platform whose listing pages are not read yet."""
    m = listing("grubhub", F.lit(""), F.lit(""), F.lit(""))
    return pages.where(F.lit(False)).select("page_key", "page_market", F.lit(0).alias("pos"), m.alias("m"))


Extractor = Callable[[DataFrame], DataFrame]
LISTING_EXTRACTORS: dict[str, Extractor] = {
    "doordash": doordash_listings,
    "grubhub": no_listings,
    "justeattakeaway": jet_listings,
    "ubereats": ubereats_listings,
}


def extract_listings(pages: DataFrame, registry: dict[str, Extractor] | None = None) -> DataFrame:
    """Listing rows of all pages (page_key, platform, market, html), with their position on the page.

    One branch per platform: on a page table partitioned by platform each reads its own
    folders. Pages of platforms without an extractor give no rows; see
    :func:`unknown_platforms`.
    """
    branches = [
        extractor(pages.where(F.col("platform") == platform).select("page_key", F.col("market").alias("page_market"), "html"))
        for platform, extractor in (LISTING_EXTRACTORS if registry is None else registry).items()
    ]
    rows = reduce(DataFrame.unionByName, branches)
    return rows.select("page_key", "pos", "m.*", F.col("page_market").alias("market"))


def unknown_platforms(pages: DataFrame, registry: dict | None = None) -> DataFrame:
    """Keys of pages no extractor is registered for."""
    known = LISTING_EXTRACTORS if registry is None else registry
    return pages.where(~F.col("platform").isin(*known)).select("page_key", "platform", F.lit("no extractor").alias("reason"))


# ---- Detail pages --------------------------------------------------------------------


def _detail(address: Column, lat: Column, lng: Column) -> Column:
    return F.struct(address.alias("address"), lat.cast("double").alias("lat"), lng.cast("double").alias("lng"))


def _complete(b: Column) -> Column:
    return b["address"].isNotNull() & _truthy(b["lat"]).isNotNull()


def ubereats_detail(pages: DataFrame) -> DataFrame:
    """ld+json if complete; else what the states say; the address as a last resort from the page text."""
    found = scripts(F.col("html"))
    staged = pages.withColumns({"_b": business(found), "_s0": script_body(found, REACT), "_s1": script_body(found, REDUX)})
    staged = staged.withColumn("_open", ~F.coalesce(_complete(F.col("_b")), F.lit(False)))
    state = lambda s: jsonwalk.addressed_object_of(F.when(F.col("_open"), tx.unescape_state(F.col(s))))
    staged = staged.withColumns({"_o0": state("_s0"), "_o1": state("_s1")}).drop("_s0", "_s1")
    place = lambda o: F.when(F.col(o).isNotNull(), _place_of(F.col(o)))
    staged = staged.withColumns({"_p0": place("_o0"), "_p1": place("_o1")}).drop("_o0", "_o1")
    # The second state is consulted only if the first gave no address.
    settled = F.nullif(F.col("_p0.address"), F.lit("")).isNotNull()
    staged = staged.withColumn("_p", F.when(settled, F.col("_p0")).otherwise(F.coalesce("_p1", "_p0")))
    staged = staged.withColumn("_a", F.coalesce(F.nullif(F.col("_p.address"), F.lit("")), F.col("_b.address")))
    staged = staged.withColumn("_t", dom.address_block_of(F.when(F.col("_open") & F.col("_a").isNull(), F.col("html"))))
    at = lambda c: F.when(F.col("_p").isNull(), F.col(f"_b.{c}")).otherwise(F.col(f"_p.{c}"))
    return staged.withColumn("d", _detail(F.coalesce("_a", "_t"), at("lat"), at("lng"))).drop(
        "_b", "_open", "_p0", "_p1", "_p", "_a", "_t"
    )


def jet_detail(pages: DataFrame) -> DataFrame:
    """ld+json if complete; else the restaurant of the page state; else the details block."""
    found = scripts(F.col("html"))
    state = F.try_parse_json(script_body(found, NEXT))
    staged = pages.withColumns({"_b": business(found), "_v": state}).withColumn("_open", ~F.coalesce(_complete(F.col("_b")), F.lit(False)))
    props = "$.props.pageProps"
    options = [f"{props}.restaurant", f"{props}.initialState.restaurant.restaurant"]
    staged = staged.withColumn("_shop", F.when(F.col("_open"), F.coalesce(*[F.try_variant_get(F.col("_v"), o, "variant") for o in options])))
    shop = F.col("_shop")
    at = lambda k: _filled(shop, f"$.location.{k}")
    either = lambda a, b: F.coalesce(_truthy(_coord(shop, f"$.location.{a}")), _coord(shop, f"$.location.{b}"))
    street = F.when(at("streetName").isNotNull(), F.concat_ws(" ", at("streetName"), at("streetNumber")))
    written = F.nullif(F.concat_ws(", ", street, at("postalCode"), at("city")), F.lit(""))
    staged = staged.withColumn("_a", F.when(shop.isNull(), F.col("_b.address")).otherwise(written))
    staged = staged.withColumn("_t", dom.business_details_of(F.when(F.col("_open") & F.col("_a").isNull(), F.col("html"))))
    known = lambda c, stated: F.when(shop.isNull(), F.col(f"_b.{c}")).otherwise(stated)
    detail = _detail(F.coalesce("_a", "_t"), known("lat", either("lat", "latitude")), known("lng", either("lng", "longitude")))
    return staged.withColumn("d", detail).drop("_b", "_v", "_open", "_shop", "_a", "_t")


DETAIL_EXTRACTORS: dict[str, Extractor] = {"ubereats": ubereats_detail, "justeattakeaway": jet_detail}


def extract_details(pages: DataFrame, registry: dict[str, Extractor] | None = None) -> DataFrame:
    """Address and coordinates of detail pages; platforms without an extractor give no rows."""
    keep = [c for c in pages.columns if c != "html"]
    branches = [
        extractor(pages.where(F.col("platform") == platform)).select(*keep, "d.*")
        for platform, extractor in (DETAIL_EXTRACTORS if registry is None else registry).items()
    ]
    return reduce(DataFrame.unionByName, branches)
