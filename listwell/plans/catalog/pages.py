"""Extraction from pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwell.functions import jsonwalk
from listwell.functions import text as tx
from listwell.operators import extract as ex
from listwell.operators.tables import first_seen
from listwell.plans.catalog.common import doubles, registrar
from listwell.plans.coverage import first_listings
from listwell.session import spread
from listwell.sources.pages import with_key_parts

ENTRIES, query = registrar()
RAW = ("raw_pages",)
PART = ("part",)

# The listings that the derived pages hold, said from their texts.
ALL_LISTINGS = """WITH base AS (SELECT page_key, html, split_part(page_key, '/', 1) AS platform, split_part(page_key, '/', 3) AS market FROM raw_pages),
listings AS (
SELECT page_key, platform, market, json_extract_string(js, '$.id') AS platform_id, json_extract_string(js, '$.name') AS name,
  json_extract_string(js, '$.address.formattedAddress') AS address, CAST(json_extract_string(js, '$.address.lat') AS DOUBLE) AS lat,
  CAST(json_extract_string(js, '$.address.lng') AS DOUBLE) AS lng, json_extract_string(js, '$.tags[0].name') AS tags,
  CAST(json_extract_string(js, '$.averageRating') AS DOUBLE) AS rating, CAST(json_extract_string(js, '$.numRatings') AS BIGINT) AS review_count,
  CAST(json_extract_string(js, '$.deliveryFee') AS DOUBLE) AS delivery_fee, 'https://www.doordash.com/store/' || json_extract_string(js, '$.id') || '/' AS raw_url
FROM (SELECT *, json_extract(regexp_extract(html, 'json">(.*)</script>', 1), '$.props.pageProps.stores[0]') AS js FROM base WHERE platform = 'doordash')
UNION ALL SELECT page_key, platform, market, rid, json_extract_string(js, '$.name'), 'Street 1, 1054 HG, Amsterdam', 52.36, 4.87, '', 4.2, 85, NULL,
  'https://www.thuisbezorgd.nl/en/menu/' || json_extract_string(js, '$.uniqueName')
FROM (SELECT *, regexp_extract(html, '"restaurantData":{"([^"]*)"', 1) AS rid, json_extract(regexp_extract(html, 'json">(.*)</script>', 1),
   '$.queries[0].state.data.restaurantData.' || regexp_extract(html, '"restaurantData":{"([^"]*)"', 1)) AS js FROM base WHERE platform = 'justeattakeaway')
UNION ALL SELECT page_key, platform, market, regexp_extract(html, 'slug/([^?"]*)', 1), regexp_extract(html, '<h3>(.*)</h3>', 1), regexp_extract(html, '<span>(.*?)</span>', 1),
  NULL, NULL, '', 4.6, 1234, NULL, 'https://www.ubereats.com' || regexp_extract(html, 'href="([^"]*)"', 1) FROM base WHERE platform = 'ubereats')"""
COLUMNS = ["page_key", "platform", "market", "platform_id", "name", "address", "lat", "lng", "tags", "rating", "review_count", "delivery_fee", "raw_url"]


def shown(listings):
    return listings.withColumn("tags", F.array_join("cuisine_tags", "|")).select(*COLUMNS)


@query("extract_listings", RAW, f"{ALL_LISTINGS} SELECT {', '.join(COLUMNS)} FROM listings")
def _(raw):
    return shown(ex.extract_listings(with_key_parts(raw)))


def _one_platform(platform):
    registry = {platform: ex.LISTING_EXTRACTORS[platform]}

    @query({"justeattakeaway": "listings_jet"}.get(platform, f"listings_{platform}"), RAW, f"{ALL_LISTINGS} SELECT {', '.join(COLUMNS)} FROM listings WHERE platform = '{platform}'")
    def _(raw):
        return shown(ex.extract_listings(with_key_parts(raw), registry))


for _name in ("doordash", "justeattakeaway", "ubereats"):
    _one_platform(_name)


@query("parser_registry", RAW, f"{ALL_LISTINGS} SELECT page_key, platform_id, name FROM listings WHERE platform = 'doordash'")
def _(raw):
    """A platform of its own name is added by adding an entry."""
    pages = with_key_parts(raw).withColumn("platform", F.when(F.col("platform") == "doordash", "newcomer").otherwise(F.col("platform")))
    return ex.extract_listings(pages, {"newcomer": ex.doordash_listings}).select("page_key", "platform_id", "name")


@query("first_n_listings", RAW, f"{ALL_LISTINGS} SELECT page_key, platform_id, name FROM listings ORDER BY page_key LIMIT 10")
def _(raw):
    return first_listings(ex.extract_listings(with_key_parts(raw))).select("page_key", "platform_id", "name")


@query("first_seen_listings", RAW, f"{ALL_LISTINGS} SELECT page_key, platform_id, name FROM listings")
def _(raw):
    rows = ex.extract_listings(with_key_parts(raw))
    again = rows.withColumn("page_key", F.concat("page_key", F.lit("~")))
    return first_seen(rows.unionByName(again)).select("page_key", "platform_id", "name")


@query("script_payloads", ("pages",), """
SELECT page_id, CAST(i - 1 AS INT) AS pos, '' AS script_id, '' AS script_type, bodies[i] AS payload FROM
 (SELECT page_id, bodies, UNNEST(range(1, len(bodies) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<script>(.*?)</script>', 1) AS bodies FROM pages))""")
def _(pages):
    return ex.script_payloads(pages, "page_id")


@query("page_script_profile", RAW, """
SELECT page_key, CASE WHEN contains(html, '<script id') THEN regexp_extract(html, '<script id="([^"]*)"', 1) || ':' || len(regexp_extract(html, 'json">(.*)</script>', 1)) ELSE '' END AS script_ids,
  contains(html, 'restaurantData') AS has_restaurantdata, contains(html, '__NEXT_DATA__') AS has_next_data, contains(html, '__REACT_QUERY_STATE__') AS has_react_query_state FROM raw_pages""")
def _(raw):
    return ex.page_script_profile(raw)


def as_page(part, html: str, platform: str = "ubereats"):
    """A page per part, the html given as SQL text over the part's columns."""
    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit(f"{platform}/2024-01-01/m/listing_"), "p_partkey", F.lit(".html")).alias("page_key"),
        F.lit(platform).alias("platform"), F.lit("m").alias("market"), F.expr(html).alias("html"),
    )


LD = """CONCAT('<script type="application/ld+json">{"@type":"Thing"}</script><script type="application/ld+json">', CASE WHEN p_partkey % 3 = 0 THEN '[' ELSE '' END,
 '{"@type":"', CASE WHEN p_partkey % 5 = 0 THEN 'Event' ELSE 'Restaurant' END, '","address":{"streetAddress":"', p_name, ' ', CAST(p_size AS VARCHAR(9)), '"',
 CASE WHEN p_partkey % 2 = 0 THEN ',"postalCode":"1011AA"' ELSE '' END, ',"addressLocality":"Amsterdam"},"geo":{"latitude":"52.', CAST(p_size AS VARCHAR(9)), '","longitude":-4.5}}',
 CASE WHEN p_partkey % 3 = 0 THEN ']' ELSE '' END, '</script>')"""
LD_ADDRESS = "p_name || ' ' || p_size || CASE WHEN p_partkey % 2 = 0 THEN ', 1011AA' ELSE '' END || ', Amsterdam'"
LD_LAT = "CAST('52.' || p_size AS DOUBLE)"


@query("ldjson_business", PART, doubles(f"SELECT p_partkey AS id, {LD_ADDRESS} AS address, {LD_LAT} AS lat, -4.5 AS lng FROM part WHERE p_partkey % 5 > 0", "lng"))
def _(part):
    return ex.ldjson_business(as_page(part, LD), "id")


CARDS = """CONCAT('<html><body><div class="store-card"><span class="store-name"> ', p_name, ' </span></div><article><h2>', p_type, ' <b>Grill</b></h2>',
 CASE WHEN p_partkey % 2 = 0 THEN CONCAT('<a href="/store/', CAST(p_partkey AS VARCHAR(20)), '/">Link</a>') ELSE '<a href="https://x.org/s/9">Link</a>' END, '</article><article><p>no heading</p></article></body></html>')"""


@query("listings_doordash_cards", PART, """
SELECT p_partkey AS id, p_name AS platform_id, p_name AS name, '' AS raw_url FROM part
UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '9' END, p_type || 'Grill',
 CASE WHEN p_partkey % 2 = 0 THEN 'https://www.doordash.com/store/' || p_partkey || '/' ELSE 'https://x.org/s/9' END FROM part""")
def _(part):
    pages = as_page(part, CARDS, "doordash")
    rows = ex.extract_listings(pages, {"doordash": ex.doordash_listings})
    return rows.join(pages.select("page_key", "id"), "page_key").select("id", "platform_id", "name", "raw_url")


LOOSE = """CONCAT('<script id="__NEXT_DATA__">{"a":{"b":[1,{"name":"', p_name, '","id":', CAST(p_partkey AS VARCHAR(20)), ',"primarySlug":"slug', CAST(p_size AS VARCHAR(9)),
 '","location":{', CASE WHEN p_partkey % 2 = 0 THEN '"lat":52.5,"lng":4.5' ELSE '"latitude":"52.25","longitude":-4.25' END, '},"address":{"streetName":"', p_type, '"},"rating":{"score":"4.1","count":"1,200"}}]}}</script>')"""


@query("listings_jet_fallback", PART, doubles("""SELECT CAST(p_partkey AS VARCHAR) AS platform_id, p_name AS name, p_type AS address, CASE WHEN p_partkey % 2 = 0 THEN 52.5 ELSE 52.25 END AS lat,
 CASE WHEN p_partkey % 2 = 0 THEN 4.5 ELSE -4.25 END AS lng, 4.1 AS rating, 1200 AS review_count, 'https://www.thuisbezorgd.nl/en/menu/slug' || p_size AS raw_url FROM part""", "lat", "lng", "rating"))
def _(part):
    rows = ex.extract_listings(as_page(part, LOOSE, "justeattakeaway"), {"justeattakeaway": ex.jet_listings})
    return rows.select("platform_id", "name", "address", "lat", "lng", "rating", "review_count", "raw_url")


# The key sits deeper the larger the remainder, in objects and lists by turns.
NESTED = """CONCAT('{"x":[0,"', p_name, '"],"y":', repeat('{"d":[', CAST(p_partkey % 12 AS INT)), '{"wanted":{"n":', CAST(p_partkey AS VARCHAR(20)), '}}', repeat(']}', CAST(p_partkey % 12 AS INT)), ',"wanted":null}')"""


@query("json_descend", PART, "SELECT p_partkey AS id, p_partkey AS n FROM part")
def _(part):
    found = jsonwalk.find_key(F.expr(NESTED), "wanted")
    return part.select(F.col("p_partkey").alias("id"), F.try_variant_get(F.try_parse_json(found), "$.n", "bigint").alias("n"))


@query("json_find_key", ("events",), "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(ev):
    return ev.select("event_id", jsonwalk.find_key(F.concat(F.lit('[[],{"p":'), "props", F.lit("}]")), "k").cast("bigint").alias("k"))


HOLDER = """CONCAT('{"list":[{"id":"other"},{"inner":"', CASE WHEN p_partkey % 2 = 0 THEN '{\\\\"slug\\\\":\\\\"s' ELSE 's' END, CAST(p_partkey AS VARCHAR(20)),
 CASE WHEN p_partkey % 2 = 0 THEN '\\\\",\\\\"v\\\\":7}' ELSE '' END, '"},{"storeUUID":"s', CAST(p_partkey AS VARCHAR(20)), '","v":8}]}')"""


@query("json_find_object", PART, "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 7 ELSE 8 END AS v FROM part")
def _(part):
    found = jsonwalk.find_object(F.expr(HOLDER), F.concat(F.lit("s"), "p_partkey"))
    return part.select(F.col("p_partkey").alias("id"), F.try_variant_get(F.try_parse_json(found), "$.v", "bigint").alias("v"))


CARD_TEXTS = "array(p_name, CONCAT(p_type, ' 12, 1053 AB  Amsterdam'), CONCAT(p_name, ' ', CAST(p_partkey AS VARCHAR(20)), ', NL'), 'a, 1')"


@query("address_from_card", PART, """
WITH c AS (SELECT p_partkey AS id, p_type || ' 12, 1053 AB Amsterdam' AS x, p_name || ' ' || p_partkey || ', NL' AS y FROM part)
SELECT id, CASE WHEN len(x) <= len(y) THEN x ELSE y END AS address FROM c""")
def _(part):
    return part.select(F.col("p_partkey").alias("id"), ex.address_of_card(F.expr(CARD_TEXTS)).alias("address"))


STATE = """CONCAT(repeat('-', CAST(p_partkey % 1700 AS INT)), '"latitude":1.5 ', repeat('.', CAST(p_size * 40 AS INT)), '"uuid":"s', CAST(p_partkey AS VARCHAR(20)), '"', repeat(' ', CAST(p_partkey * 7 % 1500 AS INT)),
 '"latitude": 52.', CAST(p_size AS VARCHAR(9)), ',\\\\"longitude\\\\":-4.', CAST(p_size AS VARCHAR(9)), '}')"""
STATE_SQL = STATE.replace("\\\\", "\\")


@query("coords_near_id", PART, f"""
WITH s AS (SELECT p_partkey AS id, {STATE_SQL} AS t, strpos({STATE_SQL}, 's' || p_partkey) AS found FROM part),
w AS (SELECT id, substring(t, greatest(found - 1001, 0) + 1, found - 1 + 1000 - greatest(found - 1001, 0)) AS t FROM s),
v AS (SELECT id, TRY_CAST(regexp_extract(t, '(?i)(?:latitude|lat)["\\\\]*:\\s*(-?\\d+\\.\\d+)', 1) AS DOUBLE) AS lat, TRY_CAST(regexp_extract(t, '(?i)(?:longitude|lng)["\\\\]*:\\s*(-?\\d+\\.\\d+)', 1) AS DOUBLE) AS lng FROM w)
SELECT id, CASE WHEN lat <> 0 AND lng <> 0 THEN lat END AS lat, CASE WHEN lat <> 0 AND lng <> 0 THEN lng END AS lng FROM v""")
def _(part):
    spot = ex.coords_in(ex.window_near(F.expr(STATE), F.concat(F.lit("s"), "p_partkey")))
    return spread(part, "p_partkey").select(F.col("p_partkey").alias("id"), spot.alias("p")).select("id", "p.lat", "p.lng")


FAR = """CONCAT('<a href="/store/x/s', CAST(p_partkey AS VARCHAR(20)), '">', p_name, '</a><script id="__REDUX_STATE__">"{\\\\u0022stores\\\\u0022:[{\\\\u0022id\\\\u0022:\\\\u0022s', CAST(p_partkey AS VARCHAR(20)),
 '\\\\u0022,\\\\u0022pad\\\\u0022:\\\\u0022', repeat('p', 1200), '\\\\u0022,\\\\u0022location\\\\u0022:{\\\\u0022latitude\\\\u0022:52.5,\\\\u0022longitude\\\\u0022:\\\\u0022-4.', CAST(p_size AS VARCHAR(9)), '\\\\u0022},\\\\u0022address\\\\u0022:{\\\\u0022streetAddress\\\\u0022:\\\\u0022', p_type, '\\\\u0022}}]}"</script>')"""


@query("coords_from_state", PART, "SELECT 's' || p_partkey AS platform_id, p_name AS name, CAST(52.5 AS DOUBLE) AS lat, CAST('-4.' || p_size AS DOUBLE) AS lng, p_type AS address FROM part")
def _(part):
    rows = ex.extract_listings(as_page(part, FAR), {"ubereats": ex.ubereats_listings})
    return rows.select("platform_id", "name", "lat", "lng", "address")


DETAIL_UBER = f"""CASE p_partkey % 4 WHEN 0 THEN {LD}
 WHEN 1 THEN CONCAT('<script id="__REACT_QUERY_STATE__">{{"q":[{{"address":{{"formattedAddress":"', p_name, '"}},"location":{{"lat":52.5,"lng":4.5}}}}]}}</script>')
 WHEN 2 THEN CONCAT('<div><button aria-label="Address of it"><b>', p_name, '</b> <i>', CAST(p_size AS VARCHAR(9)), '</i></button></div>')
 ELSE CONCAT('<script>var info = 12345678901;</script><div><p>More info<span>', p_name, ' ', CAST(100 + p_size AS VARCHAR(9)), '</span></p></div>') END"""
DETAIL_UBER_SQL = f"""SELECT p_partkey AS id, 'ubereats' AS platform, CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN {LD_ADDRESS} END WHEN 1 THEN p_name WHEN 2 THEN p_name || ', ' || p_size
  ELSE 'More info' || p_name || ' ' || (100 + p_size) END AS address,
 CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN {LD_LAT} END WHEN 1 THEN 52.5 END AS lat,
 CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN -4.5 END WHEN 1 THEN 4.5 END AS lng FROM part"""
DETAIL_JET = f"""CASE p_partkey % 3 WHEN 0 THEN {LD}
 WHEN 1 THEN CONCAT('<script id="__NEXT_DATA__">{{"props":{{"pageProps":{{"', CASE WHEN p_partkey % 2 = 0 THEN 'restaurant":' ELSE 'initialState":{{"restaurant":{{"restaurant":' END,
   '{{"location":{{"streetName":"', p_name, '","streetNumber":"', CAST(p_size AS VARCHAR(9)), '","postalCode":"1011","city":"Amsterdam","latitude":52.5,"lng":4.5}}}}', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '}}}}' END, '}}}}}}</script>')
 ELSE CONCAT('<section><h2>Business details</h2><p>', p_name, '</p><p>', CAST(p_size AS VARCHAR(9)), '</p></section>') END"""
DETAIL_JET_SQL = f"""SELECT p_partkey AS id, 'justeattakeaway' AS platform, CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN {LD_ADDRESS} END WHEN 1 THEN p_name || ' ' || p_size || ', 1011, Amsterdam'
  ELSE p_name || ', ' || p_size END AS address,
 CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN {LD_LAT} END WHEN 1 THEN 52.5 END AS lat,
 CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_partkey % 5 > 0 THEN -4.5 END WHEN 1 THEN 4.5 END AS lng FROM part"""


def _details(part, html, platform):
    return ex.extract_details(as_page(part, html, platform)).select("id", "platform", "address", "lat", "lng")


@query("detail_ubereats", PART, doubles(DETAIL_UBER_SQL, "lat", "lng"))
def _(part):
    return _details(part, DETAIL_UBER, "ubereats")


@query("detail_jet", PART, doubles(DETAIL_JET_SQL, "lat", "lng"))
def _(part):
    return _details(part, DETAIL_JET, "justeattakeaway")


@query("extract_details", PART, doubles(f"{DETAIL_UBER_SQL} UNION ALL {DETAIL_JET_SQL}", "lat", "lng"))
def _(part):
    pages = as_page(part, DETAIL_UBER, "ubereats").union(as_page(part, DETAIL_JET, "justeattakeaway"))
    unread = as_page(part, "'<html></html>'", "doordash")
    return ex.extract_details(pages.union(unread)).select("id", "platform", "address", "lat", "lng")
