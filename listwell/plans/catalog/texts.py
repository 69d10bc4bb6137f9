"""Text, number and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwell.functions import normalize as nz
from listwell.functions import similarity as sim
from listwell.functions import text as tx
from listwell.operators import tables as tb
from listwell.plans.catalog import sqltext as sq
from listwell.plans.catalog.common import registrar

ENTRIES, query = registrar()
PM = ("platform_merchants",)

# Names and addresses with more shapes than the table has; the text is valid in both engines.
VARIED_NAME = """CASE id % 10 WHEN 0 THEN CONCAT(name, ' | De beste pizza van NL! | Weesperzijde') WHEN 1 THEN CONCAT('Best ever | ', name)
 WHEN 2 THEN CONCAT(name, ' - Kinkerstraat') WHEN 3 THEN CONCAT('oost I ', name, ' l Order Now') WHEN 4 THEN CONCAT(name, ' Oost Centrum ')
 WHEN 5 THEN CONCAT('  ', UPPER(name), '   ') WHEN 6 THEN CONCAT(name, ' ', name) WHEN 7 THEN CONCAT(name, ' (Centrum Zuid)')
 WHEN 8 THEN CONCAT('The THE  the ', name) ELSE name END"""
VARIED_ADDRESS = """CASE id % 8 WHEN 0 THEN CONCAT(COALESCE(address, ''), ', Netherlands') WHEN 1 THEN CONCAT('Kerkstraat 12B, ', COALESCE(address, ''))
 WHEN 2 THEN CONCAT(CAST(id AS VARCHAR(9)), ' Main  Ave., NYC') WHEN 3 THEN 'Leidse Plein 7 Ste. 2, 1017pt Amsterdam, NL' WHEN 4 THEN CONCAT('de weg ', CAST(id AS VARCHAR(9)))
 WHEN 5 THEN UPPER(address) ELSE address END"""


def varied(pm):
    return pm.select("id", F.expr(VARIED_NAME).alias("name"), F.expr(VARIED_ADDRESS).alias("address"))


VARIED = f"WITH v AS (SELECT id, {VARIED_NAME} AS name, {VARIED_ADDRESS} AS address FROM platform_merchants)"

COERCE = "CONCAT(CASE event_id % 4 WHEN 0 THEN '$' WHEN 1 THEN '-' WHEN 2 THEN '1,' ELSE 'n/a ' END, CASE WHEN event_id % 4 < 3 THEN CAST(value AS VARCHAR(20)) ELSE '' END, CASE WHEN event_id % 3 = 0 THEN ' reviews' ELSE '' END)"


@query("safe_float", ("events",), f"""
SELECT event_id, TRY_CAST(regexp_replace({COERCE}, '[^0-9.]', '', 'g') AS DOUBLE) AS f FROM events""")
def _(ev):
    return ev.select("event_id", tx.safe_float(F.expr(COERCE)).alias("f"))


@query("safe_int", ("events",), f"""
SELECT event_id, TRY_CAST(regexp_replace({COERCE}, '[^0-9]', '', 'g') AS BIGINT) AS i, CAST(TRUNC(value) AS BIGINT) AS n FROM events""")
def _(ev):
    return ev.select("event_id", tx.safe_int(F.expr(COERCE)).alias("i"), tx.truncate_int(F.col("value")).alias("n"))


PRICE = "CONCAT(CASE event_id % 4 WHEN 0 THEN '$ ' WHEN 1 THEN '' WHEN 2 THEN '1,' ELSE 'free ' END, CASE WHEN event_id % 5 > 0 THEN CAST(value AS VARCHAR(20)) ELSE '' END)"


@query("coerce_price", ("events",), f"""
SELECT event_id, TRY_CAST(NULLIF(trim(REPLACE(REPLACE({PRICE}, '$', ''), ',', '')), '') AS DOUBLE) AS price,
  trim(REPLACE(REPLACE({PRICE}, '$', ''), ',', '')) <> '' AND TRY_CAST(trim(REPLACE(REPLACE({PRICE}, '$', ''), ',', '')) AS DOUBLE) IS NULL AS rejected
FROM events""")
def _(ev):
    text = F.expr(PRICE)
    return ev.select("event_id", tx.coerce_price(text).alias("price"), tx.price_rejected(text).alias("rejected"))


@query("clamp_rating", ("events",), """
SELECT event_id, CASE WHEN event_id % 6 > 0 THEN GREATEST(0.0, LEAST(5.0, ROUND(value - 3, 2))) END AS rating FROM events""")
def _(ev):
    raw = F.when(F.expr("event_id % 6 > 0"), F.round(F.col("value") - 3, 2))
    return ev.select("event_id", tx.clamp_rating(raw).alias("rating"))


@query("ensure_list", PM, """
SELECT id, COALESCE(array_to_string(list_filter(list_transform(string_split(CASE WHEN id % 5 > 0 THEN CONCAT(' ', name, ', ,', platform, ' ,') END, ','), lambda p: trim(p)), lambda p: p <> ''), '|'), '') AS tags
FROM platform_merchants""")
def _(pm):
    joined = F.when(F.expr("id % 5 > 0"), F.concat(F.lit(" "), "name", F.lit(", ,"), "platform", F.lit(" ,")))
    return pm.select("id", tx.ensure_list(joined).alias("tags"))


@query("row_validators", PM, """
SELECT id, CASE WHEN rating IS NULL THEN NULL ELSE LEAST(5.0, CAST(rating AS DOUBLE) + 2) END AS rating, COALESCE(array_to_string(cuisine_tags, '|'), '') AS cuisine_tags
FROM platform_merchants""")
def _(pm):
    raised = pm.select("id", (F.col("rating").cast("double") + 2).alias("rating"), "cuisine_tags")
    return nz.validate_listings(raised)


@query("normalize_name", PM, f"{VARIED}, {sq.name_steps('v')} SELECT k AS id, clean AS name FROM names")
def _(pm):
    return varied(pm).select("id", nz.normalize_name(F.col("name")).alias("name"))


@query("extract_restaurant_name", PM, f"{VARIED}, {sq.name_steps('v')} SELECT k AS id, lower({sq.collapsed('clean')}) AS name FROM names")
def _(pm):
    return varied(pm).select("id", nz.extract_restaurant_name(F.col("name")).alias("name"))


@query("normalize_address", PM, f"{VARIED} SELECT id, {sq.address('address')} AS address FROM v")
def _(pm):
    return varied(pm).select("id", nz.normalize_address(F.col("address")).alias("address"))


@query("extract_address_fields", PM, f"{VARIED}, {sq.address_steps('v')} SELECT k AS id, street_number, street_name, city FROM parts")
def _(pm):
    return varied(pm).select("id", nz.extract_address_fields(F.col("address")).alias("p")).select("id", "p.*")


_TAXONOMY = "MAP{" + ", ".join(f"{sq.quoted(k)}: {sq.quoted(v)}" for k, v in nz.TAXONOMY.items()) + "}"
_TAGS = f"""tagged AS (SELECT id, list_filter(list_transform(COALESCE(cuisine_tags, []::VARCHAR[]), lambda t:
  COALESCE({_TAXONOMY}[lower(trim(t))], upper(trim(t)[1]) || lower(trim(t)[2:]))), lambda t: t <> '') AS ts FROM platform_merchants)"""
_CLEAN_TAGS = "array_to_string(list_filter(ts, lambda t, i: list_position(ts, t) = i), '|')"


@query("normalize_cuisine_tags", PM, f"WITH {_TAGS} SELECT id, {_CLEAN_TAGS} AS tags FROM tagged")
def _(pm):
    return pm.select("id", nz.normalize_cuisine_tags(F.col("cuisine_tags")).alias("tags"))


_PRICES = "MAP{" + ", ".join(f"{sq.quoted(k)}: {sq.quoted(v)}" for k, v in nz.PRICE_BUCKETS.items()) + "}"
_BUCKET = f"CASE WHEN price_bucket <> '' THEN COALESCE({_PRICES}[lower(trim(price_bucket))], trim(price_bucket)) END"


@query("normalize_price_bucket", PM, f"""
SELECT id, {_BUCKET} AS price_bucket FROM
 (SELECT id, CASE id % 5 WHEN 0 THEN ' EXPENSIVE ' WHEN 1 THEN '' WHEN 2 THEN ' cheap' ELSE price_bucket END AS price_bucket FROM platform_merchants)""")
def _(pm):
    raw = F.expr("CASE id % 5 WHEN 0 THEN ' EXPENSIVE ' WHEN 1 THEN '' WHEN 2 THEN ' cheap' ELSE price_bucket END")
    return pm.select("id", nz.normalize_price_bucket(raw).alias("price_bucket"))


@query("normalize_listing", PM, f"""
WITH {_TAGS}, {sq.name_steps('platform_merchants')}
SELECT p.id, n.clean AS name, {sq.address('p.address')} AS address, {_CLEAN_TAGS} AS cuisine_tags, {_BUCKET} AS price_bucket
FROM platform_merchants p JOIN names n ON n.k = p.id JOIN tagged t ON t.id = p.id""")
def _(pm):
    return nz.normalize_listings(pm).select("id", "name", "address", "cuisine_tags", "price_bucket")


@query("norm_text", ("documents",), """
SELECT doc_id, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS digest FROM documents""")
def _(docs):
    return docs.select("doc_id", F.md5(tx.norm_text(F.col("text"))).alias("digest"))


@query("nfc_text", ("documents",), "SELECT doc_id, md5(nfc_normalize(text)) AS digest FROM documents")
def _(docs):
    return docs.select("doc_id", F.md5(tx.nfc(F.col("text"))).alias("digest"))


@query("looks_like_address", PM, f"""
{VARIED} SELECT id, len({sq.collapsed("COALESCE(address, '')")}) >= 8 AND
 (regexp_matches({sq.collapsed("COALESCE(address, '')")}, '\\b\\d{{4}}\\s?[A-Z]{{2}}\\b') OR (contains(address, ',') AND regexp_matches(address, '\\d'))) AS ok FROM v""")
def _(pm):
    return varied(pm).select("id", tx.looks_like_address(F.col("address")).alias("ok"))


@query("shortest_candidate", PM, """
WITH c AS (SELECT id, [platform, COALESCE(name, ''), platform_id, COALESCE(address, 'none')] AS cs FROM platform_merchants)
SELECT id, list_filter(cs, lambda x: len(x) = list_min(list_transform(cs, lambda y: len(y))))[1] AS picked FROM c""")
def _(pm):
    cands = F.array("platform", F.coalesce("name", F.lit("")), "platform_id", F.coalesce("address", F.lit("none")))
    return pm.select("id", tx.shortest(cands).alias("picked"))


LABEL = """CASE id % 3 WHEN 0 THEN CONCAT('Rating ', CAST(id % 5 AS VARCHAR(2)), ',', CAST(id % 10 AS VARCHAR(2)), ' of 5 based on 1.', CAST(100 + id AS VARCHAR(9)), ' reviews')
 WHEN 1 THEN CONCAT('Gewaardeerd met 4.', CAST(id % 10 AS VARCHAR(2)), ', ', CAST(id AS VARCHAR(9)), ' Recensies') ELSE 'New' END"""


@query("rating_from_label", PM, f"""
WITH v AS (SELECT id, {LABEL} AS label FROM platform_merchants)
SELECT id, TRY_CAST(REPLACE(regexp_extract(label, '(\\d[.,]\\d)', 1), ',', '.') AS DOUBLE) AS rating,
 TRY_CAST(regexp_replace(regexp_extract(label, '(?i)(\\d+[\\d\\s,.]*)\\s*(?:reviews|recensies|ratings|waarderingen)', 1), '\\D', '', 'g') AS BIGINT) AS review_count FROM v""")
def _(pm):
    label = F.expr(LABEL)
    return pm.select("id", tx.rating_in_label(label).alias("rating"), tx.reviews_in_label(label).alias("review_count"))


_PAIRS = """p AS (SELECT p_partkey AS id, p_name AS a, CONCAT(p_brand, ' ', p_name, ' ', p_type) AS b,
  CASE WHEN p_partkey % 3 = 0 THEN CONCAT(p_type, ' ', p_name) ELSE p_brand END AS c FROM part),
pairs AS (SELECT a, b FROM p UNION SELECT a, c FROM p UNION SELECT b, c FROM p)"""


def _name_pairs(part):
    b = F.concat_ws(" ", "p_brand", "p_name", "p_type")
    c = F.when(F.expr("p_partkey % 3 = 0"), F.concat_ws(" ", "p_type", "p_name")).otherwise(F.col("p_brand"))
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("a"), b.alias("b"), c.alias("c"))


def _scored(part, score):
    """Three scores a row, each computed once per distinct pair of texts."""
    rows = _name_pairs(part)
    ends = [("a", "b"), ("a", "c"), ("b", "c")]
    pairs = rows.select(F.inline(F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in ends]))).distinct()
    done = pairs.withColumn("s", F.round(score(F.col("x"), F.col("y")), 6))
    for x, y in ends:
        rows = rows.join(done.select(F.col("x").alias(x), F.col("y").alias(y), F.col("s").alias(f"{x}{y}")), [x, y])
    return rows.select("id", "ab", "ac", "bc")


def _scored_sql(column):
    j = " ".join(f"JOIN scores s{x}{y} ON s{x}{y}.a = p.{x} AND s{x}{y}.b = p.{y}" for x, y in ("ab", "ac", "bc"))
    cols = ", ".join(f"ROUND(s{n}.{column}, 6) AS {n}" for n in ("ab", "ac", "bc"))
    return f"WITH {_PAIRS}, {sq.score_steps('pairs')} SELECT p.id, {cols} FROM p {j}"


@query("ratio", ("part",), _scored_sql("ratio"))
def _(part):
    return _scored(part, sim.ratio)


@query("token_set_ratio", ("part",), _scored_sql("token_set"))
def _(part):
    return _scored(part, sim.token_set_ratio)


@query("fuzz_score", ("part",), _scored_sql("fuzz"))
def _(part):
    return _scored(part, sim.fuzz_score)


@query("name_similarity", ("part",), f"""
WITH p AS (SELECT p_partkey AS id, lower(CONCAT(p_name, ' ', p_type)) AS a, lower(p_name) AS b FROM part),
pairs AS (SELECT a, b FROM p), {sq.score_steps('pairs')}
SELECT p.id, ROUND(s.fuzz / 100, 6) AS similarity FROM p JOIN scores s ON s.a = p.a AND s.b = p.b""")
def _(part):
    a, b = F.concat(F.lit(" "), "p_name", F.lit("  "), "p_type"), F.upper("p_name")
    pairs = part.select(a.alias("a"), b.alias("b")).distinct()
    done = pairs.withColumn("similarity", F.round(sim.name_similarity(F.col("a"), F.col("b")), 6))
    return part.select(F.col("p_partkey").alias("id"), a.alias("a"), b.alias("b")).join(done, ["a", "b"]).select("id", "similarity")


@query("geo_distance_m", PM, f"""
SELECT id, ROUND(2 * {sim.EARTH_RADIUS_M} * ASIN(SQRT(POW(SIN((RADIANS(52.3676) - RADIANS(lat)) / 2), 2)
  + COS(RADIANS(lat)) * COS(RADIANS(52.3676)) * POW(SIN((RADIANS(4.9041) - RADIANS(lng)) / 2), 2))), 3) AS metres FROM platform_merchants""")
def _(pm):
    d = sim.geo_distance_m(F.col("lat"), F.col("lng"), F.lit(52.3676), F.lit(4.9041))
    return pm.select("id", F.round(d, 3).alias("metres"))


@query("score_match", PM, """
WITH v AS (SELECT id, CAST(id % 101 AS DOUBLE) / 100 AS s, CASE WHEN id % 7 > 0 THEN CAST(id % 300 AS DOUBLE) END AS d, id % 2 = 0 AS ok FROM platform_merchants)
SELECT id, ROUND(LEAST(1.0, GREATEST(0.0, CASE WHEN ok AND s >= 0.9 THEN LEAST(1.0, s + 0.1) ELSE s END * CASE WHEN d IS NULL THEN 1.0 ELSE 1 - LEAST(d / 400, 0.5) END)), 6) AS score FROM v""")
def _(pm):
    s, d = F.expr("CAST(id % 101 AS DOUBLE) / 100"), F.expr("CASE WHEN id % 7 > 0 THEN CAST(id % 300 AS DOUBLE) END")
    return pm.select("id", F.round(sim.score_match(s, d, F.expr("id % 2 = 0")), 6).alias("score"))


@query("unescape_state", ("events",), """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _(ev):
    bs = "\\"
    once = F.replace("props", F.lit('"'), F.lit(bs + '"'))
    twice = F.replace("props", F.lit('"'), F.lit(bs + "u0022"))
    wrapped = F.concat(F.lit('"'), F.when(F.expr("event_id % 2 = 0"), once).otherwise(twice), F.lit('"'))
    return ev.select("event_id", F.try_variant_get(F.try_parse_json(tx.unescape_state(wrapped)), "$.k", "bigint").alias("k"))
