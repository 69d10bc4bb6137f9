"""Scans, keyed writes, child rows and joins between tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from listwell.functions.similarity import geo_point
from listwell.operators import match as mt
from listwell.operators import tables as tb
from listwell.plans import bind
from listwell.plans.bind import AS_OF
from listwell.plans.catalog.common import portable, registrar
from listwell.schemas import LISTING
from listwell.session import ensure_checkpoint_dir
from listwell.sources import archive, config, pages

ENTRIES, query = registrar()
PM = ("platform_merchants",)
PARTS = "split_part(page_key, '/', 1) AS platform, split_part(page_key, '/', 2) AS date, split_part(page_key, '/', 3) AS market"


@query("raw_pages_scan", ("raw_pages",), """
SELECT page_key, html FROM raw_pages
WHERE page_key LIKE '%.html' AND page_key LIKE '%listing%' AND page_key LIKE '%/market1/%' ORDER BY page_key""")
def _(raw):
    return pages.listing_pages(raw, market="market1")


@query("page_key_parse", ("raw_pages",), f"""
SELECT page_key, {PARTS}, regexp_replace(split_part(page_key, '/', 4), '\\.[^.]*$', '') AS merchant_id, page_key AS rebuilt FROM raw_pages""")
def _(raw):
    parsed = pages.with_key_parts(raw.select("page_key"))
    rebuilt = pages.page_key(F.col("platform"), F.col("date"), F.col("market"), F.col("merchant_id"))
    return parsed.withColumn("rebuilt", rebuilt)


def _listings(pm):
    """Listings with the fields of an archived listing."""
    out = []
    for f in LISTING.fields:
        c = F.col(f.name) if f.name in pm.columns else F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return pm.select(*out)


@query("parsed_json_sink", PM, f"""
SELECT platform || '/{AS_OF[:10]}/' || COALESCE(market, 'unknown') || '/' || platform_id || '.json' AS json_key,
  platform, platform_id, name, address, market, array_to_string(cuisine_tags, '|') AS cuisine_tags, review_count FROM platform_merchants""")
def _(pm):
    archived = pages.parsed_rows(_listings(pm), AS_OF[:10])
    kinds = "platform string, platform_id string, name string, address string, market string, cuisine_tags array<string>, review_count int"
    return archived.select("json_key", F.from_json("body", kinds).alias("b")).select("json_key", "b.*")


@query("parsed_json_scan", PM, """
SELECT platform, platform_id, name, address, lat, lng, array_to_string(cuisine_tags, '|') AS cuisine_tags,
  CAST(rating AS DOUBLE) AS rating, review_count, is_promoted, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at
FROM platform_merchants""")
def _(pm):
    bodies = pages.parsed_rows(_listings(pm), AS_OF[:10])
    back = bodies.select(F.from_json("body", LISTING).alias("b")).select("b.*")
    return back.select(
        "platform", "platform_id", "name", "address", "lat", "lng", "cuisine_tags", "rating", "review_count", "is_promoted", "scraped_at"
    )


def _listing_files_load(spark, sf_dir):
    """All platforms' files, arrays of up to a thousand listings a line, written and read back."""
    pm = bind.table(spark, sf_dir, "platform_merchants").withColumnRenamed("platform_id", "platform_merchant_id")
    base = f"{ensure_checkpoint_dir(spark)}/listing-files-{uuid.uuid4().hex}"
    rows = pm.select("id", "platform", F.struct("platform", "platform_merchant_id", "name", "address", "market").alias("row"))
    lines = rows.groupBy("platform", F.expr("id DIV 1000").alias("run")).agg(F.to_json(F.collect_list("row")).alias("value"))
    platforms = ("doordash", "grubhub", "justeattakeaway", "ubereats")
    paths = [f"{base}/{p}" for p in platforms]
    for path, platform in zip(paths, platforms):
        lines.where(F.col("platform") == platform).select("value").write.text(path)
    loaded = pages.read_listing_files(spark, [*paths, f"{base}/absent"], legacy=f"{base}/legacy", multiline=False)
    return portable(loaded.select("platform", "platform_merchant_id", "name", "address", "market"))


ENTRIES["listing_files_load"] = (
    _listing_files_load,
    f"WITH {bind.ctes('platform_merchants')} SELECT platform, platform_id AS platform_merchant_id, name, address, market FROM platform_merchants",
)


def _page_archive(spark, sf_dir):
    """All pages written as objects of an archive and read back from it."""
    archive.register(spark)
    path = f"{ensure_checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    raw = pages.with_key_parts(bind.table(spark, sf_dir, "raw_pages"))
    raw.select("page_key", "html", "platform", "date", "market", "merchant_id").write.format("page_archive").mode("append").save(path)
    return portable(spark.read.format("page_archive").load(path).withColumn("html", F.md5("html")))


ENTRIES["page_archive"] = (
    _page_archive,
    f"WITH {bind.ctes('raw_pages')} SELECT page_key, md5(html) AS html, {PARTS}, regexp_replace(split_part(page_key, '/', 4), '\\.[^.]*$', '') AS merchant_id FROM raw_pages",
)


@query("merchants_scan", PM, "SELECT id, platform, name, address, lat, lng, market FROM platform_merchants WHERE name IS NOT NULL")
def _(pm):
    return mt.merchants_scan(pm)


@query("crawl_targets", ("nation",), """
WITH m AS (SELECT DISTINCT LOWER(REPLACE(n_name, ' ', '_')) AS market FROM nation UNION SELECT 'nyc' FROM nation)
SELECT 'doordash' AS platform, market, 'https://www.doordash.com/food-delivery/' || REPLACE(market, '_', '-') || '-restaurants/' AS url FROM m
UNION ALL SELECT 'grubhub', market, 'https://www.grubhub.com/delivery/' || REPLACE(market, '_', '-') FROM m
UNION ALL SELECT 'justeattakeaway', market, 'https://www.thuisbezorgd.nl/en/delivery/food/' || REPLACE(market, '_', '-') FROM m
UNION ALL SELECT 'ubereats', market, 'https://www.ubereats.com/city/' || CASE market WHEN 'nyc' THEN 'new-york-city' ELSE market END FROM m""")
def _(nation):
    rows = nation.select(F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))).alias("market"))
    return config.crawl_targets(rows.union(nation.select(F.lit("nyc"))))


# A third of the batch goes to keys the table does not know.
NEW_KEY = "CASE WHEN seq % 3 = 0 THEN CONCAT('n', platform_id) ELSE platform_id END"
BATCH_LAST = f"""batch AS (SELECT seq, platform, {NEW_KEY} AS platform_id, name, delivery_fee, scraped_at FROM listing_batch),
last AS (SELECT * EXCLUDE (rn) FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY platform, platform_id ORDER BY seq DESC) AS rn FROM batch) WHERE rn = 1)"""


def _batch(batch):
    return batch.withColumn("platform_id", F.expr(NEW_KEY))


@query("upsert_listings", ("platform_merchants", "listing_batch"), f"""
WITH {BATCH_LAST}
SELECT COALESCE(b.platform, t.platform) AS platform, COALESCE(b.platform_id, t.platform_id) AS platform_id,
  COALESCE(b.name, t.name) AS name, t.address AS address,
  CASE WHEN b.seq IS NULL THEN CAST(t.delivery_fee AS DOUBLE) ELSE ROUND(b.delivery_fee, 2) END AS delivery_fee,
  strftime(CASE WHEN b.seq IS NULL THEN t.scraped_at ELSE b.scraped_at END, '%Y-%m-%d %H:%M:%S') AS scraped_at, t.id AS known_id
FROM platform_merchants t FULL OUTER JOIN last b ON b.platform = t.platform AND b.platform_id = t.platform_id""")
def _(pm, batch):
    known = pm.select("platform", "platform_id", F.col("id").alias("known_id"))
    merged = tb.upsert_listings(pm, _batch(batch))
    return merged.join(known, ["platform", "platform_id"], "left").select(
        "platform", "platform_id", "name", "address", "delivery_fee", "scraped_at", "known_id"
    )


@query("upsert_partial", ("platform_merchants", "listing_batch"), f"""
WITH {BATCH_LAST}
SELECT COALESCE(b.platform, t.platform) AS platform, COALESCE(b.platform_id, t.platform_id) AS platform_id,
  COALESCE(b.name, t.name) AS name,
  CASE WHEN b.seq IS NULL THEN CAST(t.delivery_fee AS DOUBLE) ELSE ROUND(b.delivery_fee, 2) END AS delivery_fee,
  strftime(CASE WHEN t.id IS NULL THEN b.scraped_at ELSE t.scraped_at END, '%Y-%m-%d %H:%M:%S') AS scraped_at,
  CASE WHEN t.id IS NULL THEN CASE WHEN b.seq % 3 > 0 AND b.seq % 5 > 0 THEN CAST(b.seq % 3 AS DOUBLE) END
    WHEN b.seq % 3 > 0 AND b.seq % 5 > 0 THEN CAST(b.seq % 3 AS DOUBLE) ELSE t.lat END AS lat
FROM platform_merchants t FULL OUTER JOIN last b ON b.platform = t.platform AND b.platform_id = t.platform_id""")
def _(pm, batch):
    located = _batch(batch).withColumns(
        {"lat": F.expr("CAST(seq % 3 AS DOUBLE)"), "lng": F.expr("CAST(seq % 5 AS DOUBLE)")}
    )
    return tb.upsert_partial(pm, located).select("platform", "platform_id", "name", "delivery_fee", "scraped_at", "lat")


def _item_batch(items):
    """Listings with one new menu item a row; a listing comes again for each of its items."""
    item = F.struct(F.concat(F.lit("new "), "name").alias("name"), F.col("price").alias("price"))
    return items.select(F.col("platform_merchant_id").alias("id"), F.array(item).alias("menu_items"), F.col("id").alias("seq"), "price")


BATCH = "id % 10 = 1"  # the listings that the batch of a write has
NEW_ITEMS = "SELECT platform_merchant_id, 'new ' || name AS name, CAST(price AS DOUBLE) AS price FROM menu_items"
OLD_ITEMS = "SELECT platform_merchant_id, name, CAST(price AS DOUBLE) AS price FROM menu_items"


@query("child_replace", ("menu_items",), f"""
{OLD_ITEMS} WHERE platform_merchant_id % 10 <> 1 UNION ALL
SELECT platform_merchant_id, 'new ' || name, CAST(price AS DOUBLE) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY platform_merchant_id ORDER BY id DESC, price DESC NULLS LAST) AS rn
  FROM menu_items WHERE platform_merchant_id % 10 = 1) WHERE rn = 1""")
def _(items):
    return tb.replace_children(items, _item_batch(items).where(BATCH), ("seq", "price")).select("platform_merchant_id", "name", "price")


@query("child_append", ("menu_items",), f"{OLD_ITEMS} UNION ALL {NEW_ITEMS} WHERE platform_merchant_id % 10 = 1")
def _(items):
    return tb.append_children(items, _item_batch(items).where(BATCH)).select("platform_merchant_id", "name", "price")


@query("menu_items_explode", ("menu_items",), NEW_ITEMS)
def _(items):
    return tb.menu_rows(_item_batch(items))


@query("match_sink", ("merchant_matches",), """
SELECT platform_merchant_id, CASE WHEN platform_merchant_id % 5 = 0 THEN merchant_id + 1000 ELSE merchant_id END AS merchant_id,
  CASE WHEN platform_merchant_id % 5 = 0 THEN 0.5 ELSE CAST(confidence AS DOUBLE) END AS confidence FROM merchant_matches
UNION ALL SELECT -platform_merchant_id, merchant_id, 0.5 FROM merchant_matches WHERE platform_merchant_id % 5 = 1""")
def _(mm):
    half = F.lit(0.5).cast("decimal(4,3)").alias("confidence")
    moved = mm.where("platform_merchant_id % 5 = 0").select(
        "platform_merchant_id", (F.col("merchant_id") + 1000).alias("merchant_id"), half, "match_method", F.lit(2).alias("seq")
    )
    stale = moved.withColumns({"merchant_id": F.lit(0).cast("bigint"), "seq": F.lit(1)})
    added = mm.where("platform_merchant_id % 5 = 1").select(
        (-F.col("platform_merchant_id")).alias("platform_merchant_id"), "merchant_id", half, "match_method", F.lit(1).alias("seq")
    )
    return tb.merge_matches(mm, moved.union(stale).union(added), ("seq",)).select("platform_merchant_id", "merchant_id", "confidence")


@query("resolution_reset", ("platform_merchants", "merchants", "merchant_matches"), """
WITH kept AS (SELECT * FROM merchant_matches WHERE platform_merchant_id NOT IN (SELECT id FROM platform_merchants WHERE market = 'market1'))
SELECT 'match' AS kind, platform_merchant_id AS id FROM kept
UNION ALL SELECT 'entity', id FROM merchants WHERE id IN (SELECT merchant_id FROM kept)""")
def _(pm, m, mm):
    entities, matches = tb.reset_resolution(pm, m, mm, "market1")
    return matches.select(F.lit("match").alias("kind"), F.col("platform_merchant_id").alias("id")).union(
        entities.select(F.lit("entity"), "id")
    )


@query("crawl_audit", ("platform_merchants", "crawl_runs"), """
WITH found AS (SELECT id * id % 997 AS run_id, COUNT(*) AS n FROM platform_merchants GROUP BY 1)
SELECT r.id, r.platform, r.market, strftime(r.started_at, '%Y-%m-%d %H:%M:%S') AS started_at, r.status,
  CASE WHEN r.status = 'failed' THEN 0 ELSE COALESCE(f.n, 0) END AS merchants_found,
  CASE WHEN r.status = 'failed' THEN 1 ELSE 0 END AS errors,
  CASE WHEN r.status = 'failed' THEN repeat('timeout ', 62) || 'time' END AS error_detail
FROM crawl_runs r LEFT JOIN found f ON f.run_id = r.id""")
def _(pm, runs):
    logged = runs.select(
        "id", "platform", "market", "started_at",
        F.when(F.col("status") != "running", F.col("started_at")).alias("finished_at"),
        F.when(F.col("status") == "failed", F.repeat(F.lit("timeout "), F.lit(80))).alias("error_detail"),
    )
    return tb.crawl_audit(pm.select(F.expr("id * id % 997").alias("run_id")), logged).drop("finished_at")


@query("geo_point", PM, """
SELECT id, CASE WHEN lat <> 0 AND lng <> 0 THEN 'SRID=4326;POINT(' || CAST(ROUND(lng, 3) AS VARCHAR) || ' ' || CAST(ROUND(lat, 3) AS VARCHAR) || ')' END AS geom
FROM platform_merchants""")
def _(pm):
    return pm.select("id", geo_point(F.round("lat", 3), F.round("lng", 3)).alias("geom"))


@query("detail_enrich", PM, """
SELECT id, CASE WHEN COALESCE(address, '') = '' AND id % 3 = 0 THEN 'Detail ' || id ELSE address END AS address,
  CASE WHEN COALESCE(address, '') = '' AND id % 3 = 0 AND id % 2 > 0 THEN 1.0 ELSE lat END AS lat
FROM platform_merchants""")
def _(pm):
    details = pm.where("id % 3 = 0").select(
        "platform", "platform_id", F.concat(F.lit("Detail "), "id").alias("address"),
        F.expr("CAST(id % 2 AS DOUBLE)").alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit(2).alias("seq"),
    )
    stale = details.withColumns({"address": F.lit("Stale"), "lat": F.lit(7.0), "seq": F.lit(1)})
    return tb.enrich_details(pm, details.unionByName(stale), ("seq",)).select("id", "address", "lat")


@query("first_seen_dedup", ("listing_batch",), """
SELECT platform, platform_id, name, pos FROM (SELECT *, seq % 7 AS pos,
  ROW_NUMBER() OVER (PARTITION BY platform, platform_id ORDER BY strftime(scraped_at, '%Y-%m-%d'), seq % 7, seq) AS rn FROM listing_batch) WHERE rn = 1""")
def _(batch):
    seen = batch.select(
        "platform", "platform_id", "name", "seq", F.expr("seq % 7").alias("pos"), F.date_format("scraped_at", "yyyy-MM-dd").alias("page_key")
    )
    return tb.earliest(seen, ["platform", "platform_id"], ["page_key", "pos", "seq"]).select("platform", "platform_id", "name", "pos")


@query("pair_lookup", ("merchant_matches",), """
WITH p AS (SELECT platform_merchant_id AS id_a, merchant_id AS id_b, CAST(confidence AS DOUBLE) AS confidence
  FROM merchant_matches WHERE platform_merchant_id % 2 = 0 AND platform_merchant_id > merchant_id)
SELECT mm.merchant_id AS entity_id, mm.platform_merchant_id AS id, COALESCE(p.confidence, 1.0) AS confidence,
  CASE WHEN p.id_a IS NULL THEN 'cluster_member' ELSE 'field_fuzzy' END AS match_method
FROM merchant_matches mm LEFT JOIN p ON p.id_a = mm.platform_merchant_id AND p.id_b = mm.merchant_id""")
def _(mm):
    members = mm.select(F.col("merchant_id").alias("entity_id"), F.col("platform_merchant_id").alias("id"))
    pairs = mm.where("platform_merchant_id % 2 = 0 AND platform_merchant_id > merchant_id").select(
        F.col("platform_merchant_id").alias("id_a"), F.col("merchant_id").alias("id_b"), F.col("confidence").cast("double").alias("confidence"), "match_method"
    )
    return mt.pair_lookup(members, pairs)


@query("market_block_pairs", PM, """
WITH mode AS (SELECT market FROM platform_merchants WHERE market IS NOT NULL GROUP BY market ORDER BY COUNT(*) DESC, market LIMIT 1),
f AS (SELECT id, platform, COALESCE(market, (SELECT market FROM mode)) AS market FROM platform_merchants)
SELECT a.market, COUNT(*) AS pairs FROM f a JOIN f b ON a.market = b.market AND a.id < b.id AND a.platform <> b.platform GROUP BY a.market""")
def _(pm):
    return mt.comparable_pairs(mt.fill_market(pm)).select("market", F.col("pairs").cast("bigint").alias("pairs"))
