"""Coverage views, dashboards and data-quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwell.operators import tables as tb
from listwell.plans import coverage as cv
from listwell.plans import quality as dq
from listwell.plans.bind import AS_OF
from listwell.plans.catalog.common import registrar

ENTRIES, query = registrar()
PM = ("platform_merchants",)
ALL = ("platform_merchants", "merchants", "merchant_matches")
BLANK = "(address IS NULL OR trim(address) = '')"
TAGS = "array_to_string(cuisine_tags, '|') AS cuisine_tags"
ENTITY_JOINS = """FROM platform_merchants pm
LEFT JOIN merchant_matches mm ON mm.platform_merchant_id = pm.id
LEFT JOIN merchants m ON m.id = mm.merchant_id"""
GAP = "(m.is_on_our_platform = FALSE OR m.id IS NULL)"
MATCHED = """FROM merchants m JOIN merchant_matches mm ON mm.merchant_id = m.id
JOIN platform_merchants pm ON pm.id = mm.platform_merchant_id"""


@query("coverage_by_platform_market", PM, """
SELECT platform, market, COUNT(DISTINCT platform_id) AS merchant_count,
  ROUND(AVG(CAST(rating AS DOUBLE)), 2) AS avg_rating, ROUND(AVG(review_count), 0) AS avg_reviews,
  COUNT(DISTINCT CASE WHEN rating >= 4.5 THEN platform_id END) AS high_rated_count
FROM platform_merchants GROUP BY platform, market""")
def _(pm):
    return cv.coverage_by_platform_market(pm)


@query("coverage_gaps", ALL, f"""
SELECT pm.platform, pm.market, pm.name, pm.address, CAST(pm.rating AS DOUBLE) AS rating, pm.review_count, {TAGS}, pm.price_bucket
{ENTITY_JOINS} WHERE {GAP}""")
def _(pm, m, mm):
    return cv.coverage_gaps(pm, m, mm)


@query("gap_filter", ALL, f"""
SELECT pm.id, pm.platform {ENTITY_JOINS} WHERE {GAP} AND pm.platform <> 'ubereats'""")
def _(pm, m, mm):
    return cv.gaps(pm, m, mm, competitors_only=True).select("id", "platform")


@query("left_equi_chain", ALL, f"""
SELECT pm.id, mm.merchant_id, m.is_on_our_platform AS entity_is_ours {ENTITY_JOINS}""")
def _(pm, m, mm):
    return cv.listings_with_entity(pm, m, mm).select("id", "merchant_id", "entity_is_ours")


@query("inner_equi_chain", ALL, f"""
SELECT m.id AS entity_id, m.canonical_name, pm.id, pm.platform {MATCHED}""")
def _(pm, m, mm):
    return cv.entity_listings(pm, m, mm).select("entity_id", "canonical_name", "id", "platform")


@query("in_subquery_semi", ("merchants", "merchant_matches"), """
SELECT id, canonical_name FROM merchants
WHERE id IN (SELECT merchant_id FROM merchant_matches GROUP BY merchant_id HAVING COUNT(*) >= 2)""")
def _(m, mm):
    several = cv.multi_listing_entities(mm)
    return m.join(several, m["id"] == several["merchant_id"], "left_semi").select("id", "canonical_name")


@query("not_in_anti", ("merchants", "merchant_matches"), """
SELECT id, canonical_name FROM merchants
WHERE id NOT IN (SELECT merchant_id FROM merchant_matches WHERE platform_merchant_id % 10 < 5)""")
def _(m, mm):
    return tb.orphans(m, mm.where("platform_merchant_id % 10 < 5")).select("id", "canonical_name")


@query("cross_platform_overlap", ALL, f"""
SELECT m.id AS entity_id, m.canonical_name, m.canonical_addr, COUNT(DISTINCT pm.platform) AS platform_count,
  array_to_string(list_sort(ARRAY_AGG(DISTINCT pm.platform)), '|') AS platforms,
  ROUND(AVG(CAST(pm.rating AS DOUBLE)), 2) AS avg_rating, CAST(SUM(pm.review_count) AS BIGINT) AS total_reviews
{MATCHED} GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT pm.platform) >= 2""")
def _(pm, m, mm):
    return cv.cross_platform_overlap(pm, m, mm)


@query("price_comparison", ALL, f"""
SELECT m.canonical_name, pm.platform, pm.market, pm.price_bucket, CAST(pm.delivery_fee AS DOUBLE) AS delivery_fee,
  pm.estimated_delivery_min, CAST(pm.rating AS DOUBLE) AS rating
{MATCHED} WHERE m.id IN (SELECT merchant_id FROM merchant_matches GROUP BY merchant_id HAVING COUNT(*) >= 2)""")
def _(pm, m, mm):
    return cv.price_comparison(pm, m, mm)


@query("cuisine_distribution", PM, """
SELECT platform, cuisine, COUNT(*) AS merchant_count FROM
 (SELECT platform, UNNEST(cuisine_tags) AS cuisine FROM platform_merchants WHERE cuisine_tags IS NOT NULL) t
GROUP BY platform, cuisine""")
def _(pm):
    return cv.cuisine_distribution(pm)


@query("crawl_health", ("crawl_runs",), """
SELECT platform, market, strftime(CAST(DATE_TRUNC('week', started_at) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS week,
  COUNT(*) AS crawl_count, COUNT(CASE WHEN status = 'success' THEN 1 END) AS successes,
  COUNT(CASE WHEN status = 'failed' THEN 1 END) AS failures, ROUND(AVG(merchants_found), 0) AS avg_merchants_per_crawl
FROM crawl_runs GROUP BY 1, 2, 3""")
def _(runs):
    return cv.crawl_health(runs)


@query("week_bucket", ("crawl_runs",), """
SELECT id, strftime(CAST(DATE_TRUNC('week', started_at) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS week FROM crawl_runs""")
def _(runs):
    return runs.select("id", cv.week_bucket(F.col("started_at")).alias("week"))


@query("quality_score", PM, """
SELECT id, ROUND(COALESCE(CAST(rating AS DOUBLE), 0) * LOG10(COALESCE(review_count, 1) + 1), 6) AS by_log10,
  ROUND(COALESCE(CAST(rating AS DOUBLE), 0) * LN(COALESCE(review_count, 1) + 1), 6) AS by_ln
FROM platform_merchants""")
def _(pm):
    r, n = F.col("rating"), F.col("review_count")
    return pm.select("id", F.round(cv.quality_score(r, n), 6).alias("by_log10"), F.round(cv.quality_score(r, n, True), 6).alias("by_ln"))


@query("acquisition_targets", ALL, f"""
SELECT pm.id, pm.platform, pm.market, pm.name, pm.address, CAST(pm.rating AS DOUBLE) AS rating, pm.review_count, {TAGS}, pm.price_bucket,
  ROUND(COALESCE(CAST(pm.rating AS DOUBLE), 0) * LOG10(COALESCE(pm.review_count, 1) + 1), 6) AS quality_score
{ENTITY_JOINS} WHERE {GAP}
ORDER BY COALESCE(CAST(pm.rating AS DOUBLE), 0) * LOG10(COALESCE(pm.review_count, 1) + 1) DESC, pm.id LIMIT 500""")
def _(pm, m, mm):
    return cv.acquisition_targets(pm, m, mm).withColumn("quality_score", F.round("quality_score", 6))


_LN = "CAST(COALESCE(CAST(pm.rating AS DOUBLE), 0) * LN(COALESCE(pm.review_count, 1) + 1) AS DECIMAL(10,1))"


@query("acquisition_targets_ln", ALL, f"""
SELECT pm.id, pm.name, pm.platform, pm.market, CAST(pm.rating AS DOUBLE) AS rating, pm.review_count, CAST({_LN} AS DOUBLE) AS quality_score
{ENTITY_JOINS} WHERE pm.platform <> 'ubereats' AND {GAP} ORDER BY {_LN} DESC, pm.id LIMIT 100""")
def _(pm, m, mm):
    return cv.acquisition_targets_ln(pm, m, mm)


@query("topk", PM, """
SELECT id, CAST(rating AS DOUBLE) AS rating, review_count FROM platform_merchants
ORDER BY rating DESC NULLS LAST, review_count DESC NULLS LAST, id LIMIT 100""")
def _(pm):
    order = [F.desc_nulls_last("rating"), F.desc_nulls_last("review_count"), F.col("id")]
    return pm.select("id", "rating", "review_count").orderBy(*order).limit(100)


@query("gap_count_by_platform", ALL, f"""
SELECT pm.platform, COUNT(*) AS gap_count {ENTITY_JOINS} WHERE pm.platform <> 'ubereats' AND {GAP} GROUP BY pm.platform""")
def _(pm, m, mm):
    return cv.gap_count_by_platform(pm, m, mm)


@query("total_merchants", PM, "SELECT platform, COUNT(DISTINCT platform_id) AS total_merchants FROM platform_merchants GROUP BY platform")
def _(pm):
    return cv.total_merchants(pm)


@query("coverage_report", PM, "SELECT market, platform, COUNT(*) AS cnt FROM platform_merchants GROUP BY market, platform")
def _(pm):
    return cv.coverage_report(pm)


@query("coverage_report_sink", PM, """
SELECT market, platform, COUNT(*) AS cnt FROM platform_merchants GROUP BY market, platform""")
def _(pm):
    nested = cv.coverage_report_nested(pm)
    return nested.select("market", F.explode("platforms").alias("platform", "cnt"))


@query("null_or_blank", PM, f"SELECT id FROM platform_merchants WHERE {BLANK}")
def _(pm):
    return pm.where(dq.null_or_blank(F.col("address"))).select("id")


@query("null_or_empty_array", PM, "SELECT id FROM platform_merchants WHERE cuisine_tags IS NULL OR len(cuisine_tags) = 0")
def _(pm):
    return pm.where(dq.null_or_empty_array(F.col("cuisine_tags"))).select("id")


@query("stale_filter", PM, f"""
SELECT id FROM platform_merchants WHERE scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL '7 days'""")
def _(pm):
    return pm.where(dq.stale(F.col("scraped_at"), F.lit(AS_OF).cast("timestamp"))).select("id")


@query("geo_valid", PM, """
SELECT id, COALESCE(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180, FALSE) AS ok FROM platform_merchants""")
def _(pm):
    return pm.select("id", dq.geo_valid(F.col("lat"), F.col("lng")).alias("ok"))


@query("dq_metrics", PM, f"""
WITH c AS (SELECT COUNT(*) AS total_merchants,
  COUNT(*) FILTER (WHERE address IS NULL OR address = '') AS missing_address_count,
  COUNT(*) FILTER (WHERE cuisine_tags IS NULL OR len(cuisine_tags) = 0) AS missing_cuisine_count,
  COUNT(*) FILTER (WHERE scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL '7 days') AS stale_merchant_count,
  COUNT(*) FILTER (WHERE lat IS NULL OR lng IS NULL) AS invalid_coords_count FROM platform_merchants),
s AS (SELECT *, ROUND(GREATEST(0, (total_merchants - missing_address_count - missing_cuisine_count) / NULLIF(total_merchants, 0) * 100), 2) AS completeness_score,
  ROUND((total_merchants - stale_merchant_count) / NULLIF(total_merchants, 0) * 100, 2) AS freshness_score,
  ROUND((total_merchants - invalid_coords_count) / NULLIF(total_merchants, 0) * 100, 2) AS geo_accuracy_score FROM c)
SELECT *, ROUND(completeness_score * 0.4 + freshness_score * 0.6, 2) AS overall_health FROM s""")
def _(pm):
    return dq.dq_metrics(pm, AS_OF)


@query("dq_completeness", PM, f"""
SELECT ROUND(GREATEST(0, (COUNT(*) - COUNT(*) FILTER (WHERE {BLANK})) / NULLIF(COUNT(*), 0) * 100), 2) AS completeness_score
FROM platform_merchants""")
def _(pm):
    return dq.dq_completeness(pm)


@query("dq_freshness", PM, f"""
SELECT ROUND(GREATEST(0, (COUNT(*) - COUNT(*) FILTER (WHERE scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL '7 days')) / NULLIF(COUNT(*), 0) * 100), 2) AS freshness_score
FROM platform_merchants""")
def _(pm):
    return dq.dq_freshness(pm, AS_OF)


@query("scalar_cross", PM, f"""
WITH totals AS (SELECT COUNT(*) AS total FROM platform_merchants),
missing AS (SELECT COUNT(*) AS cnt FROM platform_merchants WHERE {BLANK})
SELECT total, cnt, total - cnt AS complete FROM totals, missing""")
def _(pm):
    totals = pm.agg(F.count("*").alias("total"), F.count_if(dq.null_or_blank(F.col("address"))).alias("cnt"))
    return totals.withColumn("complete", F.col("total") - F.col("cnt"))


_MISSING_BY_PLATFORM = f"""
SELECT p.platform, COALESCE(m.cnt, 0) AS missing_address FROM (SELECT DISTINCT platform FROM platform_merchants) p
LEFT JOIN (SELECT platform, COUNT(*) AS cnt FROM platform_merchants WHERE {BLANK} GROUP BY platform) m ON m.platform = p.platform"""


@query("dim_left_counts", PM, """
SELECT p.platform, COALESCE(m.cnt, 0) AS cnt FROM (SELECT DISTINCT platform FROM platform_merchants) p
LEFT JOIN (SELECT platform, COUNT(*) AS cnt FROM platform_merchants WHERE is_promoted GROUP BY platform) m ON m.platform = p.platform""")
def _(pm):
    # Counting inside one grouping zero-fills without a join.
    return pm.groupBy("platform").agg(F.count_if("is_promoted").alias("cnt"))


@query("dq_missing_address_by_platform", PM, _MISSING_BY_PLATFORM)
def _(pm):
    return dq.dq_missing_address_by_platform(pm)


@query("dq_missing_address_fields", PM, r"""
SELECT platform, COUNT(*) FILTER (WHERE address IS NULL OR trim(address) = '') AS missing_address,
  COUNT(*) FILTER (WHERE trim(address) <> '' AND NOT regexp_matches(address, '[0-9]{4}\s*[A-Z]{0,2}\b')) AS missing_postal,
  COUNT(*) FILTER (WHERE trim(address) <> '' AND regexp_matches(address, '[0-9]{4}\s*[A-Z]{0,2}\b')
    AND trim(regexp_extract(address, '[0-9]{4}\s*[A-Z]{0,2}\s*,?\s*(.+)$', 1)) = '') AS missing_city
FROM platform_merchants GROUP BY platform""")
def _(pm):
    return dq.dq_missing_address_fields(pm)


_STATS = """WITH stats AS (SELECT platform, AVG(CAST(rating AS DOUBLE)) AS avg_r, NULLIF(STDDEV_SAMP(CAST(rating AS DOUBLE)), 0) AS std_r,
  AVG(CAST(review_count AS DOUBLE)) AS avg_rc, NULLIF(STDDEV_SAMP(CAST(review_count AS DOUBLE)), 0) AS std_rc
  FROM platform_merchants GROUP BY platform)"""
_OUTLIER = """(ABS(CAST(pm.rating AS DOUBLE) - s.avg_r) / s.std_r > 2 OR ABS(pm.review_count - s.avg_rc) / s.std_rc > 2)"""


@query("join_group_stats", PM, f"""
{_STATS} SELECT pm.id, ROUND(ABS(CAST(pm.rating AS DOUBLE) - s.avg_r) / s.std_r, 6) AS z_rating,
  ROUND(ABS(pm.review_count - s.avg_rc) / s.std_rc, 6) AS z_reviews
FROM platform_merchants pm JOIN stats s ON s.platform = pm.platform""")
def _(pm):
    return dq.with_z_scores(pm).select("id", F.round("z_rating", 6).alias("z_rating"), F.round("z_reviews", 6).alias("z_reviews"))


@query("dq_anomalies", PM, f"""
{_STATS} SELECT COUNT(*) AS anomaly_merchants FROM platform_merchants pm JOIN stats s ON s.platform = pm.platform WHERE {_OUTLIER}""")
def _(pm):
    return dq.dq_anomalies(pm)


@query("dq_anomalies_by_platform", PM, f"""
{_STATS} SELECT pm.platform, COUNT(*) AS anomaly_count FROM platform_merchants pm JOIN stats s ON s.platform = pm.platform
WHERE {_OUTLIER} GROUP BY pm.platform""")
def _(pm):
    return dq.dq_anomalies_by_platform(pm)


@query("dq_counters", ("platform_merchants", "menu_items"), """
WITH bad AS (SELECT platform_merchant_id, COUNT(*) AS n FROM menu_items WHERE price IS NULL OR price < 0 GROUP BY 1)
SELECT platform, market, COUNT(*) FILTER (WHERE address IS NULL OR address = '') AS missing_address,
  COUNT(*) FILTER (WHERE cuisine_tags IS NULL OR len(cuisine_tags) = 0) AS missing_cuisine,
  COUNT(*) FILTER (WHERE lat IS NULL OR lng IS NULL OR lat = 0 OR lng = 0) AS missing_coords,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS invalid_price
FROM platform_merchants pm LEFT JOIN bad ON bad.platform_merchant_id = pm.id GROUP BY platform, market""")
def _(pm, items):
    return dq.dq_counters(pm, items)


@query("market_mode", PM, """
SELECT COALESCE((SELECT market FROM platform_merchants WHERE market IS NOT NULL
  GROUP BY market ORDER BY COUNT(*) DESC, market LIMIT 1), 'unknown') AS market""")
def _(pm):
    return dq.market_mode(pm)


@query("threshold_status", PM, f"""
{_STATS}, v AS (SELECT 'completeness' AS metric, ROUND(GREATEST(0, (COUNT(*) - COUNT(*) FILTER (WHERE {BLANK})) / NULLIF(COUNT(*), 0) * 100), 2) AS value, 75 AS lo, 95 AS hi, TRUE AS score FROM platform_merchants
UNION ALL SELECT 'freshness', ROUND(GREATEST(0, (COUNT(*) - COUNT(*) FILTER (WHERE scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL '7 days')) / NULLIF(COUNT(*), 0) * 100), 2), 80, 95, TRUE FROM platform_merchants
UNION ALL SELECT 'missing_address', CAST(COUNT(*) FILTER (WHERE {BLANK}) AS DOUBLE), 50, 200, FALSE FROM platform_merchants
UNION ALL SELECT 'anomalies', CAST(COUNT(*) AS DOUBLE), 10, 50, FALSE FROM platform_merchants pm JOIN stats s ON s.platform = pm.platform WHERE {_OUTLIER})
SELECT metric, value, CASE WHEN value >= hi THEN CASE WHEN score THEN 'green' ELSE 'red' END WHEN value >= lo THEN 'orange'
  WHEN score THEN 'red' ELSE 'green' END AS status FROM v""")
def _(pm):
    return dq.status_report(pm, AS_OF)


@query("snapshot_counts", PM, """
SELECT '2024-01-15' AS snapshot_date, platform, COUNT(DISTINCT platform_id) AS count FROM platform_merchants GROUP BY platform""")
def _(pm):
    return tb.snapshot_counts(pm, AS_OF[:10])


@query("snapshot_upsert", ("daily_counts", "platform_merchants"), """
WITH today AS (SELECT DATE '2024-01-15' AS snapshot_date, platform, COUNT(DISTINCT platform_id) AS count FROM platform_merchants GROUP BY platform)
SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, platform, count FROM today
UNION ALL SELECT strftime(d.snapshot_date, '%Y-%m-%d'), d.platform, d.count FROM daily_counts d
WHERE NOT EXISTS (SELECT 1 FROM today t WHERE t.snapshot_date = d.snapshot_date AND t.platform = d.platform)""")
def _(history, pm):
    return tb.upsert_snapshot(history, pm, AS_OF[:10])


@query("wow_delta", ("daily_counts",), """
SELECT strftime(a.snapshot_date, '%Y-%m-%d') AS snapshot_date, a.platform, a.count, b.count AS count_before, a.count - b.count AS delta
FROM daily_counts a LEFT JOIN daily_counts b ON b.platform = a.platform AND b.snapshot_date = a.snapshot_date - INTERVAL '7 days'""")
def _(counts):
    return tb.wow_delta(counts)


@query("distinct_ids", ("merchant_matches",), """
SELECT platform_merchant_id AS id FROM merchant_matches UNION SELECT merchant_id FROM merchant_matches""")
def _(mm):
    return mm.select(F.col("platform_merchant_id").alias("id")).union(mm.select("merchant_id")).distinct()


@query("concat_platforms", PM, """
SELECT CASE platform WHEN 'ubereats' THEN 0 WHEN 'justeattakeaway' THEN 1 WHEN 'doordash' THEN 2 ELSE 3 END AS part, id,
  platform, COALESCE(name, '') AS name FROM platform_merchants""")
def _(pm):
    named = pm.select("id", "platform", F.coalesce("name", F.lit("")).alias("name"))
    return tb.concat_listings([named.where(F.col("platform") == p) for p in ("ubereats", "justeattakeaway", "doordash", "grubhub")])


@query("sample_one", PM, "SELECT CAST(LEAST(COUNT(*), 1) AS BIGINT) AS sampled, CAST(LEAST(COUNT(*), 1) AS BIGINT) AS known FROM platform_merchants")
def _(pm):
    """Which row comes is left to chance; that it is one, and one of the table's, is not."""
    rows = pm.select("id", "platform", "name")
    one = cv.sample_one(rows, seed=7).alias("s")
    same = F.col("s.id").eqNullSafe(F.col("r.id")) & F.col("s.platform").eqNullSafe(F.col("r.platform")) & F.col("s.name").eqNullSafe(F.col("r.name"))
    held = one.join(rows.alias("r"), same, "left_semi")
    return one.agg(F.count("*").alias("sampled")).crossJoin(held.agg(F.count("*").alias("known")))


@query("coverage_margins", PM, """
SELECT platform, market, CAST(GROUPING(platform, market) AS INT) AS margin, COUNT(*) AS listings, COUNT(DISTINCT platform_id) AS distinct_listings
FROM platform_merchants GROUP BY CUBE (platform, market)""")
def _(pm):
    return cv.coverage_margins(pm)


_GAPS = "(dayofyear(snapshot_date) + length(platform)) % 3 <> 0"


@query("delta_as_of", ("daily_counts",), f"""
WITH g AS (SELECT * FROM daily_counts WHERE {_GAPS})
SELECT strftime(a.snapshot_date, '%Y-%m-%d') AS snapshot_date, a.platform, a.count, b.count AS count_before,
  CAST(a.snapshot_date - b.snapshot_date AS INT) AS days, a.count - b.count AS delta
FROM (SELECT *, CAST(snapshot_date - INTERVAL 7 DAYS AS DATE) AS t FROM g) a ASOF LEFT JOIN g b ON a.platform = b.platform AND a.t >= b.snapshot_date""")
def _(counts):
    """Every third day of a platform has no snapshot."""
    return tb.delta_as_of(counts.where(_GAPS))


_RUNS = "started_at + INTERVAL '1' MINUTE * CAST(merchants_found % 500 AS INT)"


@query("audit_by_time", ("listing_batch", "crawl_runs"), f"""
WITH r AS (SELECT id, platform, market, started_at, CASE WHEN status = 'running' THEN NULL ELSE {_RUNS} END AS finished_at FROM crawl_runs),
l AS (SELECT platform, 'market' || (seq % 5) AS market, scraped_at FROM listing_batch)
SELECT r.id, COUNT(l.scraped_at) AS merchants_found FROM r
LEFT JOIN l ON l.platform = r.platform AND l.market = r.market AND l.scraped_at >= r.started_at AND (r.finished_at IS NULL OR l.scraped_at <= r.finished_at) GROUP BY r.id""")
def _(batch, runs):
    """Runs take up to 500 minutes and overlap; those still running have no end."""
    ended = F.expr(f"CASE WHEN status = 'running' THEN NULL ELSE {_RUNS} END")
    return tb.audit_by_time(batch.withColumn("market", F.concat(F.lit("market"), F.col("seq") % 5)), runs.withColumn("finished_at", ended))


@query("merged_distinct", ("listing_batch",), """
SELECT strftime(date_trunc('week', scraped_at), '%Y-%m-%d') AS week, platform, COUNT(DISTINCT platform_id) AS exact, TRUE AS within_bound FROM listing_batch GROUP BY 1, 2""")
def _(batch):
    """Weeks from the sketches of their days, next to the exact number: within four standard errors."""
    week = F.to_date(F.date_trunc("week", "snapshot_date")).alias("week")
    merged = tb.merged_counts(tb.daily_sketches(batch), week, "platform")
    exact = batch.groupBy(F.to_date(F.date_trunc("week", "scraped_at")).alias("week"), "platform").agg(F.count_distinct("platform_id").alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= 4 * tb.SKETCH_ERROR * F.col("exact")
    return exact.join(merged, ["week", "platform"]).select("week", "platform", "exact", near.alias("within_bound"))
