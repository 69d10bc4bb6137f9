"""Listing tables derived from the star-schema test tables (see FIXTURES.md, section 2).

One SQL text per table serves both engines: DuckDB takes it as written, Spark takes
it with integer division spelled ``DIV``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listwell.session import spread

AS_OF = "2024-01-15 00:00:00"

_PLATFORM = (
    "CASE {k} % 4 WHEN 0 THEN 'ubereats' WHEN 1 THEN 'justeattakeaway' "
    "WHEN 2 THEN 'doordash' ELSE 'grubhub' END"
)
_PART_PLATFORM = _PLATFORM.format(k="p_partkey")
_USER_PLATFORM = _PLATFORM.format(k="user_id")

TABLES: dict[str, tuple[str, str]] = {
    "platform_merchants": ("part", f"""
SELECT CAST(p_partkey + 1 AS BIGINT) AS id,
  {_PART_PLATFORM} AS platform,
  CONCAT('m', CAST(p_partkey AS VARCHAR(20))) AS platform_id,
  CONCAT(p_name, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' - Delivery'
      WHEN 2 THEN ' | Amsterdam' WHEN 3 THEN ' (Uber Eats)' ELSE ' Amsterdam Amsterdam' END) AS name,
  CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN NULL
       WHEN p_partkey % 2 = 0 THEN CONCAT(p_type, ' St ', CAST(p_size AS VARCHAR(9)), ', 1054AB Amsterdam')
       ELSE CONCAT(CAST(p_size AS VARCHAR(9)), ' ', p_type, ' Street, 1054 Amsterdam') END AS address,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(52.3 + (p_partkey % 100) * 0.001 AS DOUBLE) END AS lat,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(4.8 + (p_partkey % 90) * 0.001 AS DOUBLE) END AS lng,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE split(CONCAT(LOWER(p_type), ',',
      CASE p_size % 3 WHEN 0 THEN 'sushi,ramen' WHEN 1 THEN 'Fast Food' ELSE 'vegan ,vegan' END), ',') END AS cuisine_tags,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST((p_partkey * 7 % 51) / 10.0 AS DECIMAL(3,2)) END AS rating,
  CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN 99999
       ELSE CAST(p_partkey * 13 % 500 AS INT) END AS review_count,
  CASE p_size % 4 WHEN 0 THEN '$' WHEN 1 THEN 'mid' WHEN 2 THEN '3' ELSE NULL END AS price_bucket,
  CAST((p_partkey % 40) / 4.0 AS DECIMAL(6,2)) AS delivery_fee,
  CAST(15 + p_partkey % 45 AS INT) AS estimated_delivery_min,
  p_partkey % 12 = 0 AS is_promoted,
  CASE WHEN (p_partkey // 4) % 5 = 0 THEN NULL
       ELSE CONCAT('market', CAST((p_partkey // 4) % 5 AS VARCHAR(9))) END AS market,
  CASE WHEN p_partkey % 17 = 0 THEN NULL
       ELSE CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' DAY * CAST(p_partkey % 20 AS INT) END AS scraped_at,
  CONCAT('https://example.org/store/m', CAST(p_partkey AS VARCHAR(20))) AS raw_url
FROM part"""),
    "merchants": ("part", """
SELECT CAST(p_partkey // 3 + 1 AS BIGINT) AS id, MIN(p_name) AS canonical_name, MAX(p_type) AS canonical_addr,
  MAX(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) = 1 AS is_on_our_platform
FROM part WHERE p_partkey % 6 < 4 GROUP BY p_partkey // 3"""),
    "merchant_matches": ("part", """
SELECT CAST(p_partkey + 1 AS BIGINT) AS platform_merchant_id, CAST(p_partkey // 3 + 1 AS BIGINT) AS merchant_id,
  CAST(0.8 + (p_partkey % 20) / 100.0 AS DECIMAL(4,3)) AS confidence, 'field_fuzzy' AS match_method
FROM part WHERE p_partkey % 6 < 4"""),
    "crawl_runs": ("events", f"""
SELECT event_id AS id, {_USER_PLATFORM} AS platform,
  CONCAT('market', CAST(user_id % 5 AS VARCHAR(9))) AS market, ts AS started_at,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
  CAST(FLOOR(value) AS INT) AS merchants_found FROM events"""),
    "listing_batch": ("events", f"""
SELECT event_id AS seq, {_USER_PLATFORM} AS platform,
  CONCAT('m', CAST(user_id AS VARCHAR(20))) AS platform_id, CONCAT(event_type, ' kitchen') AS name,
  value AS delivery_fee, ts AS scraped_at
FROM events"""),
    "menu_items": ("lineitem", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey + 1 AS platform_merchant_id,
  CONCAT('item ', CAST(l_linenumber AS VARCHAR(9))) AS name,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 3 = 0 THEN CAST(-1 AS DECIMAL(8,2))
       ELSE CAST(l_quantity AS DECIMAL(8,2)) END AS price
FROM lineitem"""),
    "daily_counts": ("events", f"""
SELECT CAST(ts AS DATE) AS snapshot_date, {_USER_PLATFORM} AS platform,
  COUNT(DISTINCT user_id) AS count FROM events GROUP BY 1, 2"""),
    "raw_pages": ("part", f"""
SELECT CONCAT({_PART_PLATFORM},
    '/2024-01-0', CAST(p_partkey % 9 + 1 AS VARCHAR(9)), '/market', CAST(p_partkey % 5 AS VARCHAR(9)),
    '/listing_', CAST(p_partkey AS VARCHAR(20)), '.html') AS page_key,
  CASE p_partkey % 4
    WHEN 2 THEN CONCAT('<html><script id="__NEXT_DATA__" type="application/json">{{"props":{{"pageProps":{{"stores":[{{"id":"', CAST(p_partkey AS VARCHAR(20)), '","name":"', p_name, '","address":{{"formattedAddress":"', p_type, ' St 1","lat":52.3,"lng":-4.9}},"tags":[{{"name":"sushi"}}],"averageRating":4.5,"numRatings":', CAST(p_size AS VARCHAR(9)), ',"deliveryFee":2.99}}]}}}}}}</script></html>')
    WHEN 1 THEN CONCAT('<html><script id="__REACT_QUERY_STATE__" type="application/json">{{"queries":[{{"state":{{"data":{{"restaurantData":{{"r', CAST(p_partkey AS VARCHAR(20)), '":{{"name":"', p_name, '","uniqueName":"u', CAST(p_size AS VARCHAR(9)), '","address":{{"firstLine":"Street 1","postalCode":"1054 HG","city":"Amsterdam","location":{{"coordinates":[4.87,52.36]}}}},"rating":{{"score":4.2,"count":85}}}}}}}}}}}}]}}</script></html>')
    WHEN 0 THEN CONCAT('<html><body><div class="_hs x"><a data-testid="store-card" href="/nl-en/store/slug/s', CAST(p_partkey AS VARCHAR(20)), '?q=1"><h3>', p_name, '</h3></a><span>', p_type, ' 12, 1053 AB Amsterdam</span><span aria-label="Rating 4,6 of 5 based on 1.234 reviews"></span></div></body></html>')
    ELSE '<html></html>' END AS html
FROM part"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the eight derived tables, or a given table by its own name."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, sql = TABLES[name]
    text = sql.replace(" // ", " DIV ")
    head, _, tail = text.rpartition(f"FROM {source}")
    # Spark's own argument slots use braces, which the page texts also contain.
    text = head.replace("{", "{{").replace("}", "}}") + "FROM {src}" + tail
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    # A page is a hundred times as long as the row it is made of.
    return spark.sql(text, src=spread(rows, "p_partkey") if name == "raw_pages" else rows)


def ctes(*names: str) -> str:
    """``name AS (…)`` clauses for the given derived tables, joined by commas."""
    return ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in names)
