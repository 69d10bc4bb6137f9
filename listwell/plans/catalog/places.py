"""Joins by place."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwell.operators import places as pl
from listwell.plans.catalog.common import registrar

ENTRIES, query = registrar()
PM = ("platform_merchants",)

_USABLE = "lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND lat <> 0 AND lng <> 0 AND NOT isnan(lat) AND NOT isnan(lng)"
_DISTANCE = """2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lng) - radians(a.lng)) / 2), 2))))"""


@query("near_places", PM, f"""
WITH p AS (SELECT lat, lng, COUNT(*) AS listings, MIN(id) AS first_id FROM platform_merchants WHERE {_USABLE} GROUP BY lat, lng),
d AS (SELECT a.lat AS lat_a, a.lng AS lng_a, b.lat AS lat_b, b.lng AS lng_b, a.listings AS listings_a, b.listings AS listings_b,
  a.first_id AS first_id_a, b.first_id AS first_id_b, {_DISTANCE} AS distance FROM p a JOIN p b ON a.lat < b.lat OR (a.lat = b.lat AND a.lng < b.lng))
SELECT * EXCLUDE distance, ROUND(distance, 2) AS distance_m FROM d WHERE distance <= 400""")
def _(pm):
    return pl.near_places(pm, 400.0).withColumn("distance_m", F.round("distance_m", 2))


@query("nearest_elsewhere", PM, f"""
WITH v AS (SELECT id, platform, lat, lng FROM platform_merchants WHERE {_USABLE}),
d AS (SELECT a.id, b.id AS other, {_DISTANCE} AS distance FROM v a JOIN v b ON a.platform <> b.platform),
n AS (SELECT id, other, ROUND(distance, 3) AS distance, COUNT(*) OVER (PARTITION BY id) AS near,
  row_number() OVER (PARTITION BY id ORDER BY ROUND(distance, 3), other) AS place FROM d WHERE distance <= 400)
SELECT m.id, COALESCE(near, 0) AS near, other AS nearest_id, distance AS nearest_m
FROM platform_merchants m LEFT JOIN n ON n.id = m.id AND place = 1""")
def _(pm):
    return pl.nearest_elsewhere(pm, 400.0)
