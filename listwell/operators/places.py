"""Joins by place: which points lie within a distance of each other.

Points are put on a sphere in three dimensions and into cubes whose edge is twice the chord of
the distance. A point's own cube and those its reach touches, eight at most, hold every
point within the distance, wherever it is: there is no pole and no date line in space. A point
looks into its eight cubes and is found in one, so each pair is met once; the exact
great-circle distance decides.

Points are reduced to distinct places first, so copies of one point, however many, are one
row. A cube with very many places is dealt to several tasks: its places are split, and
those who look into it look into each part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions.similarity import EARTH_RADIUS_M, geo_distance_m, geo_valid
from listwell.session import cut_lineage

AXES = ("x", "y", "z")
#: Places of a cube that one task compares; and how many cubes may be split at most.
CUBE_PLACES, MOST_SPLIT = 4_000, 100_000


def has_point(lat: Column, lng: Column) -> Column:
    """Both coordinates are there, in range, and neither is 0, which stands for "unknown" throughout."""
    return geo_valid(lat, lng) & F.coalesce((lat != 0) & (lng != 0), F.lit(False))


def places(listings: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(lat, lng, by…, listings, first_id): distinct usable points, with how many listings each has and the least id."""
    return (
        listings.where(has_point(F.col("lat"), F.col("lng"))).groupBy("lat", "lng", *(by or []))
        .agg(F.count("*").alias("listings"), F.min("id").alias("first_id"))
    )


def _in_space(lat: Column, lng: Column) -> dict[str, Column]:
    p, q = F.radians(lat), F.radians(lng)
    return {"x": F.cos(p) * F.cos(q) * EARTH_RADIUS_M, "y": F.cos(p) * F.sin(q) * EARTH_RADIUS_M, "z": F.sin(p) * EARTH_RADIUS_M}


def near_links(points: DataFrame, radius_m: float) -> DataFrame:
    """(lat_a, lng_a, lat_b, lng_b, distance_m): ordered pairs of points (lat, lng) within the distance, each with itself too.

    ``points`` are distinct. No pair is lost at an edge: reaches are widened by a hair, and the distance is checked.
    """
    if not radius_m >= 0:
        raise ValueError("the distance must not be negative")
    half = min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2)
    reach = 2 * EARTH_RADIUS_M * math.sin(half) * (1 + 1e-9) + 0.01
    cube = lambda c, shift=0.0: F.floor((F.col(c) + shift) / (2 * reach))
    spaced = points.select("lat", "lng").withColumns(_in_space(F.col("lat"), F.col("lng")))
    inside = cut_lineage(spaced.select("lat", "lng", *[cube(c).alias(f"c{c}") for c in AXES]))
    cubes = [f"c{c}" for c in AXES]
    # At most MOST_SPLIT cubes can hold so large a share of all places.
    crowd = max(CUBE_PLACES, -(-inside.count() // MOST_SPLIT))
    crowded = inside.groupBy(*cubes).agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    crowded = F.broadcast(crowded.select(*cubes, F.ceil(F.col("n") / crowd).cast("int").alias("parts")))
    one = F.coalesce("parts", F.lit(1))
    found = inside.join(crowded, cubes, "left").select(
        F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"), *cubes, F.pmod(F.xxhash64("lat", "lng"), one).cast("int").alias("part")
    )
    looking = spaced.select(F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"), *AXES)
    for c in AXES:
        touched = F.array_distinct(F.array(cube(c, -reach), cube(c, reach)))
        looking = looking.withColumn(f"c{c}", F.explode(touched)).drop(c)
    looking = looking.join(crowded, cubes, "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    distance = geo_distance_m(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))
    met = looking.join(found, [*cubes, "part"]).select("lat_a", "lng_a", "lat_b", "lng_b", distance.alias("distance_m"))
    return met.where(F.col("distance_m") <= radius_m)


def near_places(listings: DataFrame, radius_m: float = 400.0) -> DataFrame:
    """Pairs of different places within the distance, each once, with the listings at either and their least ids."""
    at = cut_lineage(places(listings))
    links = near_links(at, radius_m).where("lat_a < lat_b OR (lat_a = lat_b AND lng_a < lng_b)")
    side = lambda s: at.select(F.col("lat").alias(f"lat_{s}"), F.col("lng").alias(f"lng_{s}"), F.col("listings").alias(f"listings_{s}"), F.col("first_id").alias(f"first_id_{s}"))
    return links.join(side("a"), ["lat_a", "lng_a"]).join(side("b"), ["lat_b", "lng_b"])


def nearest_elsewhere(listings: DataFrame, radius_m: float = 400.0) -> DataFrame:
    """(id, near, nearest_id, nearest_m) of every listing: listings of other platforms within the distance, and the nearest.

    Of those that are equally near, to the millimetre, the least id counts. Worked out per place and platform: no pair of listings is formed, and what a
    place sees of another is one row per platform that is there. Listings without a usable point see none.
    """
    at = cut_lineage(places(listings, ["platform"]))
    points = at.select("lat", "lng").distinct()
    links = cut_lineage(near_links(points, radius_m))
    there = at.select(F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"), F.col("platform").alias("other"), "listings", "first_id")
    # What each place sees, by platform: so many listings, the nearest of them.
    seen = links.join(there, ["lat_b", "lng_b"]).groupBy("lat_a", "lng_a", "other").agg(
        F.sum("listings").alias("n"), F.min(F.struct(F.round("distance_m", 3).alias("distance_m"), "first_id")).alias("best")
    )
    here = at.select(F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"), "platform")
    summed = here.join(seen, ["lat_a", "lng_a"]).where(~F.col("platform").eqNullSafe(F.col("other"))).groupBy("lat_a", "lng_a", "platform").agg(
        F.sum("n").alias("near"), F.min("best").alias("best")
    )
    same = (F.col("lat") == F.col("lat_a")) & (F.col("lng") == F.col("lng_a")) & F.col("l.platform").eqNullSafe(F.col("s.platform"))
    rows = listings.select("id", "platform", "lat", "lng").alias("l").join(summed.alias("s"), same, "left")
    return rows.select("id", F.coalesce("near", F.lit(0).cast("bigint")).alias("near"), F.col("best.first_id").alias("nearest_id"), F.col("best.distance_m").alias("nearest_m"))
