"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwell.session import cut_lineage

EDGES_A_TASK = 50_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the least node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the least of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    least = down.groupBy("src").agg(F.min("dst").alias("low"))
    moved = down.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(least.select("src", F.col("low").alias("dst"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.col("dst").cast("decimal(38,0)"))).first()
    return tuple(row)


def _kept(edges: DataFrame, size: int) -> DataFrame:
    """Checkpoint of about ``size`` edges, a file for each EDGES_A_TASK: a shuffle gives as many as it has partitions, however few edges there are."""
    return cut_lineage(edges.coalesce(1 + size // EDGES_A_TASK))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(entity_id, member_id) for every node of an edge; the entity id is its least member.

    Neighbourhoods are reduced to their minimum, which adds up before the shuffle, and are
    never gathered, so a node that a third of all edges touch costs no more than
    others. The rounds grow with the logarithm of the longest path. Each round ends in a
    reliable checkpoint, read twice: by its fingerprint and by the next round.
    """
    own = cut_lineage(edges.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst")))
    current = _kept(_small_star(own), own.count())
    seen = _fingerprint(current)
    while True:
        current = _kept(_small_star(_large_star(current)), seen[0])
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    stars = current.select(F.col("dst").alias("entity_id"), F.col("src").alias("member_id"))
    loops = own.where("src = dst").select(F.col("src").alias("member_id")).distinct()
    alone = loops.join(
        stars.select("member_id").union(stars.select("entity_id")), "member_id", "left_anti"
    ).select(F.col("member_id").alias("entity_id"), "member_id")
    roots = stars.select("entity_id").distinct().select("entity_id", F.col("entity_id").alias("member_id"))
    return stars.unionByName(roots).unionByName(alone)
