"""Keyed writes as table-to-table jobs: upsert, child rows, snapshots, cleanups, audit.

Tables stay plain DataFrames. Batches are reduced per key with ``max_by``, which adds up
inside each partition before it shuffles, so a key that fills a third of a batch costs
one row per partition.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwell.session import cut_lineage


def latest(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` values."""
    rest = [c for c in batch.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("row")
    return batch.groupBy(*keys).agg(picked).select(*keys, "row.*").select(*batch.columns)


def earliest(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` values."""
    rest = [c for c in rows.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("row")
    return rows.groupBy(*keys).agg(picked).select(*keys, "row.*").select(*rows.columns)


def first_seen(listings: DataFrame) -> DataFrame:
    """First occurrence of each listing in page order."""
    return earliest(listings, ["platform", "platform_id"], ["page_key", "pos"])


def stable_id(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


Change = Callable[[Column, Column], Column]


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    id_column: str | None = None,
    update_cols: Sequence[str] | None = None,
    insert_only: Sequence[str] = (),
    changes: dict[str, Change] | None = None,
) -> DataFrame:
    """``target`` with ``batch`` merged in by key; the last row of a key in the batch wins.

    ``update_cols`` are overwritten on a hit (default: every column both sides have, keys
    and ``insert_only`` apart). ``changes`` computes a column from (old, new) instead.
    A new key gets every batch column, null elsewhere, and a hashed id.

    Updates keep the target's layout: the batch, small as a rule, is what Spark
    broadcasts. Only key columns of the target travel for the inserts.
    """
    news = latest(batch, keys, order_by)
    shared = [c for c in target.columns if c in news.columns and c not in keys]
    overwrite = [c for c in (update_cols or shared) if c not in insert_only and c != id_column]
    changes = changes or {}
    moved = news.select(*keys, *[F.col(c).alias(f"new_{c}") for c in shared], F.lit(True).alias("hit"))

    def updated(c: str) -> Column:
        old, new, hit = F.col(c), F.col(f"new_{c}"), F.col("hit")
        if c in keys or c not in shared:
            return old
        if c in changes:
            return F.when(hit, changes[c](old, new)).otherwise(old).alias(c)
        return F.when(hit, new.cast(target.schema[c].dataType)).otherwise(old).alias(c) if c in overwrite else old

    kept = target.join(moved, list(keys), "left").select(*[updated(c) for c in target.columns])

    def inserted(c: str) -> Column:
        kind = target.schema[c].dataType
        if c == id_column:
            return stable_id(keys).cast(kind).alias(c)
        if c in changes:
            return changes[c](F.lit(None).cast(kind), F.col(c)).cast(kind).alias(c)
        return (F.col(c) if c in news.columns else F.lit(None)).cast(kind).alias(c)

    fresh = news.join(target.select(*keys), list(keys), "left_anti").select(*[inserted(c) for c in target.columns])
    return kept.unionByName(fresh)


LISTING_KEYS = ("platform", "platform_id")


def upsert_listings(target: DataFrame, batch: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Whole-row upsert on (platform, platform_id), keeping the id of known listings."""
    return upsert(target, batch, LISTING_KEYS, order_by, id_column="id" if "id" in target.columns else None)


PARTIAL_COLUMNS = (
    "name", "address", "cuisine_tags", "rating", "review_count", "price_bucket", "delivery_fee",
    "estimated_delivery_min", "market", "raw_url",
)


def upsert_partial(target: DataFrame, batch: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Overwrites the named columns only; promotion flag and scrape time are set on insert alone.

    The point moves only when the batch brings both coordinates and neither is 0.
    """
    cols = [c for c in PARTIAL_COLUMNS if c in batch.columns and c in target.columns]
    guarded = batch
    if {"lat", "lng"} <= set(batch.columns):
        usable = (F.col("lat") != 0) & (F.col("lng") != 0)
        guarded = batch.withColumns({"lat": F.when(usable, F.col("lat")), "lng": F.when(usable, F.col("lng"))})
    keep_old = lambda old, new: F.coalesce(new, old)
    return upsert(
        target, guarded, LISTING_KEYS, order_by,
        id_column="id" if "id" in target.columns else None,
        update_cols=cols, insert_only=("is_promoted", "scraped_at"),
        changes={c: keep_old for c in ("lat", "lng") if c in guarded.columns},
    )


def menu_rows(listings: DataFrame, parent: str = "id") -> DataFrame:
    """Nested menu items as child rows."""
    return listings.select(F.col(parent).alias("platform_merchant_id"), F.explode("menu_items").alias("item")).select(
        "platform_merchant_id", "item.*"
    )


def append_children(children: DataFrame, batch: DataFrame) -> DataFrame:
    """Adds the batch's items; running twice adds them twice."""
    return children.unionByName(menu_rows(batch), allowMissingColumns=True)


def replace_children(children: DataFrame, batch: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Swaps the items of those parents whose batch rows carry any; a parent's last such row wins."""
    news = latest(batch.where(F.size("menu_items") > 0), ["id"], order_by)
    touched = news.select(F.col("id").alias("platform_merchant_id"))
    return children.join(touched, "platform_merchant_id", "left_anti").unionByName(menu_rows(news), allowMissingColumns=True)


def concat_listings(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts with the part's place in front: (part, id) tells rows apart, however large the ids are."""
    own = [p.select(F.lit(i).alias("part"), *p.columns) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, own)


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], tolerance: str | None = None) -> DataFrame:
    """``left`` with the ``values`` (null where there are none) of the last ``right`` row of its keys at or before its time ``at``.

    ``found_at`` says when that row was; with a ``tolerance`` (an interval) it must not be longer ago. Rows of
    ``right`` with the same keys and time: the greatest values count. Rows with a null key or time find nothing.

    Both sides go through one order of (keys, time), cut into ranges, so a key with any share of all
    rows is spread. Within a range the last row is carried on; from range to range only the last row of each key.
    """
    rest = [c for c in left.columns if c not in (*keys, at)]
    queries = left.select(*keys, at, F.lit(1).alias("_side"), F.struct(*rest, F.lit(0).alias("_none")).alias("_row"), F.lit(None).alias("_found"))
    held = F.struct(F.col(at).alias("found_at"), *values)
    facts = right.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, at)])).select(
        *keys, at, F.lit(0).alias("_side"), F.lit(None).cast(queries.schema["_row"].dataType).alias("_row"), held.alias("_found")
    )
    queries = queries.withColumn("_found", F.lit(None).cast(facts.schema["_found"].dataType))
    # A tie breaker: rows equal in keys, time and side need not share a range.
    both = queries.unionByName(facts).withColumn("_tie", F.coalesce(F.xxhash64("_row"), F.lit(0)))
    order = [*keys, at, "_side", "_found", "_tie"]
    ranged = cut_lineage(both.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    so_far = Window.partitionBy("_range", *keys).orderBy(at, "_side", "_found").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumn("_found", F.last("_found", ignorenulls=True).over(so_far))
    ends = ranged.where("_side = 0").groupBy(*keys, "_range").agg(F.max("_found").alias("_end"))
    ranges = ranged.select(*keys, "_range").distinct().join(ends, [*keys, "_range"], "left")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).select(*keys, "_range", "_carried")
    joined = filled.where("_side = 1").join(carried, [*keys, "_range"], "left").withColumn("_found", F.coalesce("_found", "_carried"))
    if tolerance is not None:
        joined = joined.withColumn("_found", F.when(F.col("_found.found_at") >= F.col(at) - F.expr(f"INTERVAL {tolerance}"), F.col("_found")))
    order_of_columns = [c if c in (*keys, at) else F.col("_row")[c].alias(c) for c in left.columns]
    return joined.select(*order_of_columns, F.col("_found.found_at").alias("found_at"), *[F.col(f"_found.{v}").alias(v) for v in values])


def delta_as_of(counts: DataFrame, lag_days: int = 7) -> DataFrame:
    """Change against the last count that is at least ``lag_days`` old; ``days`` says how old it is."""
    then = counts.select("snapshot_date", "platform", "count", F.date_sub("snapshot_date", lag_days).alias("then"))
    past = counts.select(F.col("snapshot_date").alias("then"), "platform", F.col("count").alias("count_before"))
    found = as_of(then, past, ["platform"], "then", ["count_before"])
    return found.select(
        "snapshot_date", "platform", "count", "count_before", F.date_diff("snapshot_date", "found_at").alias("days"), (F.col("count") - F.col("count_before")).alias("delta")
    )


def within(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """Each point with each span of its keys that has it, ``start`` and ``end`` included; both are timestamps.

    A span belongs to the level whose buckets, four times as long from level to level, are just as long as it is, and so lies in
    two buckets at most; a point looks into one bucket of each level there is. A long span costs no more rows than a
    short one. A span without an end is open: it has all points from its start on. Columns of both sides are kept; they
    must have different names, keys apart.
    """
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1_000_000
    last = points.agg(F.max(at).alias("_last"))
    closed = spans.crossJoin(F.broadcast(last)).withColumn("_end", F.coalesce(end, F.greatest("_last", start))).drop("_last").where(F.col("_end") >= F.col(start))
    length = F.greatest(seconds(F.col("_end")) - seconds(F.col(start)), F.lit(1.0))
    level = F.ceil(F.log(length) / math.log(4)).cast("int")
    closed = closed.withColumn("_level", level).withColumn("_width", F.pow(F.lit(4.0), F.col("_level")))
    bucket = lambda c: F.floor(seconds(F.col(c)) / F.col("_width"))
    placed = closed.withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket("_end"))))
    # A few dozen at most: a level is a power of four seconds.
    levels = F.broadcast(closed.select("_level", "_width").distinct())
    looking = points.crossJoin(levels).withColumn("_bucket", bucket(at)).drop("_width")
    met = looking.join(placed.drop("_width"), [*keys, "_level", "_bucket"]).where(F.col(at).between(F.col(start), F.col("_end")))
    return met.drop("_level", "_bucket", "_end")


def counts_within(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, span_id: str) -> DataFrame:
    """(``span_id``, found): how many points of its keys each span has, ``start`` and ``end`` included; no pair is formed.

    A span has the points up to its end without those before its start, and a span without an end all points from its
    start on. Points, reduced to one row per time, and both ends of the spans go through one order of (keys, time), cut into
    ranges as in :func:`as_of`; points are counted on within a range, and from range to range only the sums of each key.
    Spans equal in id are added up. Those with a null key or start, or that end before they start, have none.
    """
    known = lambda c: reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*keys, c)])
    held = points.where(known(at)).groupBy(*keys, F.col(at).cast("timestamp").alias("_at")).agg(F.count("*").alias("_n"))
    # Sides of one time: starts, then points, then ends. Ends that are open come after all times.
    none = F.lit(None).cast(spans.schema[span_id].dataType).alias("_id")
    held = held.select(*keys, F.lit(False).alias("_open"), "_at", F.lit(1).alias("_side"), none, F.lit(0).alias("_sign"), "_n")
    edge = lambda time, open_, side, sign: F.struct(
        open_.alias("_open"), time.cast("timestamp").alias("_at"), F.lit(side).alias("_side"), F.lit(sign).alias("_sign"), F.lit(0).cast("bigint").alias("_n")
    )
    both_ends = F.array(edge(F.col(start), F.lit(False), 0, -1), edge(F.col(end), F.col(end).isNull(), 2, 1))
    whole = spans.where(known(start) & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
    asked = whole.select(*keys, F.col(span_id).alias("_id"), F.inline(both_ends)).select(*held.columns)
    order = [*keys, "_open", "_at", "_side", "_id"]
    ranged = cut_lineage(held.unionByName(asked).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    so_far = Window.partitionBy("_range", *keys).orderBy("_open", "_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_sum"))
    carried = sums.select(*keys, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    counted = ranged.withColumn("_so_far", F.sum("_n").over(so_far)).where("_side <> 1").join(carried, [*keys, "_range"])
    found = counted.groupBy(F.col("_id").alias(span_id)).agg(F.sum(F.col("_sign") * (F.col("_so_far") + F.col("_carried"))).alias("found"))
    ids = spans.select(span_id).distinct()
    return ids.join(found, ids[span_id].eqNullSafe(found[span_id]), "left").select(ids[span_id], F.coalesce("found", F.lit(0)).cast("bigint").alias("found"))


def audit_by_time(listings: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, merchants_found), one row per run: listings of a run's platform and market seen while it ran; listings count for every run that saw them."""
    seen = listings.select("platform", "market", F.col("scraped_at").alias("_seen"))
    spans = runs.select("platform", "market", "id", "started_at", "finished_at")
    return counts_within(seen, spans, ["platform", "market"], "_seen", "started_at", "finished_at", "id").withColumnRenamed("found", "merchants_found")


#: Registers of a sketch: 2^12. The estimate's relative standard error is about 1.04 / 2^6 = 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_sketches(listings: DataFrame) -> DataFrame:
    """(snapshot_date, platform, sketch): distinct listings of a day, in a few kilobytes that can be merged."""
    day = F.to_date("scraped_at").alias("snapshot_date")
    return listings.where("scraped_at IS NOT NULL AND platform_id IS NOT NULL").groupBy(day, "platform").agg(F.hll_sketch_agg("platform_id", SKETCH_BITS).alias("sketch"))


def merged_counts(sketches: DataFrame, *by) -> DataFrame:
    """Distinct listings per ``by``, estimated from the days' sketches: no listing is read again."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def snapshot_counts(pm: DataFrame, as_of: str) -> DataFrame:
    """Distinct listings per platform under the given day."""
    return pm.groupBy("platform").agg(F.count_distinct("platform_id").alias("count")).select(
        F.lit(as_of).cast("date").alias("snapshot_date"), "platform", "count"
    )


def upsert_snapshot(history: DataFrame, pm: DataFrame, as_of: str) -> DataFrame:
    """History with the day's counts put in; a second run on the day replaces the first."""
    return upsert(history, snapshot_counts(pm, as_of), ("snapshot_date", "platform"), ("count",))


def wow_delta(counts: DataFrame, lag_days: int = 7) -> DataFrame:
    """Change against the count exactly ``lag_days`` earlier; missing days give null."""
    before = counts.select(
        F.date_add("snapshot_date", lag_days).alias("snapshot_date"), "platform", F.col("count").alias("count_before")
    )
    return counts.join(before, ["snapshot_date", "platform"], "left").withColumn("delta", F.col("count") - F.col("count_before"))


def merge_matches(matches: DataFrame, batch: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One match per listing, the last one given."""
    return upsert(matches, batch, ("platform_merchant_id",), order_by)


def reset_resolution(
    pm: DataFrame, merchants: DataFrame, matches: DataFrame, market: str
) -> tuple[DataFrame, DataFrame]:
    """Matches without those of the market, and entities that still have a match."""
    gone = pm.where(F.col("market") == market)
    left = matches.join(gone, matches["platform_merchant_id"] == gone["id"], "left_anti")
    return merchants.join(left, merchants["id"] == left["merchant_id"], "left_semi"), left


def orphans(merchants: DataFrame, matches: DataFrame) -> DataFrame:
    """Entities no match refers to."""
    return merchants.join(matches, merchants["id"] == matches["merchant_id"], "left_anti")


def enrich_details(listings: DataFrame, details: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Fills listings without an address from their last detail page, with non-empty values only."""
    stub = F.coalesce(F.col("address"), F.lit("")) == ""
    d = latest(details, LISTING_KEYS, order_by).select(
        "platform", "platform_id", F.col("address").alias("d_address"), F.col("lat").alias("d_lat"), F.col("lng").alias("d_lng")
    )
    fill = lambda c, empty: F.when(stub & F.col(f"d_{c}").isNotNull() & (F.col(f"d_{c}") != empty), F.col(f"d_{c}")).otherwise(
        F.col(c)
    )
    filled = {"lat": fill("lat", 0), "lng": fill("lng", 0), "address": fill("address", "")}
    return listings.join(d, ["platform", "platform_id"], "left").withColumns(filled).select(*listings.columns)


def crawl_audit(listings: DataFrame, runs: DataFrame) -> DataFrame:
    """Finished audit rows: listings with the run's ``run_id``, or the first 500 characters of the error."""
    found = listings.groupBy("run_id").agg(F.count("*").alias("merchants_found"))
    failed = F.col("error_detail").isNotNull()
    return runs.join(found, runs["id"] == found["run_id"], "left").select(
        "id", "platform", "market", "started_at", "finished_at",
        F.when(failed, "failed").when(F.col("finished_at").isNull(), "running").otherwise("success").alias("status"),
        F.when(failed, 0).otherwise(F.coalesce("merchants_found", F.lit(0))).alias("merchants_found"),
        F.when(failed, 1).otherwise(0).alias("errors"),
        F.substring("error_detail", 1, 500).alias("error_detail"),
    )
