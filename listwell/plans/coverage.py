"""Coverage, gap and overlap reports over listings, entities and matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions.similarity import quality_score, week_bucket

OWN_PLATFORM = "ubereats"  # fixed value


def mean_rounded(c: Column, digits: int) -> Column:
    return F.round(F.avg(c.cast("double")), digits)


def coverage_by_platform_market(pm: DataFrame) -> DataFrame:
    return (
        pm.groupBy("platform", "market")
        .agg(
            F.count_distinct("platform_id").alias("merchant_count"),
            mean_rounded(F.col("rating"), 2).alias("avg_rating"),
            mean_rounded(F.col("review_count"), 0).alias("avg_reviews"),
            F.count_distinct(F.when(F.col("rating") >= 4.5, F.col("platform_id"))).alias("high_rated_count"),
        )
        .orderBy("market", "platform")
    )


def listings_with_entity(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    """Every listing, with the entity it belongs to where there is one.

    Matches meet entities first, so unmatched listings never shuffle on a null entity id.
    """
    m = merchants.select(
        F.col("id").alias("merchant_id"), F.col("is_on_our_platform").alias("entity_is_ours"), F.lit(True).alias("has_entity")
    )
    owner = matches.select(F.col("platform_merchant_id").alias("id"), "merchant_id").join(m, "merchant_id", "left")
    return pm.join(owner, "id", "left")


def entity_listings(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    """Only matched listings, with entity columns."""
    m = merchants.select(F.col("id").alias("entity_id"), "canonical_name", "canonical_addr")
    mm = matches.select(F.col("merchant_id").alias("entity_id"), F.col("platform_merchant_id").alias("id"))
    return m.join(mm, "entity_id").join(pm, "id")


def gaps(pm: DataFrame, merchants: DataFrame, matches: DataFrame, competitors_only: bool = False) -> DataFrame:
    """Listings without an entity, or with one that is not on the own platform.

    A listing has one match at most, so this is all listings but those whose entity is
    not known to be off the own platform.
    """
    base = pm.where(F.col("platform") != OWN_PLATFORM) if competitors_only else pm
    taken = merchants.where(F.coalesce("is_on_our_platform", F.lit(True)))
    covered = matches.join(taken, matches["merchant_id"] == taken["id"], "left_semi")
    return base.join(covered, base["id"] == covered["platform_merchant_id"], "left_anti")


_GAP_COLUMNS = ["platform", "market", "name", "address", "rating", "review_count", "cuisine_tags", "price_bucket"]


def coverage_gaps(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    return (
        gaps(pm, merchants, matches)
        .orderBy(F.desc_nulls_last("rating"), F.desc_nulls_last("review_count"), "id")  # the id parts equal ratings among tasks
        .select(*_GAP_COLUMNS)
    )


def cross_platform_overlap(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    """Entities listed on at least two platforms."""
    return (
        entity_listings(pm, merchants, matches)
        .groupBy("entity_id", "canonical_name", "canonical_addr")
        .agg(
            F.sort_array(F.collect_set("platform")).alias("platforms"),
            mean_rounded(F.col("rating"), 2).alias("avg_rating"),
            F.sum("review_count").alias("total_reviews"),
        )
        .withColumn("platform_count", F.size("platforms").cast("bigint"))
        .where(F.col("platform_count") >= 2)
        .orderBy(F.desc_nulls_last("total_reviews"), "entity_id")
    )


def price_comparison(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    """Prices of entities with at least two listings."""
    several = matches.groupBy("merchant_id").count().where("count >= 2")
    wanted = merchants.join(several, merchants["id"] == several["merchant_id"], "left_semi")
    return (
        entity_listings(pm, wanted, matches)
        .orderBy("canonical_name", "platform", "id")
        .select("canonical_name", "platform", "market", "price_bucket", "delivery_fee", "estimated_delivery_min", "rating")
    )


def cuisine_distribution(pm: DataFrame) -> DataFrame:
    return (
        pm.select("platform", F.explode("cuisine_tags").alias("cuisine"))
        .groupBy("platform", "cuisine")
        .agg(F.count("*").alias("merchant_count"))
        .orderBy("platform", F.desc("merchant_count"), "cuisine")
    )


def crawl_health(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("platform", "market", week_bucket(F.col("started_at")).alias("week"))
        .agg(
            F.count("*").alias("crawl_count"),
            F.count_if(F.col("status") == "success").alias("successes"),
            F.count_if(F.col("status") == "failed").alias("failures"),
            mean_rounded(F.col("merchants_found"), 0).alias("avg_merchants_per_crawl"),
        )
        .orderBy(F.desc("week"), "platform", "market")
    )


def acquisition_targets(pm: DataFrame, merchants: DataFrame, matches: DataFrame, limit: int = 500) -> DataFrame:
    """Best-scored gaps; the listing id decides among equal scores."""
    return (
        gaps(pm, merchants, matches)
        .withColumn("quality_score", quality_score(F.col("rating"), F.col("review_count")))
        .orderBy(F.desc("quality_score"), "id")
        .limit(limit)
        .select("id", *_GAP_COLUMNS, "quality_score")
    )


def acquisition_targets_ln(pm: DataFrame, merchants: DataFrame, matches: DataFrame, limit: int = 100) -> DataFrame:
    """Competitor gaps scored with the natural logarithm to one decimal place."""
    score = quality_score(F.col("rating"), F.col("review_count"), natural=True).cast("decimal(10,1)")
    return (
        gaps(pm, merchants, matches, competitors_only=True)
        .withColumn("quality_score", score)
        .orderBy(F.desc("quality_score"), "id")
        .limit(limit)
        .select("id", "name", "platform", "market", "rating", "review_count", "quality_score")
    )


def gap_count_by_platform(pm: DataFrame, merchants: DataFrame, matches: DataFrame) -> DataFrame:
    return (
        gaps(pm, merchants, matches, competitors_only=True)
        .groupBy("platform")
        .agg(F.count("*").alias("gap_count"))
        .orderBy(F.desc("gap_count"), "platform")
    )


def total_merchants(pm: DataFrame, approx: bool = False) -> DataFrame:
    counted = F.approx_count_distinct("platform_id") if approx else F.count_distinct("platform_id")
    return pm.groupBy("platform").agg(counted.alias("total_merchants")).orderBy(F.desc("total_merchants"), "platform")


def coverage_report(pm: DataFrame) -> DataFrame:
    return pm.groupBy("market", "platform").agg(F.count("*").alias("cnt")).orderBy("market", "platform")


def coverage_report_nested(pm: DataFrame) -> DataFrame:
    """One row per market with a platform → count map (few entries: one per platform)."""
    entries = F.sort_array(F.collect_list(F.struct("platform", "cnt")))
    return coverage_report(pm).groupBy("market").agg(F.map_from_entries(entries).alias("platforms")).orderBy("market")


def multi_listing_entities(matches: DataFrame, at_least: int = 2) -> DataFrame:
    return matches.groupBy("merchant_id").agg(F.count("*").alias("listings")).where(F.col("listings") >= at_least)


def first_listings(listings: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` listings in page order, which the crawler enriches."""
    return listings.orderBy("page_key", "pos").limit(n)


def sample_one(df: DataFrame, seed: int = 0) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(1)


def coverage_margins(pm: DataFrame) -> DataFrame:
    """Listings and distinct listings per platform and market, per platform, per market and in all, from one scan.

    ``margin`` has 2 for a sum over platforms and 1 for one over markets; null values of the columns are groups of
    their own. Rows are reduced to distinct listings before they are counted for each margin.
    """
    once = pm.groupBy("platform", "market", "platform_id").agg(F.count("*").alias("n"))
    return once.cube("platform", "market").agg(
        F.grouping_id("platform", "market").cast("int").alias("margin"), F.sum("n").alias("listings"), F.count_distinct("platform_id").alias("distinct_listings")
    )
