"""Data-quality metrics: one pass over the table each, however many counts they report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions.similarity import geo_valid
from listwell.functions.text import null_or_blank, null_or_empty, null_or_empty_array

# Fixed values: (red below, green from) for scores, (green below, red from) for counts.
SCORE_BANDS = {"completeness": (75, 95), "freshness": (80, 95)}
COUNT_BANDS = {"missing_address": (50, 200), "anomalies": (10, 50)}

POSTAL = "[0-9]{4}\\s*[A-Z]{0,2}\\b"
AFTER_POSTAL = "[0-9]{4}\\s*[A-Z]{0,2}\\s*,?\\s*(.+)$"


def stale(scraped_at: Column, as_of: Column, days: int = 7) -> Column:
    """Older than ``days`` before ``as_of``; an unknown time is not stale."""
    return F.coalesce(scraped_at < as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))


def _as_of(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def _share(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.greatest(F.lit(0.0), part / F.nullif(total, F.lit(0)) * 100), digits)


def dq_metrics(pm: DataFrame, as_of: str | Column, pg_compat: bool = False) -> DataFrame:
    """Counts and scores over the whole table in one aggregate; all zero when it is empty."""
    counts = pm.agg(
        F.count("*").alias("total_merchants"),
        F.count_if(null_or_empty(F.col("address"))).alias("missing_address_count"),
        F.count_if(null_or_empty_array(F.col("cuisine_tags"), pg_compat)).alias("missing_cuisine_count"),
        F.count_if(stale(F.col("scraped_at"), _as_of(as_of))).alias("stale_merchant_count"),
        F.count_if(~geo_valid(F.col("lat"), F.col("lng"))).alias("invalid_coords_count"),
    )
    total = F.col("total_merchants")
    # A row that lacks both address and cuisine is subtracted twice.
    complete = total - F.col("missing_address_count") - F.col("missing_cuisine_count")
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "completeness_score": F.coalesce(_share(complete, total), zero),
            "freshness_score": F.coalesce(_share(total - F.col("stale_merchant_count"), total), zero),
            "geo_accuracy_score": F.coalesce(_share(total - F.col("invalid_coords_count"), total), zero),
        }
    ).withColumn("overall_health", F.round(F.col("completeness_score") * 0.4 + F.col("freshness_score") * 0.6, 2))


def dq_completeness(pm: DataFrame) -> DataFrame:
    """Share of listings with an address; null for an empty table."""
    c = pm.agg(F.count("*").alias("total"), F.count_if(null_or_blank(F.col("address"))).alias("missing"))
    return c.select(_share(F.col("total") - F.col("missing"), F.col("total")).alias("completeness_score"))


def dq_freshness(pm: DataFrame, as_of: str | Column) -> DataFrame:
    c = pm.agg(F.count("*").alias("total"), F.count_if(stale(F.col("scraped_at"), _as_of(as_of))).alias("stale"))
    return c.select(_share(F.col("total") - F.col("stale"), F.col("total")).alias("freshness_score"))


def dq_missing_address_by_platform(pm: DataFrame) -> DataFrame:
    """Every platform appears, with 0 where nothing is missing."""
    return (
        pm.groupBy("platform")
        .agg(F.count_if(null_or_blank(F.col("address"))).alias("missing_address"))
        .orderBy(F.desc("missing_address"), "platform")
    )


def dq_missing_address_fields(pm: DataFrame) -> DataFrame:
    a = F.col("address")
    there = ~null_or_blank(a)
    has_postal = a.rlike(POSTAL)
    city = F.trim(F.regexp_extract(a, AFTER_POSTAL, 1))
    return (
        pm.groupBy("platform")
        .agg(
            F.count_if(null_or_blank(a)).alias("missing_address"),
            F.count_if(there & ~has_postal).alias("missing_postal"),
            F.count_if(there & has_postal & (city == "")).alias("missing_city"),
        )
        .orderBy("platform")
    )


def platform_stats(pm: DataFrame) -> DataFrame:
    """Mean and sample deviation per platform; a zero deviation is null."""
    r, n = F.col("rating").cast("double"), F.col("review_count").cast("double")
    return pm.groupBy("platform").agg(
        F.avg(r).alias("avg_rating"),
        F.nullif(F.stddev_samp(r), F.lit(0.0)).alias("std_rating"),
        F.avg(n).alias("avg_reviews"),
        F.nullif(F.stddev_samp(n), F.lit(0.0)).alias("std_reviews"),
    )


def with_z_scores(pm: DataFrame) -> DataFrame:
    """Distance from the platform mean in deviations, for rating and review count.

    The statistics have one row per registered platform and are broadcast: the listings stay
    where they are, however many of them one platform has.
    """
    z = lambda v, mean, std: F.abs(F.col(v).cast("double") - F.col(mean)) / F.col(std)
    return pm.join(F.broadcast(platform_stats(pm)), "platform").withColumns(
        {
            "z_rating": z("rating", "avg_rating", "std_rating"),
            "z_reviews": z("review_count", "avg_reviews", "std_reviews"),
        }
    )


def anomalous(pm: DataFrame, limit: float = 2.0) -> DataFrame:
    return with_z_scores(pm).where((F.col("z_rating") > limit) | (F.col("z_reviews") > limit))


def dq_anomalies(pm: DataFrame) -> DataFrame:
    return anomalous(pm).agg(F.count("*").alias("anomaly_merchants"))


def dq_anomalies_by_platform(pm: DataFrame) -> DataFrame:
    return (
        anomalous(pm).groupBy("platform").agg(F.count("*").alias("anomaly_count"))
        .orderBy(F.desc("anomaly_count"), "platform")
    )


def listing_counters(listings: DataFrame, *by: Column) -> DataFrame:
    """Per platform and market (and ``by``): listings lacking address, cuisine or coordinates (0 counts as lacking), bad prices of their items.

    A price is bad if it is unknown or negative. Listings without a column of items have none.
    """
    missing = lambda c: c.isNull() | F.isnan(c) | (c == 0)
    bad = F.lit(0)
    if "menu_items" in listings.columns:
        wrong = F.filter("menu_items", lambda i: i["price"].isNull() | (i["price"] < 0))
        bad = F.when(F.col("menu_items").isNull(), 0).otherwise(F.size(wrong))
    return listings.groupBy(*by, "platform", "market").agg(
        F.count("*").alias("listings"),
        F.count_if(null_or_empty(F.col("address"))).alias("missing_address"),
        F.count_if(null_or_empty_array(F.col("cuisine_tags"))).alias("missing_cuisine"),
        F.count_if(missing(F.col("lat")) | missing(F.col("lng"))).alias("missing_coords"),
        F.sum(bad).alias("invalid_price"),
    )


def price_counters(items: DataFrame) -> DataFrame:
    """Per platform and market: menu items whose price is unknown or negative."""
    return items.groupBy("platform", "market").agg(
        F.count_if(F.col("price").isNull() | (F.col("price") < 0)).alias("invalid_price")
    )


def dq_counters(listings: DataFrame, items: DataFrame) -> DataFrame:
    """Both counter sets side by side. Items are added up per listing before they are joined."""
    bad = items.groupBy("platform_merchant_id").agg(
        F.count_if(F.col("price").isNull() | (F.col("price") < 0)).alias("bad_prices")
    )
    per_listing = listings.join(bad, listings["id"] == bad["platform_merchant_id"], "left")
    missing = lambda c: c.isNull() | F.isnan(c) | (c == 0)
    return per_listing.groupBy("platform", "market").agg(
        F.count_if(null_or_empty(F.col("address"))).alias("missing_address"),
        F.count_if(null_or_empty_array(F.col("cuisine_tags"))).alias("missing_cuisine"),
        F.count_if(missing(F.col("lat")) | missing(F.col("lng"))).alias("missing_coords"),
        F.coalesce(F.sum("bad_prices"), F.lit(0)).alias("invalid_price"),
    )


def market_mode(pm: DataFrame) -> DataFrame:
    """Most frequent market, the smallest on a tie, ``unknown`` if there is none."""
    counts = pm.where(F.col("market").isNotNull()).groupBy("market").agg(F.count("*").alias("n"))
    top = F.min_by("market", F.struct(-F.col("n"), "market"))
    return counts.agg(F.coalesce(top, F.lit("unknown")).alias("market"))


def threshold_status(value: Column, metric: str) -> Column:
    """``green``, ``orange`` or ``red``: scores are better high, counts better low."""
    if metric in SCORE_BANDS:
        low, high = SCORE_BANDS[metric]
        return F.when(value >= high, "green").when(value >= low, "orange").otherwise("red")
    low, high = COUNT_BANDS[metric]
    return F.when(value >= high, "red").when(value >= low, "orange").otherwise("green")


def status_report(pm: DataFrame, as_of: str | Column) -> DataFrame:
    """The four watched values, each with its colour."""
    counts = pm.agg(
        F.count("*").alias("total"),
        F.count_if(null_or_blank(F.col("address"))).alias("missing"),
        F.count_if(stale(F.col("scraped_at"), _as_of(as_of))).alias("stale"),
    ).crossJoin(dq_anomalies(pm))  # one row each
    total = F.col("total")
    values = {
        "completeness": _share(total - F.col("missing"), total),
        "freshness": _share(total - F.col("stale"), total),
        "missing_address": F.col("missing").cast("double"),
        "anomalies": F.col("anomaly_merchants").cast("double"),
    }
    rows = [F.struct(F.lit(m).alias("metric"), v.alias("value"), threshold_status(v, m).alias("status")) for m, v in values.items()]
    return counts.select(F.inline(F.array(*rows)))
