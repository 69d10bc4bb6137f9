"""Market and platform dimensions, and the crawl targets they span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# URL patterns per platform, the one configured market, special cases.
LISTING_URLS = {
    "doordash": "https://www.doordash.com/food-delivery/{slug}-restaurants/",
    "grubhub": "https://www.grubhub.com/delivery/{slug}",
    "ubereats": "https://www.ubereats.com/city/{slug}",
    "justeattakeaway": "https://www.thuisbezorgd.nl/en/delivery/food/{slug}",
}
MARKETS = [("Amsterdam", "amsterdam", 52.3676, 4.9041)]
AMSTERDAM_URLS = {
    "ubereats": (
        "https://www.ubereats.com/nl-en/city/amsterdam-noord-holland"
        "?pl=JTdCJTIyYWRkcmVzcyUyMiUzQSUyMkFtc3RlcmRhbSUyMiUyQyUyMnJlZmVyZ"
        "W5jZSUyMiUzQSUyMkNoSUpWWGVhbExVX3hrY1JqYV9BdDB6OUFHWSUyMiUyQyUyMn"
        "JlZmVyZW5jZVR5cGUlMjIlM0ElMjJnb29nbGVfcGxhY2VzJTIyJTJDJTIybGF0aXR"
        "1ZGUlMjIlM0E1Mi4zNjc1NzM0JTJDJTIybG9uZ2l0dWRlJTIyJTNBNC45MDQxMzg4"
        "OTk5OTk5OTk1JTdE"
        "&page=1"
    ),
    "justeattakeaway": "https://www.thuisbezorgd.nl/en/delivery/food/amsterdam-1072",
}
UBEREATS_SLUGS = {"nyc": "new-york-city"}


def markets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MARKETS, "name string, market string, lat double, lng double")


def platforms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LISTING_URLS.items()), "platform string, listing_url_pattern string")


def _slug(platform: Column, market: Column) -> Column:
    """Underscores become dashes, except on the one platform with its own slug table."""
    special = F.when(F.lit(False), market)
    for name, slug in UBEREATS_SLUGS.items():
        special = special.when(market == name, slug)
    return F.when(platform == "ubereats", special.otherwise(market)).otherwise(F.replace(market, F.lit("_"), F.lit("-")))


def crawl_targets(market_rows: DataFrame) -> DataFrame:
    """One URL per platform and market. The platform side is the fixed table above."""
    spark = market_rows.sparkSession
    pairs = market_rows.select("market").distinct().crossJoin(F.broadcast(platforms(spark)))
    filled = F.replace(F.col("listing_url_pattern"), F.lit("{slug}"), _slug(F.col("platform"), F.col("market")))
    url = F.when(F.lit(False), filled)
    for name, fixed in AMSTERDAM_URLS.items():
        url = url.when((F.col("platform") == name) & (F.col("market") == "amsterdam"), fixed)
    return pairs.select("platform", "market", url.otherwise(filled).alias("url"))
