"""Archived pages and parsed listings: keys, scans and sinks."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwell.schemas import LISTING


NO_MARKET = "unknown"


def page_key(platform: Column, day: Column, market: Column, merchant_id: Column, ext: str = "html") -> Column:
    """``{platform}/{date}/{market}/{merchant_id}.{ext}``; a null market is written ``unknown``."""
    name = F.concat(merchant_id, F.lit(f".{ext}"))
    return F.concat_ws("/", platform, F.date_format(day, "yyyy-MM-dd"), F.coalesce(market, F.lit(NO_MARKET)), name)


def with_key_parts(df: DataFrame, key: str = "page_key") -> DataFrame:
    """Platform, date, market and merchant id read back from the key."""
    parts = F.split(F.col(key), "/")
    part = lambda i: F.get(parts, F.lit(i))
    return df.withColumns(
        {
            "platform": part(0),
            "date": part(1).try_cast("date"),
            "market": part(2),
            "merchant_id": F.regexp_replace(part(3), r"\.[^.]*$", ""),
        }
    )


def listing_pages(pages: DataFrame, platform: str | None = None, market: str | None = None, key: str = "page_key") -> DataFrame:
    """Pages whose key names a listing page, optionally of one platform or market.

    In no order: sorting would move every page body. What depends on page order takes the
    key into account itself, as :func:`operators.tables.first_seen` does.
    """
    k = F.col(key)
    wanted = k.endswith(".html") & k.contains("listing")
    if platform is not None:
        wanted = wanted & k.startswith(f"{platform}/")
    if market is not None:
        wanted = wanted & k.contains(f"/{market}/")
    return pages.where(wanted)


def read_pages(spark: SparkSession, path: str, platform: str | None = None, market: str | None = None, day: str | None = None) -> DataFrame:
    """HTML objects below ``path`` in the key layout; a platform, market or day narrows the listing."""
    glob = f"{path}/{platform or '*'}/{day or '*'}/{market or '*'}/*.html"
    # Spark gives the path as a URI, in which a plus sign stands for itself.
    key = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+/[^/]+/[^/]+)$", 1)
    raw = spark.read.text(glob, wholetext=True).select(
        F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B"))).alias("page_key"), F.col("value").alias("html")
    )
    return with_key_parts(raw)


def read_page_table(
    spark: SparkSession, path: str, platform: str | None = None, market: str | None = None, first: str | None = None, last: str | None = None
) -> DataFrame:
    """What :func:`write_pages` wrote, with keys; only the folders of the platform, market and days are read."""
    rows = spark.read.schema("merchant_id string, html string, platform string, date date, market string").parquet(path)
    for column, value in (("platform", platform), ("market", market)):
        rows = rows if value is None else rows.where(F.col(column) == value)
    rows = rows if first is None else rows.where(F.col("date") >= F.lit(first).cast("date"))
    rows = rows if last is None else rows.where(F.col("date") <= F.lit(last).cast("date"))
    key = page_key(F.col("platform"), F.col("date"), F.col("market"), F.col("merchant_id"))
    return rows.select(key.alias("page_key"), "html", "platform", "date", "market", "merchant_id")


def write_pages(df: DataFrame, path: str, as_of: str) -> None:
    """Page bodies as parquet, one folder per platform, date and market."""
    dated = df.withColumn("date", F.lit(as_of).cast("date"))
    dated.write.mode("append").partitionBy("platform", "date", "market").parquet(path)


def as_json(df: DataFrame) -> Column:
    """The whole row as JSON text; null fields are kept, other types become strings."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def parsed_rows(listings: DataFrame, as_of: str) -> DataFrame:
    """Archive key and JSON body per listing."""
    key = page_key(F.col("platform"), F.lit(as_of).cast("date"), F.col("market"), F.col("platform_id"), "json")
    return listings.select(key.alias("json_key"), as_json(listings).alias("body"))


def write_parsed(listings: DataFrame, path: str, as_of: str) -> None:
    """One JSON line per listing, in folders by platform, date and market."""
    day = F.lit(as_of).cast("date")
    (
        listings.select("platform", day.alias("date"), "market", as_json(listings).alias("value"))
        .write.mode("append").partitionBy("platform", "date", "market").text(path)
    )


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """Archived listings; platform and market come from the body, the date from the folder."""
    body = F.from_json("value", LISTING)
    return spark.read.text(path).select(body.alias("b"), "date").select("b.*", "date")


def read_listing_files(
    spark: SparkSession, paths: list[str], legacy: str | None = None, multiline: bool = True
) -> DataFrame:
    """Rows of all listing files that exist; the legacy file counts only when none does.

    A file holds one JSON array; without ``multiline`` it holds one array per line, which
    Spark can split.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    there = lambda p: fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs.Path(p))
    found = [p for p in paths if there(p)] or [p for p in [legacy] if p and there(p)]
    if not found:
        raise FileNotFoundError(f"no listing file among {[os.path.basename(p) for p in paths]}")
    return spark.read.schema(LISTING_FILE).json(found, multiLine=multiline)


LISTING_FILE = "platform string, platform_merchant_id string, " + ", ".join(
    f.simpleString().replace(":", " ", 1) for f in LISTING.fields if f.name not in ("platform", "platform_id")
)


def coverage_report_json(nested: DataFrame) -> DataFrame:
    """The nested report as one JSON object per market; listings without one count under ``unknown``."""
    return nested.select(F.to_json(F.create_map(F.coalesce("market", F.lit(NO_MARKET)), "platforms")).alias("value"))


def write_coverage_report(nested: DataFrame, path: str) -> None:
    coverage_report_json(nested).write.mode("overwrite").text(path)
