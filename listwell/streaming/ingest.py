"""From page events to listings, as a stream that gives what the batch jobs give.

Every micro-batch writes its own folder, named by its id and overwritten as a whole, so
a batch that runs again after a failure leaves no trace of the first try. The listing table
is the latest row per key over all folders; by event time, not by arrival.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listwell.functions.normalize import normalize_listings
from listwell.operators.extract import LISTING_EXTRACTORS, extract_listings
from listwell.operators.tables import LISTING_KEYS, latest
from listwell.plans.quality import listing_counters
from listwell.sources.pages import as_json, with_key_parts

# Topic and delivery settings.
TOPIC = "raw-html-scraped"
SINK_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "lz4"}

EVENT = "platform string, market string, merchant_id string, minio_key string, scraped_at string, broken string"


def events_source(spark: SparkSession, path: str | None = None, **options: str) -> DataFrame:
    """Stream of event texts: a Kafka topic from its beginning, or JSON lines in a folder."""
    if path is not None:
        return spark.readStream.options(**options).text(path)
    reader = spark.readStream.format("kafka").option("subscribe", TOPIC).option("startingOffsets", "earliest")
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def decode(events: DataFrame, *others: str) -> DataFrame:
    """Event fields next to the text (and ``others``), with a reason where the event cannot be used."""
    parsed = F.from_json("value", EVENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    incomplete = reduce(lambda a, b: a | b, [blank(c) for c in ("platform", "market", "minio_key")])
    reason = F.when(F.col("broken").isNotNull() | F.col("e").isNull(), "undecodable").when(incomplete, "incomplete")
    return events.select("value", *others, parsed.alias("e")).select("value", *others, "e", "e.*").select(
        "value", *others, "platform", "market", "merchant_id", "minio_key",
        F.timestamp_millis((F.col("scraped_at").try_cast("double") * 1000).cast("bigint")).alias("scraped_at"), reason.alias("reason"),
    )


def usable_events(events: DataFrame) -> DataFrame:
    return decode(events).where("reason IS NULL").drop("reason", "value")


def _keyed(events: DataFrame) -> DataFrame:
    """Events under the columns a page table is stored by; the event's own platform and market kept aside."""
    return with_key_parts(
        events.withColumnsRenamed({"minio_key": "page_key", "platform": "event_platform", "market": "event_market"}).drop("merchant_id")
    )


def _on(pages: DataFrame) -> list[str]:
    return [c for c in ("platform", "date", "market", "page_key") if c in pages.columns]


#: Days of a micro-batch that are named to the scan; with more, the join prunes by itself.
MOST_DAYS = 1000


def in_days(pages: DataFrame, usable: DataFrame) -> DataFrame:
    """Only the day folders of the page table that the events of a micro-batch point into.

    The days, so many as there are folders at most, come to the driver and are pruned before the scan.
    Beyond MOST_DAYS that is left to the join on the folder columns.
    """
    if "date" not in pages.columns:
        return pages
    days = [r.date for r in _keyed(usable).select("date").distinct().limit(MOST_DAYS + 1).collect()]
    return pages if len(days) > MOST_DAYS else pages.where(F.col("date").isin([d for d in days if d is not None]))


#: So many events are sent to where the bodies are; with more, both sides are dealt by key.
FEW_EVENTS = 10_000


def fetch_pages(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Events with the body of their page.

    The join names the key's folder columns too, so that on a page table stored by
    platform, date and market Spark can prune to the folders the events point to.

    A few events are broadcast, so the bodies stay where they are. More go to tasks by key: by their
    compressed size alone Spark would send any number of them through the driver, batch by batch.
    """
    on = _on(pages)
    few = events.limit(FEW_EVENTS + 1).count() <= FEW_EVENTS
    return _keyed(events).hint("broadcast" if few else "merge").join(pages.select(*on, "html"), on).select(
        "page_key", F.col("event_platform").alias("platform"), F.col("event_market").alias("market"), "scraped_at", "html"
    )


def rejected_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """(value, reason) for events that cannot be decoded, are incomplete, have no page or no extractor."""
    read = decode(events)
    has_extractor = F.col("platform").isin(*LISTING_EXTRACTORS)
    reason = F.coalesce("reason", F.when(~has_extractor, "no extractor"))
    labelled = read.withColumn("reason", reason)
    lost = missing_pages(labelled.where("reason IS NULL"), pages)
    return labelled.where("reason IS NOT NULL").select("value", "reason").unionByName(lost.select("value", F.lit("page missing").alias("reason")))


def missing_pages(usable: DataFrame, pages: DataFrame) -> DataFrame:
    """Events whose page is not in the table. Either side may be long: neither goes through the driver."""
    on = _on(pages)
    there = pages.select(*on, F.lit(True).alias("there"))
    return _keyed(usable).join(there.hint("merge"), on, "left").where("there IS NULL")


def listings_of(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Normalised listings of all usable events: the batch form of the stream."""
    return listings_from(usable_events(events), pages)


def listings_from(usable: DataFrame, pages: DataFrame) -> DataFrame:
    """Normalised listings of decoded events.

    Events are reduced before they meet the page table, which has one body for a key, so a
    body is fetched once however often its page is announced.
    """
    times = usable.groupBy(F.col("minio_key").alias("page_key")).agg(F.max("scraped_at").alias("scraped_at"))
    once = usable.groupBy("platform", "market", "minio_key").agg(F.max("scraped_at").alias("scraped_at"))
    rows = normalize_listings(extract_listings(fetch_pages(once, pages).drop("scraped_at")))
    return rows.join(times.hint("merge"), "page_key").withColumnRenamed("page_key", "raw_key")


ORDER = ("scraped_at", "raw_key", "pos")


def ingest_batch(batch: DataFrame, batch_id: int, pages: DataFrame, base: str) -> None:
    """One micro-batch: listings, archive, counters and rejects, each to the batch's own folder."""
    spark, part = batch.sparkSession, f"batch_id={batch_id}"
    batch = batch.select("value").persist()  # texts of events, read from their source once
    try:
        pages = in_days(pages, usable_events(batch))
        listings_of(batch, pages).write.mode("overwrite").parquet(f"{base}/changes/{part}")
        # What was written is read back, so pages are parsed once.
        done = spark.read.parquet(f"{base}/changes/{part}")
        listing_counters(done).write.mode("overwrite").parquet(f"{base}/counters/{part}")
        done.select(as_json(done).alias("value")).write.mode("overwrite").text(f"{base}/parsed/{part}")
        rejected_events(batch, pages).write.mode("overwrite").parquet(f"{base}/rejects/{part}")
    finally:
        batch.unpersist()


def start_ingest(events: DataFrame, pages: Callable[[], DataFrame], base: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Runs :func:`ingest_batch` on every micro-batch; progress is kept in ``checkpoint``.

    ``pages`` opens the page table. It is called for every micro-batch, as an open table
    does not see files that come later.
    """
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: ingest_batch(batch, batch_id, pages(), base)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def retry_missing(spark: SparkSession, pages: DataFrame, base: str, attempt: int) -> None:
    """Ingests the rejected events whose page has come since, as a batch of id ``-attempt``.

    ``attempt`` counts from 1; the same one again overwrites its folders. What is still
    missing waits for the next attempt.
    """
    lost = rejects(spark, base, before=attempt).where("reason = 'page missing'").select("value")
    ingest_batch(lost, -attempt, pages, base)
    left = spark.read.parquet(f"{base}/rejects/batch_id={-attempt}").select("value")
    lost.join(left, "value", "left_anti").distinct().write.mode("overwrite").parquet(f"{base}/recovered/attempt={attempt}")


def current_listings(spark: SparkSession, base: str) -> DataFrame:
    """Latest row per listing over all batches."""
    return latest(spark.read.parquet(f"{base}/changes"), LISTING_KEYS, (*ORDER[:1], "batch_id", *ORDER[1:]))


def compact(spark: SparkSession, base: str, into: str) -> None:
    """The current listings as one table, for readers that need no history."""
    current_listings(spark, base).write.mode("overwrite").partitionBy("platform", "market").parquet(into)


def total_counters(spark: SparkSession, base: str) -> DataFrame:
    """Counters over all batches."""
    counted = spark.read.parquet(f"{base}/counters")
    sums = [F.sum(c).alias(c) for c in ("missing_address", "missing_cuisine", "missing_coords", "invalid_price")]
    return counted.groupBy("platform", "market").agg(*sums)


def rejects(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """Rejected events without those that an attempt (of those before ``before``) recovered."""
    found = spark.read.parquet(f"{base}/rejects").where("batch_id >= 0").drop("batch_id")
    try:
        done = spark.read.schema("value string, attempt int").parquet(f"{base}/recovered")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return found  # no attempt was made yet
    done = done if before is None else done.where(F.col("attempt") < before)
    return found.join(done, "value", "left_anti")


def event_rows(pages: DataFrame, scraped_at: Column) -> DataFrame:
    """One event per archived page, as the JSON text that goes onto the topic."""
    keyed = pages if {"platform", "market", "merchant_id"} <= set(pages.columns) else with_key_parts(pages)
    event = F.struct(
        "platform", "market", "merchant_id", F.col("page_key").alias("minio_key"), scraped_at.cast("double").alias("scraped_at")
    )
    return keyed.select(F.to_json(event).alias("value"))


def publish(rows: DataFrame, path: str | None = None, **options: str) -> None:
    """Event texts to the topic, or as JSON lines to a folder."""
    if path is not None:
        rows.select("value").write.mode("append").text(path)
    else:
        rows.select("value").write.format("kafka").option("topic", TOPIC).options(**{**SINK_OPTIONS, **options}).save()
