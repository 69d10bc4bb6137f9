"""Event streams, run to their end over files that Spark writes from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwell.plans import bind
from listwell.plans.catalog.common import oracle, portable, registrar
from listwell.plans.catalog.pages import ALL_LISTINGS
from listwell.session import ensure_checkpoint_dir
from listwell.sources.pages import with_key_parts
from listwell.streaming import ingest, state

ENTRIES, query = registrar()

SECONDS = 1704067200  # 2024-01-01, in epoch seconds


def scratch(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_key_parts(bind.table(spark, sf_dir, "raw_pages"))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event per page, and for each row of the event table one that cannot be used."""
    good = ingest.event_rows(raw_pages(spark, sf_dir), F.lit(SECONDS) + F.length("merchant_id"))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    broken = ev.select(
        F.expr(f"""CASE event_id % 4 WHEN 0 THEN CONCAT('not json ', event_id)
          WHEN 1 THEN CONCAT('{{"platform":"ubereats","market":"","minio_key":"k', event_id, '"}}')
          WHEN 2 THEN CONCAT('{{"platform":"elsewhere","market":"m","minio_key":"k', event_id, '"}}')
          ELSE CONCAT('{{"platform":"doordash","market":"m","minio_key":"doordash/2024-01-01/m/k', event_id, '.html"}}') END""").alias("value")
    )
    return good.unionByName(broken)


def run_stream(spark: SparkSession, sf_dir: str) -> str:
    """Publishes all events to files, ingests them to the end, returns the folder of the results."""
    base = scratch(spark, "ingest")
    ingest.publish(all_events(spark, sf_dir), path=f"{base}/events")
    source = ingest.events_source(spark, f"{base}/events", maxFilesPerTrigger="4")
    ingest.start_ingest(source, lambda: raw_pages(spark, sf_dir), f"{base}/out", f"{base}/progress", available_now=True).awaitTermination()
    return f"{base}/out"


def _events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a file stream into a table."""
    base = scratch(spark, "source")
    ingest.publish(ingest.event_rows(raw_pages(spark, sf_dir), F.lit(SECONDS)), path=f"{base}/events")
    stream = ingest.usable_events(ingest.events_source(spark, f"{base}/events"))
    running = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start(f"{base}/out")
    )
    running.awaitTermination()
    return portable(spark.read.parquet(f"{base}/out"))


KEYED = "split_part(page_key, '/', 1) AS platform, split_part(page_key, '/', 3) AS market, regexp_replace(split_part(page_key, '/', 4), '\\.[^.]*$', '') AS merchant_id, page_key AS minio_key"

ENTRIES["stream_events_source"] = (
    _events_source,
    oracle(f"SELECT {KEYED}, '2024-01-01 00:00:00' AS scraped_at FROM raw_pages", "raw_pages"),
)


@query("stream_publish", ("raw_pages",), f"SELECT {KEYED}, CAST({SECONDS} AS DOUBLE) AS scraped_at FROM raw_pages")
def _(pages):
    sent = ingest.event_rows(pages, F.lit(SECONDS))
    return sent.select(F.from_json("value", "platform string, market string, merchant_id string, minio_key string, scraped_at double").alias("e")).select("e.*")


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.current_listings(spark, run_stream(spark, sf_dir))
    return portable(rows.select("platform", "platform_id", "name", "address", "market", "rating", "review_count", "raw_key", "scraped_at"))


ENTRIES["stream_ingest"] = (
    _ingest,
    oracle(
        f"""{ALL_LISTINGS}
SELECT platform, platform_id, name, regexp_replace(regexp_replace(address, '\\bSt\\b', 'Street', 'g'), '\\bPl\\b', 'Place', 'g') AS address, market, rating, review_count, page_key AS raw_key,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * len(regexp_replace(split_part(page_key, '/', 4), '\\.[^.]*$', '')), '%Y-%m-%d %H:%M:%S') AS scraped_at FROM listings""",
        "raw_pages",
    ),
)


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.total_counters(spark, run_stream(spark, sf_dir))


ENTRIES["stream_dq_counters"] = (
    _counters,
    oracle(
        f"""{ALL_LISTINGS}
SELECT platform, market, CAST(SUM(CASE WHEN address = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_address,
  CAST(SUM(CASE WHEN tags = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_cuisine,
  CAST(SUM(CASE WHEN lat IS NULL OR lat = 0 OR lng = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_coords,
  CAST(0 AS BIGINT) AS invalid_price FROM listings GROUP BY 1, 2""",  # pages of these platforms list no items
        "raw_pages",
    ),
)

_BROKEN = """CASE event_id % 4 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'incomplete' WHEN 2 THEN 'no extractor' ELSE 'page missing' END"""


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = ingest.rejects(spark, run_stream(spark, sf_dir)).groupBy("reason")
    return counted.agg(F.count("*").alias("events"))


ENTRIES["reject_routing"] = (
    _rejects,
    f"SELECT {_BROKEN} AS reason, COUNT(*) AS events FROM events GROUP BY 1",
)


def _required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.usable_events(all_events(spark, sf_dir)).select("platform", "market", "minio_key")


ENTRIES["required_fields"] = (
    _required,
    oracle(
        """SELECT split_part(page_key, '/', 1) AS platform, split_part(page_key, '/', 3) AS market, page_key AS minio_key FROM raw_pages
UNION ALL SELECT CASE event_id % 4 WHEN 2 THEN 'elsewhere' ELSE 'doordash' END, 'm',
  CASE event_id % 4 WHEN 2 THEN 'k' || event_id ELSE 'doordash/2024-01-01/m/k' || event_id || '.html' END
FROM events WHERE event_id % 4 >= 2""",
        "raw_pages",
    ),
)


# ---- Streams that keep state ------------------------------------------------------------------


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows as an ingest would write them: each event is a new version of its user's listing, every third with items."""
    batch = bind.table(spark, sf_dir, "listing_batch")
    items = F.when(F.col("seq") % 3 == 0, F.array(
        F.struct(F.lit("soup").alias("name"), F.col("delivery_fee").cast("double").alias("price"), F.lit("").alias("description"), F.lit("a").alias("category")),
        F.struct(F.lit("salad").alias("name"), F.when(F.col("seq") % 2 == 0, -1.0).alias("price"), F.lit("").alias("description"), F.lit("b").alias("category")),
    )).otherwise(F.array())
    return batch.select(
        "platform", "platform_id", "name", F.when(F.col("seq") % 5 > 0, F.lit("Street 1")).alias("address"),
        F.when(F.col("seq") % 7 > 0, F.array(F.lit("tea"))).otherwise(F.array()).alias("cuisine_tags"), F.when(F.col("seq") % 4 > 0, 52.0).alias("lat"),
        F.when(F.col("seq") % 4 > 0, 4.0).alias("lng"), F.col("delivery_fee").cast("double").alias("delivery_fee"), items.alias("menu_items"),
        F.concat(F.lit("m"), F.col("seq") % 3).alias("market"), F.col("scraped_at").cast("timestamp").alias("scraped_at"),
        F.concat(F.lit("e"), F.lpad(F.col("seq").cast("string"), 12, "0")).alias("raw_key"), F.lit(0).alias("pos"), "seq",
    )


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions in two runs of the stream, the later half of the events first and some of them twice."""
    base, rows = scratch(spark, "current"), changes(spark, sf_dir)
    halves = (rows.where("seq % 2 = 1"), rows.where("seq % 2 = 0 OR seq % 10 = 1"))
    for half in halves:
        half.drop("seq").write.mode("append").parquet(f"{base}/changes")
        state.start_current(state.changes_stream(spark, base, rows.drop("seq").schema), base, f"{base}/progress", available_now=True).awaitTermination()
    sold = state.current_children(spark, f"{base}/progress").groupBy(F.col("platform_merchant_id").alias("id")).agg(F.count("*").alias("items"), F.sum("price").alias("prices"))
    now = state.current_rows(spark, f"{base}/progress").join(sold, "id", "left")
    return portable(now.select("platform", "platform_id", "name", "delivery_fee", "scraped_at", "raw_key", F.coalesce("items", F.lit(0)).alias("items"), F.round("prices", 4).alias("prices")))


ENTRIES["stream_current"] = (
    _current,
    oracle(
        """SELECT platform, platform_id, arg_max(name, k) AS name, CAST(arg_max(delivery_fee, k) AS DOUBLE) AS delivery_fee,
  strftime(max(scraped_at), '%Y-%m-%d %H:%M:%S') AS scraped_at, arg_max(raw_key, k) AS raw_key,
  COALESCE(MAX(CASE WHEN seq % 3 = 0 THEN 2 END), 0) AS items,
  ROUND(arg_max(CAST(delivery_fee AS DOUBLE) + CASE WHEN seq % 2 = 0 THEN -1.0 ELSE 0.0 END, k) FILTER (WHERE seq % 3 = 0), 4) AS prices
FROM (SELECT *, 'e' || lpad(CAST(seq AS VARCHAR), 12, '0') AS raw_key, strftime(scraped_at, '%Y-%m-%d %H:%M:%S.%f') || 'e' || lpad(CAST(seq AS VARCHAR), 12, '0') AS k FROM listing_batch)
GROUP BY platform, platform_id""",
        "listing_batch",
    ),
)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per day of event time after everything came twice and the stream was stopped in between."""
    base, rows = scratch(spark, "windows"), changes(spark, sf_dir).drop("seq")
    for i in range(2):
        rows.write.mode("append").parquet(f"{base}/changes")
        stream = state.changes_stream(spark, base, rows.schema)
        state.start_window_counters(stream, base, f"{base}/progress", f"windows-{uuid.uuid4().hex}", "400 days", "1 day", available_now=True).awaitTermination()
    return portable(state.window_counters(spark, base))


ENTRIES["stream_window_counters"] = (
    _windows,
    oracle(
        """SELECT strftime(date_trunc('day', scraped_at), '%Y-%m-%d %H:%M:%S') AS window_start, platform, 'm' || (seq % 3) AS market, COUNT(*) AS listings,
  COUNT(*) FILTER (WHERE seq % 5 = 0) AS missing_address, COUNT(*) FILTER (WHERE seq % 7 = 0) AS missing_cuisine, COUNT(*) FILTER (WHERE seq % 4 = 0) AS missing_coords,
  CAST(SUM(CASE WHEN seq % 3 = 0 THEN 1 + CASE WHEN delivery_fee IS NULL OR delivery_fee < 0 THEN 1 ELSE 0 END ELSE 0 END) AS BIGINT) AS invalid_price
FROM listing_batch GROUP BY 1, 2, 3""",
        "listing_batch",
    ),
)


def _waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose pages come before them, up to 25 minutes after them, too late, or never; by outcome and platform."""
    base, pages = scratch(spark, "waiting"), raw_pages(spark, sf_dir).withColumn("n", F.xxhash64("page_key") % 1000)
    came = F.timestamp_seconds(F.lit(SECONDS) + F.abs("n") * 60)
    lag = F.when(F.col("n") % 3 == 0, F.expr("INTERVAL -5 MINUTES")).when(F.col("n") % 3 == 1, F.expr("INTERVAL 25 MINUTES")).otherwise(F.expr("INTERVAL 10 SECONDS"))
    keyed = ingest.event_rows(pages.withColumn("at", came), F.lit(SECONDS) + F.length("merchant_id"))
    told = keyed.select("value", F.from_json("value", "minio_key string").getField("minio_key").alias("page_key")).join(pages.select("page_key", came.alias("arrived_at")).hint("merge"), "page_key")
    useless = all_events(spark, sf_dir).where("value NOT LIKE '%/listing_%'").select("value", F.timestamp_seconds(F.lit(SECONDS)).alias("arrived_at"))
    end = F.timestamp_seconds(F.lit(SECONDS + 864_000))
    events = told.select("value", "arrived_at").unionByName(useless)
    arrivals = pages.select("page_key", (came + lag).alias("stored_at"))
    # The end of time is told last, so that what waits is decided.
    for step, (e, a) in enumerate(((events, arrivals), (spark.range(1).select(F.lit(None).cast("string").alias("value"), end.alias("arrived_at")), spark.range(1).select(F.lit(None).cast("string").alias("page_key"), end.alias("stored_at"))))):
        e.write.mode("append").parquet(f"{base}/events")
        a.write.mode("append").parquet(f"{base}/arrivals")
        streams = [spark.readStream.schema(x.schema).parquet(f"{base}/{name}") for x, name in ((e, "events"), (a, "arrivals"))]
        for running in state.start_waiting_ingest(*streams, lambda: raw_pages(spark, sf_dir), f"{base}/out", f"{base}/progress", available_now=True):
            running.awaitTermination()
    seen = spark.read.parquet(f"{base}/out/changes").select(F.col("platform").alias("outcome"), F.col("raw_key").alias("value"))
    lost = state.waited_rejects(spark, f"{base}/out").select(F.col("reason").alias("outcome"), "value")
    return seen.unionByName(lost).groupBy("outcome").agg(F.count("*").alias("rows"), F.count_distinct("value").alias("events"))


ENTRIES["stream_waiting_ingest"] = (
    _waiting,
    oracle(
        f"""{ALL_LISTINGS}
SELECT platform AS outcome, COUNT(*) AS rows, COUNT(DISTINCT page_key) AS events FROM listings GROUP BY 1
UNION ALL SELECT {_BROKEN}, COUNT(*), COUNT(*) FROM events GROUP BY 1""",
        "raw_pages",
    ),
)
