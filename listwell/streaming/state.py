"""Streams that keep state: events that wait for their page, current listings, counters by event time.

Three queries follow one another, each with a checkpoint of its own, joined by tables:

* :func:`start_waiting_ingest` joins events and page arrivals as streams. An event waits for its
  page for a bounded time; listings go to ``changes``, what stays without a page to ``rejects``.
* :func:`start_current` folds the changes into one state per listing: the row with the newest
  event time, and the child rows of the newest row that has any. The current table is read
  from the state itself (:func:`current_rows`, :func:`current_children`); no history is gone through.
* :func:`start_window_counters` counts what arrives per window of event time, a listing of a page
  once however often it is announced or a batch is run again. Rows that come after the watermark are counted apart.

Only keys and times wait in the join's state; page bodies are fetched when a pair is found. That state
lies on the executors' disks (:data:`ON_DISK`), so that what waits may be any number of events and pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from listwell.operators.tables import LISTING_KEYS, stable_id
from listwell.plans.quality import listing_counters
from listwell.schemas import MENU_ITEM
from listwell.streaming.ingest import LISTING_EXTRACTORS, ORDER, decode, in_days, listings_from, missing_pages

# ---- Events and pages joined as streams ------------------------------------------------------


#: State in RocksDB, with a bounded part of it in an executor's memory. By default Spark keeps all state on the heap.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # a look-up for each row written
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """:data:`ON_DISK` for queries that start within, which take a copy of the settings; a session that names a provider keeps its own.

    A query that goes on from a checkpoint keeps the provider that it began with.
    """
    chosen = {} if spark.conf.get(next(iter(ON_DISK)), None) else ON_DISK
    before = {k: spark.conf.get(k, None) for k in chosen}
    try:
        for k, v in chosen.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def wait_for_pages(events: DataFrame, arrivals: DataFrame, wait: str, before: str = "1 hour", slack: str = "10 minutes") -> DataFrame:
    """Decoded events of use with ``arrived`` true, or false once their page is overdue.

    ``events`` is a stream of (value, arrived_at), ``arrivals`` one of (page_key, stored_at); both times say when
    a row came and are never null, so neither stream has late rows beyond ``slack``. A page counts from ``before``
    ahead of its event until ``wait`` after it. Both sides' state goes when its time is over. Rows without a value or a
    key are heartbeats, which move the time on, as events of no use do; neither of them waits. The filter asks for the
    time too: else Spark would filter before it looks at the time, and a stream of useless rows would seem to stand still.
    """
    read = decode(events.withWatermark("arrived_at", slack).select("value", "arrived_at"), "arrived_at")
    useful = F.col("reason").isNull() & F.col("value").isNotNull() & F.col("platform").isin(*LISTING_EXTRACTORS)
    told = read.where(F.when(useful, F.col("arrived_at")).isNotNull()).select("value", "arrived_at", "platform", "market", "merchant_id", "minio_key", "scraped_at")
    came = arrivals.withWatermark("stored_at", slack).select(F.coalesce("page_key", F.lit("")).alias("came_key"), "stored_at", F.lit(True).alias("arrived"))
    on_time = F.expr(f"minio_key = came_key AND stored_at >= arrived_at - INTERVAL {before} AND stored_at <= arrived_at + INTERVAL {wait}")
    return told.join(came, on_time, "left_outer").select(*told.columns, F.coalesce("arrived", F.lit(False)).alias("arrived"))


def unusable(events: DataFrame) -> DataFrame:
    """(value, reason) of events that no page can help."""
    read = decode(events.where("value IS NOT NULL").select("value"))
    reason = F.coalesce("reason", F.when(~F.col("platform").isin(*LISTING_EXTRACTORS), "no extractor"))
    return read.select("value", reason.alias("reason")).where("reason IS NOT NULL")


def ingest_waited(batch: DataFrame, batch_id: int, pages: DataFrame, base: str) -> None:
    """One micro-batch of :func:`wait_for_pages`: listings, and rejects whose page is not there to this day.

    An overdue event is looked up in the page table once more before it is given up: its page may be older
    than the join remembers.
    """
    spark, part = batch.sparkSession, f"batch_id={batch_id}"
    # Written and read back: what reads a persisted batch of a join of streams more than once runs that join, and all its state, again.
    found = batch.where("value IS NOT NULL").dropDuplicates(["value"])
    found.write.mode("overwrite").parquet(f"{base}/decided/{part}")
    batch = spark.read.schema(found.schema).parquet(f"{base}/decided/{part}")
    pages = in_days(pages, batch)
    listings_from(batch, pages).write.mode("overwrite").parquet(f"{base}/changes/{part}")
    lost = missing_pages(batch, pages).select("value", F.lit("page missing").alias("reason"))
    lost.write.mode("overwrite").parquet(f"{base}/rejects/{part}")


def start_waiting_ingest(
    events: DataFrame, arrivals: DataFrame, pages: Callable[[], DataFrame], base: str, checkpoint: str, wait: str = "30 minutes",
    before: str = "1 hour", slack: str = "10 minutes", available_now: bool = False,
) -> list[StreamingQuery]:
    """Two queries: events that wait for pages, and events that are of no use. ``pages`` opens the page table anew each time."""
    waiting = wait_for_pages(events, arrivals, wait, before, slack).writeStream.outputMode("append")
    waiting = waiting.option("checkpointLocation", f"{checkpoint}/waiting").foreachBatch(lambda batch, i: ingest_waited(batch, i, pages(), base))
    useless = unusable(events).writeStream.option("checkpointLocation", f"{checkpoint}/unusable").foreachBatch(
        lambda batch, i: batch.write.mode("overwrite").parquet(f"{base}/unusable/batch_id={i}")
    )
    with state_on_disk(events.sparkSession):
        return [(w.trigger(availableNow=True) if available_now else w).start() for w in (waiting, useless)]


def waited_rejects(spark: SparkSession, base: str) -> DataFrame:
    """(value, reason) of all events that gave no listings."""
    return spark.read.parquet(f"{base}/rejects").unionByName(spark.read.parquet(f"{base}/unusable")).select("value", "reason")


# ---- Current listings as state ----------------------------------------------------------------


def changes_stream(spark: SparkSession, base: str, schema, **options: str) -> DataFrame:
    """Listing rows as the ingest writes them. A batch that is run again replaces its files; those that went are passed over."""
    return spark.readStream.schema(schema).options(ignoreMissingFiles="true", **options).parquet(f"{base}/changes")


def _with_items(changes: DataFrame) -> DataFrame:
    kind = f"array<{MENU_ITEM.simpleString()}>"
    return changes if "menu_items" in changes.columns else changes.withColumn("menu_items", F.array().cast(kind))


STATE = ("current", "current_order", "items", "items_order")


def running_state(changes: DataFrame) -> DataFrame:
    """One row per listing: the newest row, and the items of the newest row that has items.

    Newest is by event time, then page and place on it, not by arrival; so the order in which
    batches come, and how often, makes no difference. Sums up in the partition before it shuffles.
    """
    rows = _with_items(changes)
    rest = [c for c in rows.columns if c not in (*LISTING_KEYS, "menu_items", "batch_id")]
    order = F.struct(*ORDER)
    has_items = F.size("menu_items") > 0
    return rows.groupBy(*LISTING_KEYS).agg(
        F.max_by(F.struct(*rest), order).alias("current"), F.max_by(F.when(has_items, F.col("menu_items")), F.when(has_items, order)).alias("items")
    )


def start_current(changes: DataFrame, base: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keeps :func:`running_state` in ``checkpoint``; each batch's changed listings go to ``updates``."""
    writer = running_state(changes).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, i: batch.write.mode("overwrite").parquet(f"{base}/updates/batch_id={i}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _state(spark: SparkSession, checkpoint: str) -> DataFrame:
    stored = spark.read.format("statestore").load(checkpoint)
    # Both aggregates name their parts alike; the cast names them by position.
    parts = stored.schema["value"].dataType.fields
    named = T.StructType([T.StructField(name, part.dataType) for name, part in zip(STATE, parts, strict=True)])
    return stored.select("key.*", F.col("value").cast(named).alias("value")).select(*LISTING_KEYS, "value.*")


def current_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The current listings, one row each, with their hashed id; straight from the stream's state."""
    return _state(spark, checkpoint).select(stable_id(LISTING_KEYS).alias("id"), *LISTING_KEYS, "current.*")


def current_children(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Child rows of the current listings: a listing's newest items replace all earlier ones, none replace nothing."""
    rows = _state(spark, checkpoint).select(stable_id(LISTING_KEYS).alias("platform_merchant_id"), F.explode("items").alias("item"))
    return rows.select("platform_merchant_id", "item.*")


# ---- Counters by event time ---------------------------------------------------------------------

COUNTERS = ("listings", "missing_address", "missing_cuisine", "missing_coords", "invalid_price")


class LateRows(StreamingQueryListener):
    """Writes how many rows a query's watermark turned away, one row for a batch that has any.

    Spark reports a moment after the batch. A batch that runs again is written again and counts once.
    """

    listening: set = set()

    def __init__(self, spark: SparkSession, query_name: str, path: str):
        self.spark, self.query_name, self.path = spark, query_name, path

    @classmethod
    def listen(cls, spark: SparkSession, query_name: str, path: str) -> None:
        if (query_name, path) not in cls.listening:
            cls.listening.add((query_name, path))
            spark.streams.addListener(cls(spark, query_name, path))

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if progress.name == self.query_name and late:
            rows = self.spark.createDataFrame([(int(progress.batchId), int(late))], "batch_id bigint, late bigint")
            rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def start_window_counters(
    changes: DataFrame, base: str, checkpoint: str, name: str, lateness: str = "1 hour", window: str = "1 hour", available_now: bool = False
) -> StreamingQuery:
    """Counts listings per window of event time, platform and market into ``windows``, what comes too late into ``late``.

    A row is known by its listing, page and event time; it counts once for as long as the watermark
    remembers it, and after that it is late. Every batch writes its own folder, overwritten when it runs again.
    """
    spark = changes.sparkSession
    start = F.window("scraped_at", window)["start"].alias("window_start")
    rows = changes.withWatermark("scraped_at", lateness)
    once = rows.dropDuplicatesWithinWatermark([*LISTING_KEYS, "raw_key", "scraped_at"])
    LateRows.listen(spark, name, f"{base}/late")
    writer = once.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, i: listing_counters(batch, start).write.mode("overwrite").parquet(f"{base}/windows/batch_id={i}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def window_counters(spark: SparkSession, base: str) -> DataFrame:
    """The four counters and the number of listings per window, platform and market."""
    sums = [F.sum(c).alias(c) for c in COUNTERS]
    return spark.read.parquet(f"{base}/windows").groupBy("window_start", "platform", "market").agg(*sums)


def late_rows(spark: SparkSession, base: str) -> int:
    try:
        told = spark.read.schema("batch_id bigint, late bigint").parquet(f"{base}/late")
        found = told.groupBy("batch_id").agg(F.max("late").alias("late")).agg(F.sum("late")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0  # nothing was late yet
    return found or 0
