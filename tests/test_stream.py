import json

import pytest
from pyspark.sql import functions as F

from listwell.operators import extract as ex
from listwell.sources.pages import with_key_parts
from listwell.streaming import ingest


@pytest.fixture()
def raw(table):
    return with_key_parts(table("raw_pages")).where(F.length("merchant_id") <= 10)


def rows(df):
    cols = ["platform", "platform_id", "name", "address", "market", "rating", "raw_key"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch_and_replays_change_nothing(spark, raw, tmp_path):
    base = str(tmp_path)
    events = ingest.event_rows(raw, F.lit(100) + F.length("merchant_id"))
    ingest.publish(events.repartition(3), path=f"{base}/events")
    for _ in range(2):  # the second run finds nothing new
        source = ingest.events_source(spark, f"{base}/events", maxFilesPerTrigger="1")
        ingest.start_ingest(source, lambda: raw, f"{base}/out", f"{base}/progress", available_now=True).awaitTermination()
    wanted = rows(ingest.listings_of(events, raw))
    assert rows(ingest.current_listings(spark, f"{base}/out")) == wanted and len(wanted) > 50
    # The first batch run again after a crash overwrites its own folder.
    again = spark.read.text(f"{base}/events").limit(5)
    ingest.ingest_batch(again, 0, raw, f"{base}/replay")
    ingest.ingest_batch(again, 0, raw, f"{base}/replay")
    assert spark.read.parquet(f"{base}/replay/changes").count() == ingest.listings_of(again, raw).count()


def test_latest_event_wins_whatever_arrives_last(spark, tmp_path):
    page = lambda name: f'<article><h2>{name}</h2><a href="/store/1/">x</a></article>'
    pages = spark.createDataFrame([("doordash/2024-01-01/m/new.html", page("New")), ("doordash/2024-01-01/m/old.html", page("Old"))], "page_key string, html string")
    event = lambda key, at: json.dumps({"platform": "doordash", "market": "m", "minio_key": f"doordash/2024-01-01/m/{key}.html", "scraped_at": at})
    for batch_id, text in enumerate([event("new", 200.5), event("old", 100.0)]):
        ingest.ingest_batch(spark.createDataFrame([(text,)], "value string"), batch_id, pages, str(tmp_path))
    (row,) = ingest.current_listings(spark, str(tmp_path)).collect()
    assert row.name == "New"


def test_rejects_have_reasons(spark):
    pages = spark.createDataFrame([("doordash/d/m/1.html", "")], "page_key string, html string")
    texts = ["{oops", "[1]", '{"platform":"doordash","market":"m"}', '{"platform":"doordash","market":"m","minio_key":"doordash/d/m/1.html"}',
             '{"platform":"doordash","market":"m","minio_key":"gone"}', '{"platform":"zzz","market":"m","minio_key":"doordash/d/m/1.html"}']
    got = sorted((r.value, r.reason) for r in ingest.rejected_events(spark.createDataFrame([(t,) for t in texts], "value string"), pages).collect())
    assert got == sorted([(texts[0], "undecodable"), (texts[1], "undecodable"), (texts[2], "incomplete"), (texts[4], "page missing"), (texts[5], "no extractor")])


def page_rows(spark, *ids):
    body = '<article><h2>Name</h2><a href="/store/{}/">x</a></article>'
    return spark.createDataFrame([(f"doordash/2024-01-01/m/{i}.html", body.format(i)) for i in ids], "page_key string, html string")


def event_texts(*ids):
    return [json.dumps({"platform": "doordash", "market": "m", "minio_key": f"doordash/2024-01-01/m/{i}.html", "scraped_at": 5.0}) for i in ids]


def test_pages_that_come_after_the_start_are_found(spark, tmp_path):
    base = str(tmp_path)
    page_rows(spark, 1).write.parquet(f"{base}/pages")
    ingest.publish(spark.createDataFrame([(t,) for t in event_texts(1)], "value string"), path=f"{base}/events")
    source = ingest.events_source(spark, f"{base}/events")
    running = ingest.start_ingest(source, lambda: spark.read.parquet(f"{base}/pages"), f"{base}/out", f"{base}/progress")
    try:
        running.processAllAvailable()
        page_rows(spark, 2).write.mode("append").parquet(f"{base}/pages")
        ingest.publish(spark.createDataFrame([(t,) for t in event_texts(2, 2)], "value string"), path=f"{base}/events")
        running.processAllAvailable()
    finally:
        running.stop()
    assert sorted(r.platform_id for r in ingest.current_listings(spark, f"{base}/out").collect()) == ["1", "2"]
    assert ingest.rejects(spark, f"{base}/out").count() == 0


def test_missing_pages_are_tried_again(spark, tmp_path):
    base, events = str(tmp_path), spark.createDataFrame([(t,) for t in [*event_texts(1, 2, 3), "{oops"]], "value string")
    ingest.ingest_batch(events, 0, page_rows(spark, 1), base)
    assert ingest.rejects(spark, base).count() == 3
    for _ in range(2):  # an attempt made again changes nothing
        ingest.retry_missing(spark, page_rows(spark, 1, 2), base, 1)
        assert sorted(r.reason for r in ingest.rejects(spark, base).collect()) == ["page missing", "undecodable"]
    ingest.retry_missing(spark, page_rows(spark, 1, 2, 3), base, 2)
    assert [r.reason for r in ingest.rejects(spark, base).collect()] == ["undecodable"]
    assert sorted(r.platform_id for r in ingest.current_listings(spark, base).collect()) == ["1", "2", "3"]


def test_compaction_keeps_the_current_rows(spark, raw, tmp_path):
    events = ingest.event_rows(raw.limit(20), F.lit(1))
    ingest.ingest_batch(events, 0, raw, str(tmp_path / "out"))
    ingest.compact(spark, str(tmp_path / "out"), str(tmp_path / "table"))
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == rows(ingest.current_listings(spark, str(tmp_path / "out")))
    assert set(ex.LISTING_EXTRACTORS) >= {r.platform for r in spark.read.parquet(str(tmp_path / "table")).collect()}


def _joins(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rejects_send_no_table_through_the_driver(spark, raw):
    events = ingest.event_rows(raw, F.lit(100)).union(spark.createDataFrame([('{"platform":"doordash","market":"m","minio_key":"doordash/2024-01-01/m/k.html"}',)], "value string"))
    lost = ingest.rejected_events(events, raw)
    assert "Broadcast" not in _joins(lost)
    assert [r.reason for r in lost.collect()] == ["page missing"]


def test_many_events_meet_bodies_without_the_driver(spark, raw, monkeypatch):
    events = ingest.event_rows(raw, F.lit(100) + F.length("merchant_id"))
    few = ingest.listings_of(events, raw)
    assert "BroadcastHashJoin" in _joins(few)
    monkeypatch.setattr(ingest, "FEW_EVENTS", 10)
    many = ingest.listings_of(events, raw)
    assert "Broadcast" not in _joins(many)
    assert rows(many) == rows(few) and rows(few)
