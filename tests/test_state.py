import datetime as dt
import json
import random
import uuid

from pyspark.sql import functions as F

from listwell.operators.tables import LISTING_KEYS, stable_id
from listwell.streaming import ingest, state

ITEM = "struct<name:string,price:double,description:string,category:string>"
CHANGE = (
    "platform string, platform_id string, name string, address string, cuisine_tags array<string>, lat double, lng double, market string, "
    f"scraped_at timestamp, raw_key string, pos int, menu_items array<{ITEM}>"
)
START = dt.datetime(2024, 1, 1, 12)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def change(i, minutes, *, key="k", items=(), address="a", price=1.0):
    return ("p", str(i), f"name {minutes}", address, ["t"], 1.0, 1.0, "m", at(minutes), key, 0, [(n, price, "", "") for n in items])


def put(spark, base, rows):
    spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(f"{base}/changes")


def run_current(spark, base):
    stream = state.changes_stream(spark, base, CHANGE, maxFilesPerTrigger="1")
    state.start_current(stream, base, f"{base}/progress", available_now=True).awaitTermination()


def test_state_is_the_latest_row_whatever_the_order(spark, tmp_path):
    rng, base = random.Random(3), str(tmp_path)
    rows = [change(rng.randint(1, 12), rng.randint(0, 60), key=f"k{i:03d}", items=rng.choice([(), ("x",), ("y", "z")])) for i in range(90)]
    for i in range(0, 90, 30):  # the stream is stopped and started in between; some rows come again
        put(spark, base, rows[i : i + 30] + rows[max(0, i - 10) : i])
        run_current(spark, base)
    newest, children = {}, {}
    for r in sorted(rows, key=lambda r: (r[8], r[9])):
        newest[r[1]] = r[2]
        if r[11]:
            children[r[1]] = sorted(x[0] for x in r[11])
    got = state.current_rows(spark, f"{base}/progress")
    assert {r.platform_id: r.name for r in got.collect()} == newest and got.count() == len(newest)
    ids = {r.id: r.platform_id for r in got.collect()}
    items = {}
    for r in state.current_children(spark, f"{base}/progress").collect():
        items.setdefault(ids[r.platform_merchant_id], []).append(r.name)
    assert {k: sorted(v) for k, v in items.items()} == children
    assert got.where(F.col("id") != stable_id(LISTING_KEYS)).count() == 0
    # Each batch says what it changed.
    assert spark.read.parquet(f"{base}/updates").select(*LISTING_KEYS).distinct().count() == len(newest)


def test_rows_without_a_column_of_items(spark, tmp_path):
    base, schema = str(tmp_path), ", ".join(CHANGE.split(", ")[:11])
    spark.createDataFrame([change(1, 5)[:11], change(1, 3)[:11]], schema).write.parquet(f"{base}/changes")
    state.start_current(state.changes_stream(spark, base, schema), base, f"{base}/progress", available_now=True).awaitTermination()
    assert [r.name for r in state.current_rows(spark, f"{base}/progress").collect()] == ["name 5"]
    assert state.current_children(spark, f"{base}/progress").count() == 0


def run_windows(spark, base, name):
    stream = state.changes_stream(spark, base, CHANGE)
    running = state.start_window_counters(stream, base, f"{base}/counting", name, "30 minutes", "1 hour", available_now=True)
    running.awaitTermination()
    return sum(op.numRowsDroppedByWatermark for p in running.recentProgress for op in p.stateOperators)


def test_windows_count_once_and_late_rows_apart(spark, tmp_path):
    base, name = str(tmp_path), f"w{uuid.uuid4().hex}"
    first = [change(1, 5), change(2, 10, address=""), change(2, 10, address=""), change(3, 75, items=("x", "y"), price=-1.0), change(4, 100)]
    put(spark, base, first)
    assert run_windows(spark, base, name) == 0
    # Announced again within the watermark, one new on time, two new ones too late.
    put(spark, base, [change(4, 100), change(3, 75, items=("x", "y"), price=-1.0), change(5, 80, items=("x",), price=None), change(6, 20), change(7, 30)])
    assert run_windows(spark, base, name) == 2
    got = {r.window_start: tuple(r)[3:] for r in state.window_counters(spark, base).collect()}
    assert got == {at(0): (2, 1, 0, 0, 0), at(60): (3, 0, 0, 0, 3)}
    for _ in range(50):  # the listener writes a moment later
        if state.late_rows(spark, base) == 2:
            break
        import time

        time.sleep(0.2)
    assert state.late_rows(spark, base) == 2


def test_no_late_rows_yet(spark, tmp_path):
    assert state.late_rows(spark, str(tmp_path)) == 0


def key(i):
    return f"doordash/2024-01-01/m/{i}.html"


def event(i):
    return json.dumps({"platform": "doordash", "market": "m", "minio_key": key(i), "scraped_at": 5.0 + i})


def test_events_wait_for_their_pages(spark, tmp_path):
    base = str(tmp_path)
    body = '<article><h2>Name</h2><a href="/store/{}/">x</a></article>'

    def pages(*ids):
        spark.createDataFrame([(key(i), body.format(i)) for i in ids], "page_key string, html string").coalesce(1).write.mode("append").parquet(f"{base}/pages")

    def told(events, arrivals):
        for rows, name, schema in ((events, "events", "value string, arrived_at timestamp"), (arrivals, "arrivals", "page_key string, stored_at timestamp")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        streams = [spark.readStream.schema(s).parquet(f"{base}/{n}") for n, s in (("events", "value string, arrived_at timestamp"), ("arrivals", "page_key string, stored_at timestamp"))]
        for q in state.start_waiting_ingest(*streams, lambda: spark.read.parquet(f"{base}/pages"), f"{base}/out", f"{base}/progress", "30 minutes", "1 hour", "10 minutes", True):
            q.awaitTermination()

    def ingested():
        rows = spark.read.parquet(f"{base}/out/changes").collect()
        return sorted(r.platform_id for r in rows)

    # 1 has its page, 2 gets it later, 3 never, 4 has one from the day before; two are of no use.
    pages(1, 4)
    told([(event(1), at(0)), (event(2), at(0)), (event(3), at(0)), (event(4), at(0)), ("{oops", at(0)), ('{"platform":"zzz","market":"m","minio_key":"k"}', at(0))], [(key(1), at(-5)), (key(4), at(-1440))])
    assert ingested() == ["1"]
    pages(2)
    told([(event(1), at(20))], [(key(2), at(20))])  # the first event comes once more
    assert ingested() == ["1", "1", "2"]
    assert state.waited_rejects(spark, f"{base}/out").count() == 2
    told([(None, at(300))], [(None, at(300))])
    assert ingested() == ["1", "1", "2", "4"]
    assert sorted(r.reason for r in state.waited_rejects(spark, f"{base}/out").collect()) == ["no extractor", "page missing", "undecodable"]


def test_what_waits_is_on_disk_is_of_use_and_is_joined_once(spark, tmp_path):
    base, useless = str(tmp_path), ["{oops", '{"platform":"zzz","market":"m","minio_key":"k"}', '{"platform":"doordash","market":"","minio_key":"k"}']
    spark.createDataFrame([(key(i), "<html></html>") for i in range(4)], "page_key string, html string").write.parquet(f"{base}/pages")
    events = [(event(i), at(0)) for i in range(4)] + [(value, at(0)) for value in useless]
    streams = []
    for rows, name, schema in ((events, "events", "value string, arrived_at timestamp"), ([(key(0), at(1))], "arrivals", "page_key string, stored_at timestamp")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}")
        streams.append(spark.readStream.schema(schema).parquet(f"{base}/{name}"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    queries = state.start_waiting_ingest(*streams, lambda: spark.read.parquet(f"{base}/pages"), f"{base}/out", f"{base}/progress", available_now=True)
    for q in queries:
        q.awaitTermination()
    assert "RocksDBStateStoreProvider" in (tmp_path / "progress/waiting/offsets/0").read_text() and spark.conf.get(provider) == before
    assert sum(op.numRowsUpdated for p in queries[0].recentProgress[:1] for op in p.stateOperators) == 5  # four events and an arrival, once
    waiting = spark.read.format("statestore").option("joinSide", "left").option("batchId", 0).load(f"{base}/progress/waiting")
    assert sorted(r.value for r in waiting.select("value.value").collect()) == sorted(event(i) for i in range(4))


def test_days_are_pruned_one_by_one(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    days = ["2024-01-01", "2024-02-01", "2024-03-01"]
    rows = [(f"doordash/{d}/m/{i}.html", "") for i, d in enumerate(days)]
    table = ingest.with_key_parts(spark.createDataFrame(rows, "page_key string, html string"))
    table.write.partitionBy("date").parquet(f"{base}/pages")
    pages = spark.read.parquet(f"{base}/pages")
    events = spark.createDataFrame([(json.dumps({"platform": "doordash", "market": "m", "minio_key": rows[i][0]}),) for i in (0, 2)], "value string")
    kept = ingest.in_days(pages, ingest.usable_events(events))
    assert sorted(r.page_key for r in kept.collect()) == [rows[0][0], rows[2][0]]
    assert "PartitionFilters: [date" in kept._jdf.queryExecution().toString()
    monkeypatch.setattr(ingest, "MOST_DAYS", 1)
    assert ingest.in_days(pages, ingest.usable_events(events)).count() == 3
    assert ingest.in_days(pages, ingest.usable_events(events.limit(0))).count() == 0
