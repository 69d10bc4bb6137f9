import datetime as dt

import pytest
from pyspark.sql import functions as F

from listwell.sources import archive

PAGES = [
    (f"{p}/2024-01-0{d}/{m}/listing_{i} é.html", f"<p>{p} {d} {m} {i} é</p>")
    for p in ("doordash", "ubereats") for d in (1, 2, 3) for m in ("rome", "new york") for i in range(4)
]


@pytest.fixture()
def path(spark, tmp_path):
    archive.register(spark)
    write(spark, PAGES, tmp_path)
    (tmp_path / "doordash" / "2024-01-01" / "rome" / "note.txt").write_text("no page")
    (tmp_path / "doordash" / "not a day" / "rome").mkdir(parents=True)
    return str(tmp_path)


def write(spark, pages, path):
    df = spark.createDataFrame(pages, "page_key string, html string").selectExpr("*", *[f"CAST(NULL AS {k}) AS {c}" for c, k in (("platform", "string"), ("date", "date"), ("market", "string"), ("merchant_id", "string"))])
    df.repartition(3).write.format("page_archive").mode("append").save(str(path))


def test_what_was_written_is_read(spark, path):
    rows = spark.read.format("page_archive").load(path)
    assert sorted((r.page_key, r.html) for r in rows.collect()) == sorted(PAGES)
    assert rows.rdd.getNumPartitions() == 12
    one = rows.where("merchant_id = 'listing_2 é' AND market = 'new york' AND platform = 'ubereats'").orderBy("date").collect()
    assert [(r.date, r.page_key) for r in one] == [(dt.date(2024, 1, d), f"ubereats/2024-01-0{d}/new york/listing_2 é.html") for d in (1, 2, 3)]


@pytest.mark.parametrize("where, folders, count", [
    ("platform = 'doordash'", 6, 24), ("date >= DATE '2024-01-02' AND market IN ('rome', 'oslo')", 4, 16), ("date = DATE '2024-01-03' AND platform = 'ubereats' AND market = 'rome'", 1, 4),
    ("date < DATE '2024-01-02' OR merchant_id LIKE '%1%'", 12, 24), ("platform = 'nobody'", 1, 0),
])
def test_filters_choose_the_folders(spark, path, where, folders, count):
    rows = spark.read.format("page_archive").load(path).where(where)
    assert rows.count() == count and rows.rdd.getNumPartitions() == folders


def test_a_stream_gives_files_once(spark, path, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))

    def run():
        stream = spark.readStream.format("page_archive").option("lag", "0").load(path).select("page_key", F.length("html").alias("n"))
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
        return sorted(r.page_key for r in spark.read.schema("page_key string, n int").parquet(f"{out}/rows").collect())

    assert run() == sorted(k for k, _ in PAGES)
    more = [("grubhub/2024-02-01/rome/listing_9.html", "new")]
    write(spark, more, path)
    assert run() == sorted(k for k, _ in PAGES + more)
    assert run() == sorted(k for k, _ in PAGES + more)


def test_an_archive_that_is_not_there_yet(spark, path):
    assert spark.read.format("page_archive").load(f"{path}/nothing").count() == 0
    with pytest.raises(Exception, match="only added to"):
        spark.createDataFrame(PAGES[:1], "page_key string, html string").write.format("page_archive").mode("overwrite").save(path)
