import random

import pytest
from pyspark.sql import functions as F

from listwell.operators import tables as tb
from listwell.plans import quality as dq
from listwell.sources import config, pages


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(
        [(1, "p", "a", "old a", 1.0, 2.0, True), (2, "p", "b", "old b", None, None, False)],
        "id bigint, platform string, platform_id string, name string, lat double, lng double, is_promoted boolean",
    )


@pytest.fixture()
def batch(spark):
    return spark.createDataFrame(
        [("p", "a", "first", 5.0, 6.0, False, 1), ("p", "a", "last", 0.0, 6.0, False, 2), ("p", "c", "new", 7.0, 8.0, True, 3)],
        "platform string, platform_id string, name string, lat double, lng double, is_promoted boolean, seq int",
    )


def test_upsert_last_row_of_a_key_wins_and_keeps_the_id(target, batch):
    out = tb.upsert_listings(target, batch)
    got = {r.platform_id: r for r in out.collect()}
    assert (got["a"].id, got["a"].name, got["a"].lat) == (1, "last", 0.0)
    assert (got["b"].id, got["b"].name) == (2, "old b")
    assert got["c"].name == "new" and got["c"].id not in (1, 2, None)


def test_upsert_twice_is_upsert_once(target, batch):
    once = tb.upsert_listings(target, batch)
    assert rows(tb.upsert_listings(once, batch), *target.columns[:4]) == rows(once, *target.columns[:4])


def test_partial_upsert_guards_point_and_promotion(target, batch):
    got = {r.platform_id: r for r in tb.upsert_partial(target, batch).collect()}
    assert (got["a"].name, got["a"].lat, got["a"].lng, got["a"].is_promoted) == ("last", 1.0, 2.0, True)
    assert (got["c"].lat, got["c"].is_promoted) == (7.0, True)


def test_one_hot_key_in_a_batch(spark, target):
    hot = spark.range(20000).select(
        F.lit("p").alias("platform"), F.lit("a").alias("platform_id"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("seq")
    )
    got = {r.platform_id: r.name for r in tb.upsert_listings(target, hot).collect()}
    assert got == {"a": "n19999", "b": "old b"}


def test_children(spark):
    children = spark.createDataFrame([(1, "old"), (2, "kept")], "platform_merchant_id bigint, name string")
    schema = "id bigint, menu_items array<struct<name: string, price: double>>, seq int"
    batch = spark.createDataFrame([(1, [("x", 1.0), ("y", None)], 2), (2, [], 1), (1, [("before", 1.0)], 1), (1, [], 3)], schema)
    assert rows(tb.replace_children(children, batch, ["seq"]), "platform_merchant_id", "name") == [(1, "x"), (1, "y"), (2, "kept")]
    assert tb.append_children(children, batch).count() == 5


def test_audit_counts_each_run_apart(spark):
    runs = spark.createDataFrame([(1, "p", "m", None), (2, "p", "m", None), (3, "p", "m", "broke")], "id int, platform string, market string, error_detail string")
    runs = runs.withColumns({"started_at": F.lit("2024-01-01").cast("timestamp"), "finished_at": F.lit("2024-01-02").cast("timestamp")})
    found = spark.createDataFrame([(1,), (1,), (3,)], "run_id int")
    assert rows(tb.crawl_audit(found, runs), "id", "status", "merchants_found") == [(1, "success", 2), (2, "success", 0), (3, "failed", 0)]


def test_concat_keeps_large_ids_apart(spark):
    keyed = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3")], "platform string, platform_id string")
    parts = [keyed.withColumn("id", tb.stable_id(tb.LISTING_KEYS)) for _ in range(3)]
    both = tb.concat_listings(parts)
    assert both.select("part", "id").distinct().count() == 9 and both.where("abs(id) > 1e12").count() > 0


def test_reset_drops_only_what_the_market_had(spark):
    pm = spark.createDataFrame([(1, "m1"), (2, "m2")], "id bigint, market string")
    matches = spark.createDataFrame([(1, 10), (2, 20)], "platform_merchant_id bigint, merchant_id bigint")
    merchants = spark.createDataFrame([(10,), (20,), (30,)], "id bigint")
    entities, left = tb.reset_resolution(pm, merchants, matches, "m1")
    assert rows(left, "platform_merchant_id") == [(2,)] and rows(entities, "id") == [(20,)]


def test_detail_fills_only_stubs_with_true_values(spark):
    schema = "platform string, platform_id string, address string, lat double, lng double"
    listings = spark.createDataFrame([("p", "a", "", None, None), ("p", "b", "here", 1.0, 1.0), ("p", "c", None, 3.0, None)], schema)
    details = spark.createDataFrame([("p", "a", "found", 5.0, 0.0), ("p", "b", "other", 9.0, 9.0), ("p", "c", "", None, 4.0)], schema)
    before = details.withColumn("address", F.lit("before"))
    crawled = details.withColumn("seq", F.lit(2)).unionByName(before.withColumn("seq", F.lit(1)))
    assert {tuple(r) for r in tb.enrich_details(listings, crawled, ["seq"]).collect()} == {
        ("p", "a", "found", 5.0, None), ("p", "b", "here", 1.0, 1.0), ("p", "c", None, 3.0, 4.0)
    }


def test_week_over_week_survives_gaps(spark):
    counts = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01','p',5L),(DATE'2024-01-08','p',9L),(DATE'2024-01-09','p',1L) t(snapshot_date, platform, count)")
    assert [r.delta for r in tb.wow_delta(counts).orderBy("snapshot_date").collect()] == [None, 4, None]


@pytest.mark.parametrize("n, expected", [(0, (0, 0.0, 0.0, 0.0, 0.0)), (4, (4, 100.0, 100.0, 100.0, 100.0))])
def test_dq_metrics_of_empty_and_perfect_tables(spark, n, expected):
    df = spark.range(n).select(
        F.lit("a 1").alias("address"), F.array(F.lit("x")).alias("cuisine_tags"), F.lit("2024-01-14").cast("timestamp").alias("scraped_at"),
        F.lit(1.0).alias("lat"), F.lit(1.0).alias("lng"),
    )
    r = dq.dq_metrics(df, "2024-01-15").first()
    assert (r.total_merchants, r.completeness_score, r.freshness_score, r.geo_accuracy_score, r.overall_health) == expected


def test_dq_completeness_counts_a_doubly_empty_row_twice_and_stops_at_zero(spark):
    df = spark.sql("SELECT '' AS address, CAST(NULL AS ARRAY<STRING>) AS cuisine_tags, CAST(NULL AS TIMESTAMP) AS scraped_at, CAST(NULL AS DOUBLE) AS lat, 1D AS lng")
    r = dq.dq_metrics(df, "2024-01-15").first()
    assert (r.completeness_score, r.freshness_score, r.geo_accuracy_score) == (0.0, 100.0, 0.0)


def test_empty_tag_list_depends_on_the_flag(spark):
    df = spark.sql("SELECT 'a' AS address, array() AS cuisine_tags, TIMESTAMP'2024-01-14' AS scraped_at, 1D AS lat, 1D AS lng")
    assert dq.dq_metrics(df, "2024-01-15").first().missing_cuisine_count == 1
    assert dq.dq_metrics(df, "2024-01-15", pg_compat=True).first().missing_cuisine_count == 0


def test_page_keys_round_trip_on_disk(spark, tmp_path):
    df = spark.createDataFrame([("p", "m", "id1", "<html>é\nx</html>")], "platform string, market string, merchant_id string, html string")
    key = pages.page_key(F.col("platform"), F.lit("2024-01-02").cast("date"), F.col("market"), F.col("merchant_id"))
    assert df.select(key).first()[0] == "p/2024-01-02/m/id1.html"
    body = tmp_path / "raw" / "p" / "2024-01-02" / "m"
    body.mkdir(parents=True)
    (body / "id1.html").write_text("<html>é\nx</html>", encoding="utf-8")
    got = pages.read_pages(spark, str(tmp_path / "raw"), market="m").first()
    assert (got.page_key, got.html, got.platform, got.market, got.merchant_id) == ("p/2024-01-02/m/id1.html", "<html>é\nx</html>", "p", "m", "id1")


def test_page_keys_with_spaces_and_accents(spark, tmp_path):
    body = tmp_path / "raw" / "p" / "2024-01-02" / "den haag"
    body.mkdir(parents=True)
    (body / "café + 1%.html").write_text("x")
    got = pages.read_pages(spark, str(tmp_path / "raw"), day="2024-01-02").first()
    assert (got.page_key, got.market, got.merchant_id) == ("p/2024-01-02/den haag/café + 1%.html", "den haag", "café + 1%")


def test_page_table_reads_what_was_written(spark, tmp_path):
    df = spark.createDataFrame([("p", "007", "i", "x"), ("q", "den haag", "j", "y")], "platform string, market string, merchant_id string, html string")
    for day in ("2024-01-02", "2024-01-03"):
        pages.write_pages(df, str(tmp_path / "table"), day)
    back = pages.read_page_table(spark, str(tmp_path / "table"), first="2024-01-03")
    assert rows(back, "page_key", "html") == [("p/2024-01-03/007/i.html", "x"), ("q/2024-01-03/den haag/j.html", "y")]
    assert pages.read_page_table(spark, str(tmp_path / "table"), platform="p", last="2024-01-02").count() == 1


def test_parsed_listings_round_trip(spark, table, tmp_path):
    from listwell.plans.catalog.tables import _listings

    listings = _listings(table("platform_merchants").where("market IS NOT NULL"))
    pages.write_parsed(listings, str(tmp_path / "parsed"), "2024-01-15")
    back = pages.read_parsed(spark, str(tmp_path / "parsed"))
    assert rows(back, "platform", "platform_id", "name", "rating", "market") == rows(listings, "platform", "platform_id", "name", "rating", "market")


def test_listing_files_fall_back_to_the_legacy_file(spark, tmp_path):
    one = tmp_path / "one.json"
    one.write_text('[\n {"platform": "p", "platform_merchant_id": "1", "name": "n"},\n {"platform": "p", "platform_merchant_id": "2"}\n]')
    legacy = tmp_path / "legacy.json"
    legacy.write_text('[{"platform": "old", "platform_merchant_id": "9"}]')
    read = lambda paths: rows(pages.read_listing_files(spark, paths, str(legacy)), "platform", "platform_merchant_id")
    assert read([str(one), str(tmp_path / "gone.json")]) == [("p", "1"), ("p", "2")]
    assert read([str(tmp_path / "gone.json")]) == [("old", "9")]
    with pytest.raises(FileNotFoundError):
        pages.read_listing_files(spark, [str(tmp_path / "gone.json")])


def test_crawl_targets(spark):
    urls = {(r.platform, r.market): r.url for r in config.crawl_targets(config.markets(spark).select("market").union(spark.sql("SELECT 'new_york'"))).collect()}
    assert urls["justeattakeaway", "amsterdam"].endswith("/amsterdam-1072")
    assert urls["ubereats", "amsterdam"].endswith("&page=1")
    assert urls["doordash", "new_york"] == "https://www.doordash.com/food-delivery/new-york-restaurants/"
    assert urls["ubereats", "new_york"] == "https://www.ubereats.com/city/new_york"


def test_as_of_equals_brute_force(spark):
    rng = random.Random(4)
    when = lambda: rng.choice([None, *range(100)])
    left = [(rng.choice(["hot"] * 6 + ["a", None]), when(), i) for i in range(400)]
    right = [(rng.choice(["hot"] * 6 + ["a", "b", None]), when(), rng.choice([None, 1, 2, 3])) for _ in range(80)]
    a = spark.createDataFrame(left, "k string, t int, n int").repartition(3)
    b = spark.createDataFrame(right, "k string, t int, v int").repartition(3)
    got = {r.n: (r.k, r.t, r.found_at, r.v) for r in tb.as_of(a, b, ["k"], "t", ["v"]).collect()}
    assert len(got) == len(left)
    for k, t, n in left:
        found = [(at, -1 if v is None else v) for key, at, v in right if key == k and None not in (k, t, at) and at <= t]
        at, v = max(found) if found else (None, -1)
        assert got[n] == (k, t, at, None if v == -1 else v)
    assert tb.as_of(a, b.limit(0), ["k"], "t", ["v"]).where("found_at IS NOT NULL").count() == 0
    assert tb.as_of(a.limit(0), b, ["k"], "t", ["v"]).count() == 0


def test_as_of_with_a_tolerance(spark):
    at = lambda t: f"2024-01-{t:02d}"
    a = spark.createDataFrame([("k", at(10)), ("k", at(20))], "k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    b = spark.createDataFrame([("k", at(8), 1)], "k string, t string, v int").withColumn("t", F.col("t").cast("timestamp"))
    assert rows(tb.as_of(a, b, ["k"], "t", ["v"], "3 DAYS").withColumn("d", F.dayofmonth("t")), "d", "v") == [(10, 1), (20, None)]


def test_spans_equal_brute_force(spark):
    rng = random.Random(5)
    points = [(rng.choice("xxy"), rng.randint(0, 200_000), i) for i in range(300)]
    spans = [(rng.choice("xxy"), s := rng.randint(0, 200_000), rng.choice([None, s, s - 5, s + rng.randint(0, 10), s + rng.randint(0, 150_000)]), i) for i in range(150)]
    spans += [("x", 0, 4, 900), ("x", 0, 0, 901), ("x", 64, 128, 902)]
    stamp = lambda df, *cs: df.withColumns({c: F.timestamp_seconds(c) for c in cs})
    a = stamp(spark.createDataFrame(points, "k string, at bigint, p int"), "at")
    b = stamp(spark.createDataFrame(spans, "k string, s bigint, e bigint, r int"), "s", "e")
    got = sorted((r.p, r.r) for r in tb.within(a, b, ["k"], "at", "s", "e").collect())
    assert got == sorted((p, r) for k, at, p in points for key, s, e, r in spans if k == key and s <= at and (e is None or at <= e))
    assert tb.within(a.limit(0), b, ["k"], "at", "s", "e").count() == tb.within(a, b.limit(0), ["k"], "at", "s", "e").count() == 0


def test_runs_that_overlap_count_a_listing_each(spark):
    stamp = lambda df, *cs: df.withColumns({c: F.timestamp_seconds(c) for c in cs})
    seen = stamp(spark.createDataFrame([("p", "m", 5), ("p", "m", 7), ("p", "n", 5), ("q", "m", 5)], "platform string, market string, scraped_at bigint"), "scraped_at")
    runs = stamp(spark.createDataFrame([(1, "p", "m", 0, 6), (2, "p", "m", 5, None), (3, "p", "m", 8, 9)], "id int, platform string, market string, started_at bigint, finished_at bigint"), "started_at", "finished_at")
    assert rows(tb.audit_by_time(seen, runs), "id", "merchants_found") == [(1, 1), (2, 2), (3, 0)]


def test_counts_in_spans_equal_brute_force(spark):
    rng = random.Random(6)
    points = [(rng.choice(["x", "x", "y", None]), rng.choice([None, rng.randint(0, 300)]) if i % 9 == 0 else rng.randint(0, 300)) for i in range(400)]
    spans = [(i, rng.choice(["x", "y", "z", None]), s := rng.randint(-5, 310), rng.choice([None, s, s - 5, s + rng.randint(0, 200)])) for i in range(150)]
    spans += [(900, "x", None, 5), (901, "x", None, None), (902, "x", 0, 0), (902, "x", 0, None), (None, "x", 0, 300)]
    stamp = lambda df, *cs: df.withColumns({c: F.timestamp_seconds(c) for c in cs})
    a = stamp(spark.createDataFrame(points, "k string, at bigint"), "at")
    b = stamp(spark.createDataFrame(spans, "r int, k string, s bigint, e bigint"), "s", "e")
    want = {r: 0 for r, *_ in spans}
    for r, key, s, e in spans:
        want[r] += sum(1 for k, at in points if None not in (k, at, s) and k == key and s <= at and (e is None or at <= e))
    assert {x.r: x.found for x in tb.counts_within(a, b, ["k"], "at", "s", "e", "r").collect()} == want
    assert all(r.found == 0 for r in tb.counts_within(a.limit(0), b, ["k"], "at", "s", "e", "r").collect())


def test_runs_without_an_end_form_no_pairs(spark):
    """60,000 listings and as many open runs of one platform and market: 1,800,030,000 pairs, which may not be gone through."""
    seen = spark.range(60_000).select(F.lit("p").alias("platform"), F.lit("m").alias("market"), F.timestamp_seconds("id").alias("scraped_at"))
    runs = seen.select("platform", "market", F.unix_seconds("scraped_at").alias("id"), F.col("scraped_at").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"))
    assert rows(tb.audit_by_time(seen, runs).where("merchants_found <> 60000 - id"), "id") == []


def test_sketches_merge_within_their_error(spark):
    days = spark.range(60_000).select(
        F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id % 14 as int))").alias("scraped_at"),
        F.lit("p").alias("platform"), (F.col("id") * 7919 % 20_011).cast("string").alias("platform_id"),
    )
    sketches = tb.daily_sketches(days)
    assert sketches.count() == 14 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 10_000
    exact = days.select("platform_id").distinct().count()
    estimate = tb.merged_counts(sketches, "platform").first().estimate
    assert abs(estimate - exact) <= 4 * tb.SKETCH_ERROR * exact
    # Weeks merged again are the same as days merged at once.
    weeks = sketches.groupBy("platform", F.weekofyear("snapshot_date").alias("w")).agg(F.hll_union_agg("sketch").alias("sketch"))
    assert tb.merged_counts(weeks, "platform").first().estimate == estimate


def test_margins_tell_null_from_all(spark):
    from listwell.plans.coverage import coverage_margins

    pm = spark.createDataFrame([("p", "m", "1"), ("p", "m", "1"), ("p", None, "1"), ("q", "m", "1")], "platform string, market string, platform_id string")
    got = {(r.platform, r.market, r.margin): (r.listings, r.distinct_listings) for r in coverage_margins(pm).collect()}
    assert got[("p", None, 0)] == (1, 1) and got[("p", None, 1)] == (3, 1) and got[(None, None, 3)] == (4, 1) and got[(None, None, 2)] == (1, 1)
