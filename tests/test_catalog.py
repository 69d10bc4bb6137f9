"""Registered queries against their SQL on the smallest tables, and plans that matter."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from listwell.operators import tables as tb  # noqa: E402
from listwell.plans import coverage as cv  # noqa: E402
from listwell.plans.catalog import reports, tables, texts  # noqa: E402

SF = "/root/testdata/sf0.001"
QUICK = [n for m in (reports, tables, texts) for n in m.ENTRIES]


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", QUICK)
def test_equal_to_sql(spark, con, name):
    build, sql = spark_entry.queries()[name], spark_entry.oracle_sql().get(name)
    line = check_oracle.compare(con, spark, SF, name, build, sql)
    assert not line.startswith("FAIL"), line


def test_every_query_is_registered_once():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert len(spark_entry.queries()) > 110


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_read_only_their_columns(spark, table):
    plan = plan_of(cv.coverage_report(table("platform_merchants")))
    (schema,) = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert "p_name" not in schema and "p_size" not in schema


def test_top_k_does_not_sort_everything(table):
    plan = plan_of(cv.acquisition_targets(table("platform_merchants"), table("merchants"), table("merchant_matches")))
    assert "TakeOrderedAndProject" in plan


def test_batches_are_reduced_before_the_shuffle(table):
    plan = plan_of(tb.latest(table("listing_batch"), ("platform", "platform_id"), ("seq",)))
    assert "partial_max_by" in plan and "Window" not in plan


def test_ordered_reports_are_ordered(table):
    args = (table("platform_merchants"), table("merchants"), table("merchant_matches"))
    ratings = [r.rating for r in cv.coverage_gaps(*args).collect()]
    known = [r for r in ratings if r is not None]
    assert known == sorted(known, reverse=True) and all(r is None for r in ratings[len(known):])
    scores = [r.quality_score for r in cv.acquisition_targets(*args).collect()]
    assert scores == sorted(scores, reverse=True)
    counts = [r.total_merchants for r in cv.total_merchants(args[0]).collect()]
    assert counts == sorted(counts, reverse=True)


def test_approximate_count_is_near(table):
    exact = {r.platform: r.total_merchants for r in cv.total_merchants(table("platform_merchants")).collect()}
    near = {r.platform: r.total_merchants for r in cv.total_merchants(table("platform_merchants"), approx=True).collect()}
    assert all(abs(near[p] - n) <= 0.15 * n for p, n in exact.items())


def test_nested_report(table):
    nested = cv.coverage_report_nested(table("platform_merchants").where(F.col("market").isNotNull()))
    flat = {(r.market, p): n for r in nested.collect() for p, n in r.platforms.items()}
    assert flat == {(r.market, r.platform): r.cnt for r in cv.coverage_report(table("platform_merchants")).collect() if r.market}
