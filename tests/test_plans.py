"""What the plans must and must not contain."""

from __future__ import annotations

from pathlib import Path

import pytest

from martline.functions.dates import shift
from martline.operators import reports, rollups, scd2, sinks
from martline.plans.catalog import QUERIES
from martline.plans.standins import Standins
from martline.sources import files

DIR = Path("/root/testdata/sf0.001")
DAY = "2022-06-08"
LAZY = [name for name in QUERIES if name[0] not in "sk"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not DIR.exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_forced_broadcast(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, str(DIR)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for banned in ("Python", "Cartesian", "NestedLoop", "BroadcastHashJoin"):
        assert banned not in text


@pytest.fixture(scope="module")
def sessions(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "sessions")
    rows = [("s", "m", "web", 10, 1, shift(DAY, -n)) for n in range(40)]
    df = spark.createDataFrame(
        rows, "session_id string, mid_id string, channel string, during_time_1d bigint, page_count_1d bigint, dt string"
    )
    sinks.overwrite_dynamic(df, path)
    return path


@pytest.mark.parametrize("inferred", ["true", "false"])
def test_day_filters_prune_partitions(spark, sessions, inferred):
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", inferred)
    try:
        report = reports.traffic_by_channel(files.read_table(spark, sessions), DAY)
        assert report.count() == 3
        scans = [s for s in plan(report).splitlines() if "FileScan orc" in s]
        assert scans and all("PartitionFilters: [isnotnull(dt" in s or "PartitionFilters: [(cast(dt" in s for s in scans)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", before)


def test_summaries_aggregate_before_the_dimension_join(spark):
    detail = spark.createDataFrame(
        [], "user_id string, sku_id string, sku_num bigint, split_original_amount decimal(16,2),"
        " split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2), split_total_amount decimal(16,2),"
        " dt string"
    )
    sku = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["id", *rollups.SKU_ATTRIBUTES, "dt"]))
    text = rollups.user_sku_order_1d(detail, sku, DAY)._jdf.queryExecution().analyzed().toString()
    assert text.index("Join LeftOuter") < text.index("Aggregate [dt")


def test_to_date_aggregates_by_hash_in_one_exchange(spark):
    previous = spark.range(5).selectExpr("string(id) user_id", "'2022-01-01' a", "'2022-01-02' b", "id n")
    text = plan(rollups.to_date(previous, previous, "user_id", "a", "b", ["n"]))
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_untouched_open_rows_are_neither_shuffled_nor_sorted(spark):
    open_rows = spark.range(1000).selectExpr(
        "string(id) id", "'n' name", "'2022-01-01' start_date", "'9999-12-31' end_date", "'9999-12-31' dt"
    )
    changes = spark.range(1).selectExpr("string(id) id", "'x' name")
    text = plan(scd2.scd2_merged(open_rows, changes, DAY))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


@pytest.mark.skipif(not DIR.exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["f2_fact_order_detail", "f3_fact_payment_success"])
def test_daily_facts_read_uncut_order_feeds(spark, monkeypatch, name):
    asked, real = [], Standins.order_feeds
    monkeypatch.setattr(Standins, "order_feeds", lambda self, *a, **k: asked.append((a[1:], k)) or real(self, *a, **k))
    QUERIES[name](spark, str(DIR))
    assert asked == [((), {})]
