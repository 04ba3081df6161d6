"""One key holds a third of all rows: results stay whole and equal to plain counting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martline.operators import facts, reports, rollups

DAY = "2022-06-08"
ROWS = 60000


@pytest.fixture(scope="module")
def hot(spark):
    """Events of which every third belongs to one key; that key is missing in one more column."""
    is_hot = F.col("id") % 3 == 0
    return spark.range(ROWS).select(
        "id", F.when(is_hot, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("key"),
        F.when(~is_hot, F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("nullable"),
        (F.lit(1654617600000) + F.col("id") * 1400).alias("ts"), F.lit(DAY).alias("dt"),
    )


def test_login_per_session_with_a_missing_session_id(hot, rows):
    log = hot.select(
        F.struct(*[F.lit("x").alias(c) for c in ("ch", "ar", "vc", "mid", "ba", "md", "os")],
                 F.col("id").cast("string").alias("uid"), F.col("nullable").alias("sid")).alias("common"),
        F.struct(F.lit("home").alias("page_id")).alias("page"), "ts", "dt",
    )
    first = hot.groupBy("nullable").agg(F.min("id").cast("string").alias("uid"))
    assert rows(facts.fact_login(log, DAY), "user_id") == rows(first, "uid")


def test_page_path_numbers_every_step_of_the_hot_session(hot, rows):
    views = hot.select(
        F.col("key").alias("session_id"), F.timestamp_millis("ts").cast("string").substr(1, 19).alias("view_time"), "ts",
        F.lit("p").alias("page_id"), "dt",
    )
    paths = reports.page_path(views, DAY)
    assert paths.agg(F.sum("path_count")).first()[0] == ROWS
    assert paths.where("target like '%:out'").agg(F.sum("path_count")).first()[0] == views.select("session_id").distinct().count()
    longest = paths.select(F.split(F.split("source", ":")[0], "-")[1].cast("int").alias("n")).agg(F.max("n"))
    assert longest.first()[0] == ROWS // 3


def test_orders_and_buyers_of_a_hot_province(hot, rows):
    zero = F.lit(0).cast("decimal(16,2)")
    detail = hot.select(
        F.col("nullable").alias("province_id"), (F.col("id") % 5000).cast("string").alias("order_id"),
        F.lit(1).cast("bigint").alias("sku_num"), zero.alias("split_original_amount"),
        zero.alias("split_activity_amount"), zero.alias("split_coupon_amount"), zero.alias("split_total_amount"), "dt",
    )
    names = ", ".join(f"string(null) {c}" for c in rollups.PROVINCE_ATTRIBUTES)
    province = hot.sparkSession.sql(f"select 'none' as id, {names}, '{DAY}' as dt")
    expected = detail.groupBy("province_id").agg(F.countDistinct("order_id").alias("n"))
    ours = rollups.province_order_1d(detail, province, DAY)
    assert rows(ours, "province_id", "order_count_1d") == rows(expected)


def test_top_three_when_a_third_of_the_products_tie_in_one_brand(hot, rows):
    favors = hot.select(
        F.col("key").alias("tm_id"), F.col("key").alias("tm_name"), F.col("id").cast("string").alias("sku_id"),
        F.lit("n").alias("sku_name"), (F.col("id") % 2).alias("favor_add_count_1d"), "dt",
    )
    top = reports.favor_count_top3_by_tm(favors, DAY)
    expected = favors.where("favor_add_count_1d = 1").groupBy("tm_id").count().where("count >= 3")
    best = top.where("tm_id = 'hot'")
    assert best.count() == expected.where("tm_id = 'hot'").first()["count"] == ROWS // 6
    assert rows(best.select("rk").distinct()) == [(1,)]
