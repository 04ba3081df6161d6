from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martline.functions import changefeed
from martline.functions.dates import shift
from martline.operators import rollups, sinks, sketches
from martline.plans import daily

DAY = "2022-06-08"
KEYS, MEASURES = ["k"], ["n_1d", "money_1d"]
SCHEMA = "k string, n_1d bigint, money_1d decimal(16,2), dt string"


@pytest.fixture(scope="module")
def one_day(spark):
    rng = random.Random(3)
    rows = []
    for d in range(45):
        for k in range(12):
            if rng.random() < 0.3:
                amount = None if k == 3 else Decimal(rng.randrange(-500, 10_000)) / 100
                rows.append((None if k == 5 else f"k{k}", rng.choice([None, rng.randrange(9)]), amount, shift(DAY, d)))
    rows = [r for r in rows if not (r[0] == "k7" and r[3] > shift(DAY, 12))]  # one key leaves for good
    return spark.createDataFrame(rows, SCHEMA).cache()


def on(df, day):
    return df.where(F.col("dt") == day)


def full(one_day, day, length):
    rows = one_day.where((F.col("dt") > shift(day, -length)) & (F.col("dt") <= day))
    return rows.groupBy("k").agg(F.sum("n_1d").alias(f"n_{length}d"), F.sum("money_1d").cast("decimal(16,2)").alias(f"money_{length}d")).withColumn("dt", F.lit(day))


def test_thirty_days_in_a_row_equal_the_full_scan(spark, one_day, rows, tmp_path):
    length, day = 7, shift(DAY, 8)
    state = rollups.moving_start(one_day, day, KEYS, MEASURES, length)
    for n in range(30):
        path = str(tmp_path / str(n))
        state.coalesce(1).write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if n % 6 == 0 or n > 26:
            assert rows(rollups.moving_rows(state, day, MEASURES, length)) == rows(full(one_day, day, length)), day
        day = shift(day, 1)
        state = rollups.moving_next(state, on(one_day, day), on(one_day, shift(day, -length)), KEYS, MEASURES)
    assert "k7" not in {r["k"] for r in state.collect()}


def test_a_corrected_day_is_taken_over(one_day, rows):
    day, length = shift(DAY, 20), 7
    fixed = shift(day, -3)
    new = on(one_day, fixed).withColumn("money_1d", (F.col("money_1d") + 1).cast("decimal(16,2)")).where("k <> 'k1' or k is null")
    state = rollups.moving_corrected(rollups.moving_start(one_day, day, KEYS, MEASURES, length), on(one_day, fixed), new, KEYS, MEASURES)
    other = one_day.where(F.col("dt") != fixed).unionByName(new)
    assert rows(rollups.moving_rows(state, day, MEASURES, length)) == rows(full(other, day, length))
    with pytest.raises(TypeError, match="exactly"):
        rollups.moving_next(state, new.withColumn("n_1d", F.col("n_1d").cast("double")), new, KEYS, MEASURES)


def test_sketches_merge_over_days_within_their_bound(spark):
    day = shift(DAY, 40)
    rows = spark.range(60_000).select(
        F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("channel"), (F.col("id") % 17_001).cast("string").alias("mid_id"),
        F.date_format(F.date_sub(F.lit(day).cast("date"), (F.col("id") % 33).cast("int")), "yyyy-MM-dd").alias("dt"),
    ).union(spark.createDataFrame([("c0", None, day), (None, None, day)], "channel string, mid_id string, dt string"))
    stored = sketches.daily_sketches(rows, None, ["channel"], ["mid_id"]).cache()
    assert stored.count() == 67
    got = {(r["recent_days"], r["channel"]): r["mid_id_count"] for r in sketches.distinct_in_windows(stored, day, ["channel"], ["mid_id"]).collect()}
    for n in (1, 7, 30):
        inside = rows.where(F.col("dt") > shift(day, -n))
        for channel, exact in inside.groupBy("channel").agg(F.countDistinct("mid_id")).collect():
            assert abs(got[n, channel] - exact) <= 4 * sketches.standard_error() * exact + 0.5
    assert got[1, None] == 0


def test_the_later_change_of_a_second_wins(spark, rows):
    data = "struct<id string, v string>"
    schema = f"type string, ts long, data {data}, xid long, xoffset long, commit boolean"
    entries = [
        ("update", 5, ("1", "z"), 10, 0, None), ("update", 5, ("1", "y"), 10, 1, None), ("update", 5, ("1", "a"), 10, None, True),
        ("update", 5, ("2", "a"), 12, None, True), ("update", 5, ("2", "z"), 11, None, True),
        ("update", 6, ("3", "a"), None, None, None), ("update", 5, ("3", "z"), 99, None, True),
        ("update", 5, ("4", "a"), None, None, None), ("update", 5, ("4", "b"), None, None, None),
    ]
    feed = spark.createDataFrame(entries, schema)
    assert rows(changefeed.latest_change(feed), "data.id", "data.v") == [("1", "a"), ("2", "a"), ("3", "a"), ("4", "b")]
    assert rows(changefeed.latest_change(feed.drop("xid", "xoffset", "commit")), "data.id", "data.v") == [("1", "z"), ("2", "z"), ("3", "a"), ("4", "b")]


@pytest.mark.parametrize(("table", "row", "reason"), [
    ("dwd_traffic_page_view_inc", ("view_time string, x int", (None, 1)), "rows without view_time"),
    ("dwd_trade_order_detail_inc", ("order_id string, split_total_amount decimal(16,2)", ("1", None)), "rows without split_total_amount"),
    ("ads_order_stats_by_tm", ("order_count bigint, order_user_count bigint", (1, 2)), "more buyers than orders"),
    ("ads_user_retention", ("retention_count bigint, new_user_count bigint", (3, 2)), "more users retained than new"),
])
def test_what_must_not_be_ends_the_run_as_it_is_written(spark, tmp_path, table, row, reason):
    w = daily.Warehouse(spark, str(tmp_path))
    good = (1, 1) if "count" in row[0] else ("2", 1)
    ok = spark.createDataFrame([good], row[0].replace("decimal(16,2)", "int"))
    for spread in (False, True):
        w.put(table, ok.withColumn("dt", F.lit(DAY)), DAY, spread)
        bad = spark.createDataFrame([row[1]], row[0]).withColumn("dt", F.lit(DAY))
        with pytest.raises(sinks.FailedCheck, match=reason):
            w.put(table, bad, DAY, spread)
        w.put(table, bad.where("false"), DAY, spread)


def test_lines_without_a_time_end_the_run(spark, tmp_path):
    (tmp_path / "log" / "dt=__HIVE_DEFAULT_PARTITION__").mkdir(parents=True)
    (tmp_path / "log" / "dt=__HIVE_DEFAULT_PARTITION__" / "a.txt").write_text("broken\n")
    with pytest.raises(sinks.FailedCheck, match="without a readable time"):
        daily.run_day(daily.Warehouse(spark, str(tmp_path / "w")), str(tmp_path), DAY)
