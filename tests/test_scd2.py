from __future__ import annotations

from pyspark.sql import functions as F

from martline.functions.changefeed import latest_change
from martline.functions.dates import OPEN_END
from martline.operators import scd2

COLUMNS = ["id", "name"]
SHOWN = ("id", "name", "start_date", "end_date", "dt")


def users(feed, day, *changes, kind="update"):
    return feed("user_info", [(kind, ts, {"id": i, "name": name}, None, day) for i, name, ts in changes])


def days(feed):
    first = scd2.scd2_init(
        users(feed, "2022-06-08", ("1", "a", 1), ("2", "b", 1), kind="bootstrap-insert"), "2022-06-08", COLUMNS
    )
    changes = scd2.scd2_changes(
        users(feed, "2022-06-09", ("1", "a1", 5), ("1", "a2", 9), ("3", "c", 2)), "2022-06-09", COLUMNS
    )
    return first, changes


def test_merge_closes_changed_keeps_untouched_opens_new(feed, rows):
    first, changes = days(feed)
    open_rows, closed = scd2.scd2_merge(first, changes, "2022-06-09")
    assert rows(open_rows, *SHOWN) == [
        ("1", "a2", "2022-06-09", OPEN_END, OPEN_END),
        ("2", "b", "2022-06-08", OPEN_END, OPEN_END),
        ("3", "c", "2022-06-09", OPEN_END, OPEN_END),
    ]
    assert rows(closed, *SHOWN) == [("1", "a", "2022-06-08", "2022-06-08", "2022-06-08")]


def test_intervals_never_overlap_and_as_of_finds_one_state(feed, rows):
    first, changes = days(feed)
    open_rows, closed = scd2.scd2_merge(first, changes, "2022-06-09")
    later = scd2.scd2_changes(users(feed, "2022-06-12", ("1", "a3", 1)), "2022-06-12", COLUMNS)
    open_rows, closed_later = scd2.scd2_merge(open_rows, later, "2022-06-12")
    zipper = open_rows.unionByName(closed).unionByName(closed_later)
    assert zipper.where(F.col("end_date") == OPEN_END).groupBy("id").count().where("count > 1").isEmpty()
    assert rows(scd2.scd2_as_of(zipper, "2022-06-10"), "id", "name") == [("1", "a2"), ("2", "b"), ("3", "c")]
    assert rows(scd2.scd2_as_of(zipper, "2022-06-08"), "id", "name") == [("1", "a"), ("2", "b")]
    facts = open_rows.sparkSession.createDataFrame(
        [("1", "2022-06-08"), ("1", "2022-06-11"), ("1", "2022-06-12"), ("9", "2022-06-12")], "uid string, d string"
    )
    assert rows(scd2.scd2_join_as_of(facts, zipper, "uid", "d"), "uid", "d", "name") == [
        ("1", "2022-06-08", "a"), ("1", "2022-06-11", "a2"), ("1", "2022-06-12", "a3"), ("9", "2022-06-12", None),
    ]


def test_a_day_without_changes_keeps_every_row(feed, rows):
    first, _ = days(feed)
    none = scd2.scd2_changes(users(feed, "2022-06-09"), "2022-06-09", COLUMNS)
    open_rows, closed = scd2.scd2_merge(first, none, "2022-06-09")
    assert rows(open_rows, *SHOWN) == rows(first, *SHOWN)
    assert closed.isEmpty()


def test_latest_change_takes_the_newest(feed, rows):
    latest = latest_change(users(feed, "2022-06-09", ("1", "x", 3), ("1", "y", 7), ("2", "z", 1), (None, "n", 1)))
    assert rows(latest.select("data.*"), "id", "name") == [(None, "n"), ("1", "y"), ("2", "z")]
