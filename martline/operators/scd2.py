"""Validity-interval ("zipper") dimensions.

The open rows are kept as one version per run day, so a day is always built from the version before it. Running a
day again therefore reads the same input and gives the same rows, and no table is overwritten while it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.changefeed import BOOTSTRAP, latest_change
from martline.functions.columns import on_day
from martline.functions.dates import OPEN_END, shift

# The user attributes kept in the dimension.
USER_COLUMNS = [
    "id", "login_name", "nick_name", "name", "phone_num", "email", "user_level", "birthday", "gender",
    "create_time", "operate_time",
]


def scd2_init(feed: DataFrame, day: str, columns: list[str] = USER_COLUMNS) -> DataFrame:
    """First day: every bootstrapped row is open from that day."""
    rows = on_day(feed, day).where(F.col("type") == F.lit(BOOTSTRAP)).select("data.*")
    return _interval(rows.select(*columns), F.lit(day), F.lit(OPEN_END))


def scd2_changes(feed: DataFrame, day: str, columns: list[str] = USER_COLUMNS) -> DataFrame:
    """Last state per key among the day's changes."""
    return latest_change(on_day(feed, day)).select("data.*").select(*columns)


def scd2_merge(open_rows: DataFrame, changes: DataFrame, day: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """``(open, closed)`` after ``day``; ``changes`` holds one row per changed key.

    Untouched rows only pass one join against the changed keys. When those are few the join broadcasts by its
    measured size and the open rows are neither shuffled nor sorted.
    """
    merged = scd2_merged(open_rows, changes, day, key)
    still_open = F.col("end_date") == F.lit(OPEN_END)
    return merged.where(still_open), merged.where(~still_open)


def scd2_merged(open_rows: DataFrame, changes: DataFrame, day: str, key: str = "id") -> DataFrame:
    """Both results of :func:`scd2_merge` in one frame, told apart by ``dt``, for a single write."""
    columns = [c for c in open_rows.columns if c not in ("start_date", "end_date", "dt")]
    touched = changes.select(F.col(key).alias("_key"), F.lit(True).alias("_touched"))
    end = F.when(F.col("_touched"), F.lit(shift(day, -1))).otherwise(F.lit(OPEN_END))
    kept = open_rows.drop("dt").join(touched, F.col(key).eqNullSafe(F.col("_key")), "left")
    kept = _interval(kept.select(*columns, "start_date", end.alias("_end")), F.col("start_date"), F.col("_end"))
    fresh = _interval(changes.select(*columns), F.lit(day), F.lit(OPEN_END))
    return kept.drop("_end").unionByName(fresh)


def _interval(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    rows = rows.withColumns({"start_date": start, "end_date": end})
    return rows.withColumn("dt", F.col("end_date"))


def scd2_current(zipper: DataFrame) -> DataFrame:
    return zipper.where(F.col("dt") == F.lit(OPEN_END))


def scd2_as_of(zipper: DataFrame, day: str) -> DataFrame:
    """State on ``day``. Rows closed before it lie in earlier partitions, which the ``dt`` filter prunes."""
    return zipper.where((F.col("dt") >= F.lit(day)) & (F.col("start_date") <= F.lit(day)))


def scd2_join_as_of(facts: DataFrame, zipper: DataFrame, key: str, day: str, zipper_key: str = "id") -> DataFrame:
    """Each fact with the dimension state valid on its own ``day`` column; intervals never overlap per key."""
    states = zipper.drop("dt").withColumnRenamed(zipper_key, "_key")
    valid = (
        (F.col(key) == F.col("_key")) & (F.col(day) >= F.col("start_date")) & (F.col(day) <= F.col("end_date"))
    )
    return facts.join(states, valid, "left").drop("_key")
