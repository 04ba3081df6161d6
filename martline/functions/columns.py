"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def money(column: Column | str) -> Column:
    """As ``MONEY``; a value that does not fit becomes NULL, as it does where the tables came from."""
    return _col(column).try_cast(MONEY)


def day_of(column: Column | str) -> Column:
    """Day of a ``yyyy-MM-dd[ HH:mm:ss]`` string, NULL when it is malformed. No time zone is involved."""
    return _col(column).try_cast("date").cast("string")


def day_number(column: Column | str) -> Column:
    """Day as an integer. Minimum and maximum of integers aggregate by hash, those of strings need a sort."""
    return F.unix_date(_col(column).try_cast("date"))


def day_text(number: Column | str) -> Column:
    return F.date_from_unix_date(_col(number)).cast("string")


def local_time(epoch_ms: Column | str, zone: str) -> Column:
    """Wall-clock ``yyyy-MM-dd HH:mm:ss`` in ``zone``, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MILLISECOND", _col(epoch_ms), epoch)
    return F.substring(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("string"), 1, 19)


def local_day(epoch_ms: Column | str, zone: str) -> Column:
    return F.substring(local_time(epoch_ms, zone), 1, 10)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff(
        "SECOND", _col(start).try_cast("timestamp_ntz"), _col(end).try_cast("timestamp_ntz")
    )


def ratio(part: Column, whole: Column, scale: int = 1) -> Column:
    """``part / whole * scale`` as money-typed ratio, NULL for an empty whole."""
    return F.try_divide(part * F.lit(scale), whole).try_cast(MONEY)


def whole_average(total: Column, count: Column) -> Column:
    """Average cut to a whole number, from an exact integer sum and a count."""
    return F.call_function("div", total, F.nullif(count, F.lit(0)))


def on_day(df: DataFrame, day: str | None) -> DataFrame:
    """Rows of one day partition; ``None`` keeps the whole history."""
    return df if day is None else df.where(F.col("dt") == F.lit(day))


def in_days(df: DataFrame, first: str, last: str) -> DataFrame:
    return df.where(F.col("dt").between(F.lit(first), F.lit(last)))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
