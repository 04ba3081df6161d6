"""Decoding of row-change envelopes: ``type, ts, data struct, old map``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the feed's ``type`` field.
BOOTSTRAP = "bootstrap-insert"
INSERT = "insert"
UPDATE = "update"


def is_new_row(first_day: bool) -> Column:
    """The rows that count as new: the bootstrap copy on the first day, real inserts later."""
    return F.col("type") == F.lit(BOOTSTRAP if first_day else INSERT)


def bootstrap_vs_incremental(feed: DataFrame, first_day: bool) -> DataFrame:
    wanted = [BOOTSTRAP] if first_day else [INSERT, UPDATE]
    return feed.where(F.col("type").isin(wanted))


def changed(column: str) -> Column:
    """True for an update whose old values include ``column``."""
    return (F.col("type") == F.lit(UPDATE)) & F.map_contains_key("old", F.lit(column))


def field_changed(feed: DataFrame, column: str) -> DataFrame:
    return feed.where(changed(column))


def position(feed: DataFrame) -> list[Column]:
    """What orders the changes of a key: the second, then the transaction and the place in it where the feed has them.

    A transaction's last change carries ``commit`` instead of a place.
    """
    place = [F.col("ts")]
    if "xid" in feed.columns:
        place.append(F.col("xid"))
    if "xoffset" in feed.columns:
        last = F.lit(2**63 - 1).cast("bigint")
        place.append(F.when(F.col("commit"), last).otherwise(F.col("xoffset")).alias("xoffset") if "commit" in feed.columns else F.col("xoffset"))
    return place


def latest_change(feed: DataFrame, key: str = "id") -> DataFrame:
    """Last ``data`` per key of the rows given, by their position; equal positions are settled by the data itself.

    A grouped maximum combines on the map side, so a key that changes very often never gathers in one task the way
    a ranked window would.
    """
    newest = F.max(F.struct(*position(feed), "data")).alias("newest")
    return (
        feed.groupBy(F.col("data")[key].alias("_key"))
        .agg(newest)
        .select(F.col("newest.ts").alias("ts"), F.col("newest.data").alias("data"))
    )
