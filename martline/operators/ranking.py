"""Row numbering and top ranks that survive very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_ranked(df: DataFrame, group: str, value: str, limit: int, rank: str = "rk") -> DataFrame:
    """Rows whose ``rank()`` by descending ``value`` within ``group`` is at most ``limit``; ties are kept.

    A ranked window over the rows would bring each group to one task, however large. Here the rows are first counted
    per (group, value), which combines on the map side; only the best ``limit`` distinct values of a group can hold
    such ranks, so the window sees at most that many rows per group and map task. The ranks then join back.
    """
    tied = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_tied"))
    best_first = W.partitionBy(group).orderBy(F.col(value).desc())
    cut = tied.withColumn("_nth", F.row_number().over(best_first)).where(F.col("_nth") <= limit)
    above = F.sum("_tied").over(best_first.rowsBetween(W.unboundedPreceding, -1))
    cut = cut.withColumn(rank, (F.coalesce(above, F.lit(0)) + F.lit(1)).cast("bigint"))
    cut = cut.where(F.col(rank) <= limit).select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), rank
    )
    same = df[group].eqNullSafe(cut["_group"]) & df[value].eqNullSafe(cut["_value"])
    return df.join(cut, same, "inner").drop("_group", "_value")


def number_and_next(
    df: DataFrame, groups: list[str], order: list[str], chunk: Column, carry: str, number: str, following: str
) -> DataFrame:
    """``groups``, ``carry``, its ``row_number()`` and its ``lead()`` within ``groups``, computed chunk by chunk.

    ``chunk`` is a coarser form of the first ordering column. Rows are shuffled by (groups, chunk), so a group that
    holds a large share of all rows is spread over its chunks; the size and first value of each chunk, one small row,
    supply the offset and the value that follows a chunk's last row. ``following`` is a one-field struct that is NULL
    only where no row follows, because the carried value itself may be NULL.
    """
    # Keys are made non-null so that the join can use the window's partitioning. Numbered rows and chunk heads come
    # from the same columns, so both read one shuffle of the rows.
    keys = {f"_g{i}": _never_null(F.col(name)) for i, name in enumerate(groups)}
    rows = df.select(
        *[column.alias(name) for name, column in keys.items()], _never_null(chunk).alias("_chunk"),
        *dict.fromkeys([*order, carry]),
    )
    inside = W.partitionBy(*keys, "_chunk").orderBy(*order)
    whole = inside.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    numbered = rows.withColumns({
        "_n": F.row_number().over(inside), "_size": F.count(F.lit(1)).over(whole), "_next": F.lead(carry).over(inside),
    })
    heads = numbered.where(F.col("_n") == 1)
    by_chunk = W.partitionBy(*keys).orderBy("_chunk")
    offset = F.coalesce(F.sum("_size").over(by_chunk.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.lead(F.struct(F.col(carry).alias("v"))).over(by_chunk)
    chunks = heads.select(*keys, "_chunk", offset.alias("_offset"), after.alias("_after"))
    joined = numbered.join(chunks, [*keys, "_chunk"], "inner")
    next_one = F.when(F.col("_n") < F.col("_size"), F.struct(F.col("_next").alias("v"))).otherwise(F.col("_after"))
    return joined.select(
        *[_restored(key).alias(name) for key, name in zip(keys, groups)], carry,
        (F.col("_n") + F.col("_offset")).alias(number), next_one.alias(following),
    )


def _never_null(key: Column) -> Column:
    """The key as text, with a mark that keeps NULL apart from every value and first in order."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def _restored(key: str) -> Column:
    return F.when(F.col(key) != F.lit(""), F.expr(f"substring({key}, 2)"))
