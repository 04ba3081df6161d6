"""Approximate distinct counts that add up over days: a sketch per day and key, merged for any window.

Exact distinct counts over 7 or 30 days must see every key of these days again; a sketch has a fixed size and merges. The
reports stay exact by default; this is for dashboards that ask for many windows, or days long past. The relative
standard error is :func:`standard_error`: with the default 2**12 registers 1.6 %, so 95 % of the counts lie within 3.3 %.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions.columns import in_days, on_day
from martline.functions.dates import WINDOWS, window_start

#: Logarithm of the registers of a sketch: 12 takes 2 KB (four bits each).
LOG_REGISTERS = 12


def standard_error(log_registers: int = LOG_REGISTERS) -> float:
    """Relative standard error of a merged sketch, as published for sketches of this kind."""
    return 1.04 / sqrt(2**log_registers)


def daily_sketches(rows: DataFrame, day: str | None, keys: Sequence[str], values: Sequence[str], log_registers: int = LOG_REGISTERS) -> DataFrame:
    """A row per day and key with a sketch of each of ``values``; missing values count nowhere. Combines before the shuffle."""
    made = [F.hll_sketch_agg(F.col(v), F.lit(log_registers)).alias(f"{v}_sketch") for v in values]
    return on_day(rows, day).groupBy("dt", *keys).agg(*made)


def distinct_in_windows(sketches: DataFrame, day: str, keys: Sequence[str], values: Sequence[str], windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Distinct ``values`` per window and key from stored sketches: ``dt, recent_days``, keys and ``<value>_count``."""
    rows = in_days(sketches, window_start(day, max(windows)), day)
    spans = F.explode(F.filter(F.array(*[F.struct(F.lit(n).cast("bigint").alias("n"), F.lit(window_start(day, n)).alias("first")) for n in windows]), lambda w: F.col("dt") >= w["first"]))
    merged = rows.withColumn("w", spans).groupBy("w.n", *keys).agg(*[F.hll_union_agg(f"{v}_sketch").alias(v) for v in values])
    return merged.select(F.lit(day).alias("dt"), F.col("n").alias("recent_days"), *keys, *[F.hll_sketch_estimate(v).alias(f"{v}_count") for v in values])
