"""Late data: which days have to be run again, and running them.

Every run of a day notes the landed files that it read, in a ledger beside the tables. Rows that come later land in the
day they belong to, as files of their own; a day whose files differ from its note is stale. The user history, the order
flow and the to-date tables of a day are built on those of the day before, and rolling summaries reach back 30 days, so
every later day that has run is built again too, in order. Days before the first stale one stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.dates import shift
from martline.operators import sinks
from martline.plans import daily
from martline.plans.daily import Warehouse

LEDGER = "run_ledger"
_NOTE = T.StructType().add("file", T.StringType()).add("bytes", T.LongType()).add("modified", T.TimestampType()).add("dt", T.StringType())


def landed_files(spark: SparkSession, landed: str) -> DataFrame:
    """Files of all landed days with size and time; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landed.rstrip("/"))
    return files.select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"),
        F.regexp_extract("path", "/dt=([0-9-]+)/", 1).alias("dt"),
    ).where(F.col("dt") != "")


def noted(w: Warehouse) -> DataFrame:
    return w.spark.read.schema(_NOTE).orc(w.path(LEDGER))


def run_noted(w: Warehouse, landed: str, day: str, first_day: bool = False) -> None:
    """:func:`daily.run_day` with a note of what it read. The note is taken before the run: files that land meanwhile are late."""
    files = landed_files(w.spark, landed).where(F.col("dt") == day).collect()  # as many as a day has files
    daily.run_day(w, landed, day, first_day)
    sinks.overwrite_partition(w.spark.createDataFrame(files, _NOTE), w.path(LEDGER), day)


def stale_days(w: Warehouse, landed: str) -> list[str]:
    """Days that have run and whose landed files are not those noted: new ones, changed ones, or ones that are gone."""
    now, then = landed_files(w.spark, landed), noted(w)
    ran = then.select("dt").distinct()
    both = now.join(ran, "dt", "left_semi").withColumn("side", F.lit(1)).unionByName(then.withColumn("side", F.lit(2)))
    changed = both.groupBy("dt", "file", "bytes", "modified").agg(F.sum("side").alias("sides")).where("sides <> 3")
    return [r["dt"] for r in changed.select("dt").distinct().orderBy("dt").collect()]


def days_to_run(w: Warehouse, landed: str) -> list[str]:
    """The first stale day and every later one that has run."""
    stale = stale_days(w, landed)
    if not stale:
        return []
    last = noted(w).agg(F.max("dt")).first()[0]
    days, day = [], stale[0]
    while day <= last:
        days.append(day)
        day = shift(day, 1)
    return days


def rerun(w: Warehouse, landed: str) -> list[str]:
    """Run again what late data has made stale, and return these days. Nothing is stale afterwards."""
    days = days_to_run(w, landed)
    first = noted(w).agg(F.min("dt")).first()[0]
    for day in days:
        run_noted(w, landed, day, first_day=day == first)
    return days
