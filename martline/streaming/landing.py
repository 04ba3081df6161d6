"""Landing of raw topics into day folders.

A topic is any streaming DataFrame with a string column ``value`` holding one JSON document, as a Kafka source cast to
string gives. Rows go to the day of the time written inside them, not of their arrival, so an event produced just
before midnight lands in its own day. A row without a readable time lands in the default partition: no day reads it, and
:func:`martline.operators.sinks.unreadable_rows` counts it.

Each batch brings the rows of a folder together, so it writes at most ``splits`` files per folder. A day that is over is
compacted into a folder of its own, which later readers use: they need not load the stream's file log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martline.functions.columns import local_day

# The topics, the zone that decides the day, and how often a batch is closed.
TOPIC_LOG, TOPIC_DB = "topic_log", "topic_db"
ZONE = "GMT+8"
BATCH_INTERVAL = "10 seconds"
#: Files that one batch writes into one folder, at most.
SPLITS = 4

_LOG_HEAD = T.StructType().add("ts", T.LongType())
_CHANGE_HEAD = T.StructType().add("table", T.StringType()).add("ts", T.LongType())


def tail_files_stream(spark: SparkSession, path: str, pattern: str = "*", files_per_batch: int = 1000) -> DataFrame:
    """Lines of the files that appear in a directory; finished files are remembered in the query's checkpoint.

    A file is read once, so it must be complete when it appears: write it elsewhere and rename it into place, or under
    a name that ``pattern`` leaves out. Lines added to a file after that are not read.
    """
    return (
        spark.readStream.option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path)
    )


def log_days(stream: DataFrame, zone: str = ZONE) -> DataFrame:
    head = F.from_json("value", _LOG_HEAD)
    return stream.select("value", local_day(head["ts"], zone).alias("dt"))


def change_days(stream: DataFrame, zone: str = ZONE, ts_in_seconds: bool = True) -> DataFrame:
    """Changes with their table and day. The feed's own ``ts`` counts seconds."""
    head = F.from_json("value", _CHANGE_HEAD).alias("head")
    at: Column = F.col("head.ts") * 1000 if ts_in_seconds else F.col("head.ts")
    return stream.select("value", head).select(
        "value", F.concat(F.col("head.table"), F.lit("_inc")).alias("table"), local_day(at, zone).alias("dt")
    )


def land_log_stream(
    stream: DataFrame, path: str, checkpoint: str, zone: str = ZONE, once: bool = False,
    interval: str = BATCH_INTERVAL, splits: int = SPLITS,
) -> StreamingQuery:
    return _land(log_days(stream, zone), ["dt"], path, checkpoint, once, interval, splits)


def land_change_stream(
    stream: DataFrame, path: str, checkpoint: str, zone: str = ZONE, ts_in_seconds: bool = True, once: bool = False,
    interval: str = BATCH_INTERVAL, splits: int = SPLITS,
) -> StreamingQuery:
    rows = change_days(stream, zone, ts_in_seconds)
    return _land(rows, ["table", "dt"], path, checkpoint, once, interval, splits)


def compact_day(
    spark: SparkSession, landed: str, closed: str, day: str, folders: Sequence[str] = ("dt",),
    max_records: int = 5_000_000,
) -> None:
    """The landed rows of ``day`` as few files under ``closed``, in the same folders; running it again replaces them.

    ``folders`` are those of the landing: ``("dt",)`` for the log, ``("table", "dt")`` for changes. The rebalance splits a
    folder by its bytes; ``max_records`` bounds a file's rows besides. The landed files stay.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("value", *folders)])
    rows = spark.read.schema(schema).text(landed).where(F.col("dt") == F.lit(day))
    (
        rows.hint("rebalance", *folders).write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression="gzip", maxRecordsPerFile=max_records)
        .partitionBy(*folders).text(closed)
    )


def _land(
    rows: DataFrame, folders: list[str], path: str, checkpoint: str, once: bool, interval: str, splits: int
) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    part = F.pmod(F.xxhash64("value"), F.lit(splits))
    return (
        rows.repartition(*folders, part).writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "gzip")
        .partitionBy(*folders)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
