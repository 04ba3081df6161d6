"""Operators over event time that keep bounded state: de-duplication by key and traffic per closed window.

Both drop what comes later than the watermark of the batch before, and both keep state only for the delay: keys leave the store when the
watermark has passed them, windows when it has passed their end. :class:`LateRows` counts what was dropped, over all
runs of a query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from martline.functions.columns import ratio, whole_average

#: Fixed value: how far log events may come late.
DELAY = "1 hour"


def event_time(epoch_ms: Column | str) -> Column:
    return F.timestamp_millis(F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms)


def first_of_key(stream: DataFrame, keys: Sequence[str], at: str, delay: str = DELAY) -> DataFrame:
    """Rows of ``stream`` whose ``keys`` were not seen within ``delay`` before; ``at`` is the event's timestamp.

    A repeat that comes up to ``delay`` after the first one goes. Rows older than the watermark go as well and are
    counted. A key is held for ``delay`` after its event, however long the query runs. A missing time is never late, and
    missing keys are equal to each other.
    """
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def channel_traffic(views: DataFrame, at: str, delay: str = DELAY, window: str = "1 day", offset: str | None = None) -> DataFrame:
    """Visitors, average stay and pages, sessions and bounce rate per channel and closed window: :func:`reports.traffic_by_channel`
    of page views as they come, without a daily run.

    Distinct visitors are exact and need no set per channel: views are summed per session, then per visitor and per session
    id, and these groups are counted. Each step is a window aggregate of its own, so a hot channel is spread over its
    visitors. ``offset`` is where windows begin after midnight UTC (``"16 hours"`` for days of GMT+8).
    """
    keys = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"]
    span = F.window(at, window, window, offset) if offset else F.window(at, window)
    sessions = views.withWatermark(at, delay).groupBy(span.alias("window"), *keys).agg(
        F.sum("during_time").alias("stay"), F.count(F.lit(1)).alias("pages")
    )
    entries = F.explode(F.array(
        F.struct(F.lit("visitor").alias("kind"), F.col("mid_id").alias("id")),
        F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id")),
    ))
    visitor = F.col("k.kind") == "visitor"
    counted = sessions.withColumn("k", entries).select(
        "window", "channel", "k.kind", "k.id", F.when(visitor, F.col("stay")).alias("stay"), F.when(visitor, F.col("pages")).alias("pages"),
    )
    per_key = counted.groupBy("window", "channel", "kind", "id").agg(
        F.sum("stay").alias("stay"), F.count("stay").alias("stays"), F.sum("pages").alias("pages"), F.count("pages").alias("paged"),
        F.count(F.when(F.col("pages") == 1, 1)).alias("bounces"),
    )
    known = F.col("id").isNotNull()
    both = per_key.groupBy("window", "channel").agg(
        F.count(F.when((F.col("kind") == "visitor") & known, 1)).alias("uv_count"),
        F.count(F.when((F.col("kind") == "session") & known, 1)).alias("sv_count"),
        *[F.sum(c).alias(c) for c in ("stay", "stays", "pages", "paged", "bounces")],
    )
    return both.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "channel", "uv_count",
        whole_average(F.col("stay"), F.col("stays") * F.lit(1000)).alias("avg_duration_sec"),
        whole_average(F.col("pages"), F.col("paged")).alias("avg_page_count"), "sv_count",
        ratio(F.col("bounces"), F.col("sv_count")).alias("bounce_rate"),
    )


def start_appending(rows: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "1 minute") -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**trigger).start()
    )


class LateRows(StreamingQueryListener):
    """Counts rows that stateful operators dropped behind the watermark, per query, batch and operator, in a table.

    The table has a file per batch that dropped rows, so counts outlive the query; a batch that is run again replaces its
    count. An aggregation counts the groups that a task had made of its late rows, de-duplication counts rows.
    """

    SCHEMA = T.StructType().add("query", T.StringType()).add("batch", T.LongType()).add("operator", T.IntegerType()).add("late", T.LongType())

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.note(str(event.progress.id), event.progress.batchId, [s.numRowsDroppedByWatermark for s in event.progress.stateOperators])

    def note(self, query: str, batch: int, dropped: Sequence[int]) -> None:
        rows = [(query, batch, k, n) for k, n in enumerate(dropped) if n]
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/{query}-{batch}")

    def count(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", True).json(self.path)
