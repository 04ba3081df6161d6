"""Queries of the streaming operators: the driver tables arrive in batches, files grow, batches are run again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions import changefeed
from martline.plans.scratch import new_folder
from martline.plans.standins import Standins
from martline.sources import files
from martline.streaming import landing, stateful, tail
from martline.streaming.order_flow import ORDERS, PAYMENTS, STATUS, OrderFlow

#: Batches that a table arrives in, and files of the log that grows.
BATCHES, LOGS = 4, 16
HOUR = 3_600_000
#: Bytes of a row group of arriving files, so that a batch of few files is read by many tasks.
GROUP = 8 << 20


def _nth(column: str, low: int, high: int, n: int = BATCHES) -> Column:
    """Which of ``n`` equal spans of time a row is in, from 0."""
    return F.floor((F.col(column) - F.lit(low)) * n / F.lit(high - low + 1)).cast("int")


def _arriving(rows: DataFrame) -> Iterator[tuple[DataFrame, str | None]]:
    """Rows with a batch number ``n`` as a stream that has one batch more each time, with the folder of that batch; once more at the end, without.

    The rows are made once, into files sized from the data; a batch arrives when its folder is moved to where the stream reads.
    """
    spark, made, path = rows.sparkSession, new_folder(rows.sparkSession), new_folder(rows.sparkSession)
    rows.hint("rebalance", "n").write.partitionBy("n").option("parquet.block.size", GROUP).parquet(made)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    store = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder(path))
    stream = spark.readStream.schema(rows.drop("n").schema).option("recursiveFileLookup", True).parquet(path)
    for k in range(BATCHES):
        if store.exists(folder(f"{made}/n={k}")):
            if not store.rename(folder(f"{made}/n={k}"), folder(f"{path}/n={k}")):
                raise OSError(f"{made}/n={k} could not be moved to {path}")
            yield stream, f"{path}/n={k}"
    yield stream, None


def _span(rows: DataFrame, column: str) -> tuple[int, int]:
    low, high = rows.agg(F.min(column), F.max(column)).first()
    return low or 0, high or 0


def first_of_key(t: Standins) -> DataFrame:
    """Every event comes twice, those near the end of a batch once more in the next one, the oldest ones again at the end, too late."""
    events = t.events().select("event_id", "event_type", "day", F.col("ms").alias("ts"))
    low, high = _span(events, "ts")
    span = (high - low + 1) / BATCHES
    own = events.withColumn("n", _nth("ts", low, high))
    late_in_batch = (F.col("ts") + HOUR // 2 - F.lit(low)) / F.lit(span) > F.col("n") + 1
    again = own.where(late_in_batch & (F.col("n") < BATCHES - 1)).withColumn("n", F.col("n") + 1)
    oldest = own.where(F.col("ts") < low + HOUR).withColumn("n", F.lit(BATCHES - 1))
    out, checkpoint = new_folder(t.spark), new_folder(t.spark)
    dropped = 0
    for stream, _ in _arriving(own.union(own).union(again).union(oldest)):
        rows = stream.withColumn("at", stateful.event_time("ts"))
        query = stateful.start_appending(stateful.first_of_key(rows, ["event_id"], "at"), out, checkpoint, once=True)
        query.awaitTermination()
        dropped += sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    kept = t.spark.read.schema("event_id long, event_type string, day string").parquet(out)
    counted = kept.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.union(t.spark.range(1).select(F.lit("late"), F.lit("late"), F.lit(dropped).cast("bigint")))


def channel_traffic(t: Standins) -> DataFrame:
    views = t.page_views()
    out, checkpoint = new_folder(t.spark), new_folder(t.spark)
    for stream, _ in _arriving(views.withColumn("n", _nth("ts", *_span(views, "ts")))):
        rows = stateful.channel_traffic(stream.withColumn("at", stateful.event_time("ts")), "at")
        stateful.start_appending(rows, out, checkpoint, once=True).awaitTermination()
    done = t.spark.read.schema(rows.schema).parquet(out)
    columns = ["channel", "uv_count", "avg_duration_sec", "avg_page_count", "sv_count", "bounce_rate"]
    return done.select(F.date_format("window_start", "yyyy-MM-dd").alias("dt"), *columns)


def order_flow(t: Standins) -> DataFrame:
    """Orders and payments arrive in any order, finishes last; the last batch is run again."""
    feeds = {ORDERS: t.order_feeds(changefeed.INSERT)[1], PAYMENTS: t.payment_feed(changefeed.UPDATE), STATUS: t.status_feed()}
    rows = None
    for table, feed in feeds.items():
        value = F.to_json(F.struct(*[c for c in feed.columns if c != "dt"]))
        part = feed.select(F.lit(table).alias("table"), value.alias("value"))
        n = F.lit(BATCHES - 1) if table == STATUS else F.pmod(F.xxhash64("value"), F.lit(BATCHES - 1))
        part = part.withColumn("n", n.cast("int"))
        rows = part if rows is None else rows.union(part)
    flow, checkpoint = OrderFlow(t.spark, new_folder(t.spark), fold_every=2), new_folder(t.spark)
    last = None
    for stream, folder in _arriving(rows):
        query = flow.start(stream, checkpoint, once=True)
        query.awaitTermination()
        if folder:
            last = folder, query.lastProgress["batchId"]
    if last:
        flow.batch(t.spark.read.schema(rows.drop("n").schema).parquet(last[0]), last[1])
    return flow.current()


def _written_so_far(log: DataFrame, path: str, until: int | None) -> None:
    """A log writer's files: each bucket's lines in time order, up to ``until`` with the first half of the next line, or all.

    A file is written anew under another name and takes the place of the shorter one, so a task can be run again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder)
        open_, half = {}, set()
        for b in batches:
            for bucket, ts, value in zip(*(b.column(c).to_pylist() for c in ("bucket", "ts", "value")), strict=True):
                if bucket not in open_:
                    open_[bucket] = store.open_output_stream(f"{folder}/.new-{bucket}")
                line = value.encode() + b"\n"
                if until is None or ts < until:
                    open_[bucket].write(line)
                elif bucket not in half:
                    half.add(bucket)
                    open_[bucket].write(line[: len(line) // 2])
        for bucket, file in open_.items():
            file.close()
            store.move(f"{folder}/.new-{bucket}", f"{folder}/app.log.{bucket}")
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(open_)], pa.int64())})

    dealt = log.repartition(LOGS, "bucket").sortWithinPartitions("bucket", "ts", "value")
    dealt.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def growing_files(t: Standins) -> DataFrame:
    """The log is tailed while its files grow: once with half-written last lines, once when they are whole."""
    log = t.log()
    value = F.to_json(F.struct(*[c for c in log.columns if c != "dt"]))
    lines = log.select("ts", value.alias("value")).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(LOGS)))
    low, high = _span(lines, "ts")
    path, out, checkpoint = (new_folder(t.spark) for _n in range(3))
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    for until in ((low + high) // 2, None, None):
        _written_so_far(lines, uri, until)
        topic = tail.tail_growing_files(t.spark, uri, "app.log.*", split_bytes=1 << 20)
        landing.land_log_stream(topic.select("value"), out, checkpoint, zone="UTC", once=True).awaitTermination()
    return files.read_log_json(t.spark, out, None)


QUERIES: dict[str, Callable[[Standins], DataFrame]] = {
    "t1_first_of_key_stream": first_of_key,
    "t2_channel_traffic_stream": channel_traffic,
    "t3_order_flow_stream": order_flow,
}
