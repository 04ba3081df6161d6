"""Order, payment and finish milestones kept current from the change stream.

``foreachBatch`` calls :func:`facts.fact_trade_flow` on each micro-batch. Batch ``n`` reads what the batches before it
wrote and writes folders of its own number only, so a batch that is run again after a failure changes nothing. It writes
the orders that it touched; every ``fold_every`` batches the open orders are folded into one snapshot, so a batch reads
one snapshot and few small folders and never rewrites orders that nothing happened to.

Topics are ordered per key, not across tables: payments and finishes whose order has not arrived wait for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martline.functions.dates import OPEN_END
from martline.operators import facts
from martline.sources import schemas

#: The tables that carry the three milestones.
ORDERS, PAYMENTS, STATUS = "order_info", "payment_info", "order_status_log"
#: Batches between two snapshots of the open orders.
FOLD_EVERY = 50
#: What milestones are made of, in the changes of any of the three tables.
_DATA = schemas.row(
    "id order_id user_id province_id create_time callback_time payment_status order_status"
    " original_total_amount:d activity_reduce_amount:d coupon_reduce_amount:d total_amount:d"
)
_WAITING = T.StructType().add("table", T.StringType()).add("value", T.StringType())


def _feed(rows: DataFrame, table: str) -> DataFrame:
    """The changes of one table, decoded, with the ``dt`` that the operators look for."""
    body = F.from_json("value", schemas.envelope(schemas.FEED_DATA[table])).alias("e")
    return rows.where(F.col("table") == table).select(body).select("e.*", F.lit(None).cast("string").alias("dt"))


def _decoded(rows: DataFrame) -> DataFrame:
    """Changes ``table, value, order_id`` decoded once for all that reads them; the text is kept of those that may have to wait."""
    body = rows.withColumn("e", F.from_json("value", schemas.envelope(_DATA)))
    return body.select("table", "order_id", F.when(F.col("table") != ORDERS, F.col("value")).alias("value"), "e.type", "e.old",
                       *[F.col(f"e.data.{c}").alias(f"data_{c}") for c in _DATA.fieldNames()])


def _of(rows: DataFrame, table: str) -> DataFrame:
    """The decoded changes of one table in the shape of :func:`_feed`."""
    data = F.struct(*[F.col(f"data_{c}").alias(c) for c in _DATA.fieldNames()])
    return rows.where(F.col("table") == table).select("type", data.alias("data"), "old", F.lit(None).cast("string").alias("dt"))


class OrderFlow:
    """The state of all orders under ``path``: ``flow`` has the orders each batch touched, ``open`` snapshots, ``waiting`` early changes."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_EVERY):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        empty = spark.createDataFrame([], _WAITING)
        self.schema = facts.fact_trade_flow(None, *[_feed(empty, t) for t in (ORDERS, PAYMENTS, STATUS)], None).schema

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").orc(f"{self.path}/{kind}/run={number}", compression="snappy")

    def _read(self, kind: str, schema: T.StructType) -> DataFrame:
        """All batches of one kind with their number ``run``; filters on it prune folders."""
        if not self._exists(kind):
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("run", T.LongType())]))
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.LongType())])).orc(f"{self.path}/{kind}")

    def _exists(self, kind: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _folded(self, number: int) -> int:
        """The batch whose snapshot batch ``number`` starts from; 0 has none and needs none."""
        return (number - 1) // self.fold_every * self.fold_every if number else 0

    def _touched_before(self, number: int) -> DataFrame:
        """Versions of orders that batch ``number`` can see: the snapshot's, and later batches'."""
        base = self._folded(number)
        held = self._read("open", self.schema).where(F.col("run") == base)
        return held.unionByName(self._read("flow", self.schema).where((F.col("run") >= base) & (F.col("run") < number)))

    @staticmethod
    def _newest(versions: DataFrame) -> DataFrame:
        """The last version of each order. A batch has an order once, so versions dealt by the order first are sorted only once."""
        every = F.struct(*versions.columns)
        return versions.groupBy("order_id").agg(F.max_by(every, "run").alias("o")).select("o.*").drop("run")

    def batch(self, rows: DataFrame, number: int) -> None:
        """Target of ``foreachBatch`` for rows ``table, value``, a change as JSON each. Equal rows of a batch count once."""
        waited = self._read("waiting", _WAITING).where(F.col("run") == number - 1).drop("run")
        rows = rows.select("table", "value").unionByName(waited).where(F.col("table").isin(ORDERS, PAYMENTS, STATUS))
        key = F.when(F.col("table") == ORDERS, F.get_json_object("value", "$.data.id")).otherwise(F.get_json_object("value", "$.data.order_id"))
        # Dealt by the order once: equal rows meet there, and the look-ups below move only the orders they look in.
        rows = _decoded(rows.withColumn("order_id", key).repartition("order_id").distinct()).persist()
        try:
            touched = self._touched_before(number)
            before = self._newest(touched.join(rows.select("order_id"), "order_id", "left_semi"))
            # an order that was delivered before is known, open or finished
            fresh = rows.where(F.col("table") == ORDERS).join(touched.select("order_id"), "order_id", "left_anti")
            orders, payments, status = _of(fresh, ORDERS), _of(rows, PAYMENTS), _of(rows, STATUS)
            flow = facts.fact_trade_flow(before.where(F.col("dt") == OPEN_END), orders, payments, status, None)
            self._write(flow, "flow", number)
            done = self._read("flow", self.schema).where(F.col("run") <= number).select("order_id")
            early = rows.where(F.col("table") != ORDERS).join(done, "order_id", "left_anti")
            self._write(early.select("table", "value"), "waiting", number)
            if number and number % self.fold_every == 0:
                written = self._read("flow", self.schema).where(F.col("run") == number)
                still = self._newest(touched.unionByName(written).repartition("order_id"))
                self._write(still.where(F.col("dt") == OPEN_END), "open", number)
        finally:
            rows.unpersist()

    def start(self, changes: DataFrame, checkpoint: str, once: bool = False, interval: str = "1 minute") -> StreamingQuery:
        trigger = {"availableNow": True} if once else {"processingTime": interval}
        return changes.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def current(self, number: int | None = None) -> DataFrame:
        """All orders as of batch ``number``, or now: the open ones and those finished so far."""
        rows = self._read("flow", self.schema)
        rows = rows if number is None else rows.where(F.col("run") <= number)
        return self._newest(rows.repartition("order_id"))
