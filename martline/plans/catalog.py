"""One query per operator, over the whole driver tables.

A query that lands or writes a table does so in a new scratch folder and returns what reads back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions import changefeed
from martline.functions.dates import shift, window_start
from martline.operators import dims, facts, reports, rollups, scd2, sinks, sketches
from martline.plans import streams
from martline.plans.scratch import new_folder
from martline.plans.standins import EVENT_DAY, ORDER_DAY, Standins
from martline.sources import files, schemas
from martline.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ED, OD = EVENT_DAY, ORDER_DAY


def _query(name: str) -> Callable[[Callable[[Standins], DataFrame]], Callable[[Standins], DataFrame]]:
    def register(build: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Standins(spark, sf_dir))
        return build

    return register


# Sources


def _land_json(df: DataFrame, path: str, *folders: str) -> None:
    """JSON lines in gzip, in the folders a landing job would make."""
    body = [c for c in df.columns if c not in folders]
    lines = df.select(F.to_json(F.struct(*body)).alias("value"), *folders)
    lines.hint("rebalance", *folders).write.partitionBy(*folders).text(path, compression="gzip")


def _flat_log(log: DataFrame) -> DataFrame:
    return log.select(
        "dt", "ts", F.col("common.mid").alias("mid_id"), F.col("common.uid").alias("user_id"),
        F.col("common.sid").alias("session_id"), F.col("page.page_id").alias("page_id"),
        F.col("page.during_time").alias("during_time"), F.size("actions").alias("actions"),
        F.size("displays").alias("displays"), F.col("start.loading_time").alias("loading_time"),
        F.col("err.msg").alias("error"),
    )


@_query("s1_read_log_json")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    _land_json(t.log(), path, "dt")
    return _flat_log(files.read_log_json(t.spark, path, None))


@_query("s2_read_snapshot_tsv")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    source = t.sku_sources()["sku"].withColumn("is_sale", F.when(F.col("is_sale") == "1", "1").otherwise(""))
    schema = schemas.SNAPSHOTS["sku_info"]
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in source.columns]
    files.write_snapshot_tsv(source.select("*", *missing).select(*schema.fieldNames()), path, OD)
    rows = files.read_snapshot_tsv(t.spark, path, schema, OD)
    return rows.select("id", "spu_id", "price", "sku_name", "weight", "tm_id", "category3_id", "sku_default_img",
                       "is_sale", "create_time", "dt")


def _flat_feed(feed: DataFrame) -> DataFrame:
    return feed.select(
        "type", "ts", "data.id", "data.user_id", "data.sku_num", "data.create_time", "data.is_ordered",
        F.col("old")["sku_num"].alias("old_num"), "dt",
    )


@_query("s3_read_change_feed")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    _land_json(t.cart_feed(), path, "dt")
    return _flat_feed(files.read_change_feed(t.spark, path, schemas.FEED_DATA["cart_info"], None))


@_query("s4_load_partition")
def _(t: Standins) -> DataFrame:
    landed, table = new_folder(t.spark), new_folder(t.spark)
    _land_json(t.log(), landed, "dt")
    for _again in range(2):
        sinks.load_partition(files.read_log_json(t.spark, landed, ED), table, ED)
    return _flat_log(files.read_table(t.spark, table))


def _topic(t: Standins) -> DataFrame:
    """The event table as a stream of JSON documents."""
    source = t.table("events")
    stream = t.spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(t.dir)
    body = F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("mid")).alias("common"),
        F.struct(F.col("event_type").alias("page_id")).alias("page"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
    ))
    return stream.select(body.alias("value"))


@_query("s5_land_log_stream")
def _(t: Standins) -> DataFrame:
    path, checkpoint = new_folder(t.spark), new_folder(t.spark)
    for _again in range(2):
        landing.land_log_stream(_topic(t), path, checkpoint, once=True).awaitTermination()
    log = files.read_log_json(t.spark, path, None)
    return log.select("dt", "ts", F.col("common.mid").alias("mid_id"), F.col("page.page_id").alias("page_id"))


@_query("s6_land_change_stream")
def _(t: Standins) -> DataFrame:
    path, checkpoint = new_folder(t.spark), new_folder(t.spark)
    source = t.table("events")
    stream = t.spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(t.dir)
    kind = F.col("event_type")
    body = F.to_json(F.struct(
        F.when(kind.isin("click", "view"), "cart_info").otherwise("user_info").alias("table"),
        F.when(kind == "click", "insert").otherwise("update").alias("type"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
        F.struct(
            F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id")
        ).alias("data"),
    ))
    topic = stream.select(body.alias("value"))
    landing.land_change_stream(topic, path, checkpoint, zone="UTC", once=True).awaitTermination()
    feeds = [
        files.read_change_feed(t.spark, path, schemas.FEED_DATA[name], None, table=name)
        .select(F.lit(name).alias("feed"), "type", "ts", "data.id", "dt")
        for name in ("cart_info", "user_info")
    ]
    return feeds[0].unionByName(feeds[1])


@_query("s7_tail_files_stream")
def _(t: Standins) -> DataFrame:
    path, out, checkpoint = (new_folder(t.spark) for _n in range(3))
    log = t.log()
    log.select(F.to_json(F.struct(*[c for c in log.columns if c != "dt"])).alias("value")).write.text(path)
    for _again in range(2):
        lines = landing.tail_files_stream(t.spark, path, "part-*")
        landing.land_log_stream(lines, out, checkpoint, zone="UTC", once=True).awaitTermination()
    return _flat_log(files.read_log_json(t.spark, out, None))


@_query("s7_tail_growing_files")
def _(t: Standins) -> DataFrame:
    return _flat_log(streams.growing_files(t))


@_query("s9_bootstrap_vs_incremental")
def _(t: Standins) -> DataFrame:
    feed = t.favor_feed().unionByName(
        t.favor_feed().withColumn("type", F.lit(changefeed.BOOTSTRAP)).withColumn("dt", F.lit("2023-12-31"))
    )
    first = changefeed.bootstrap_vs_incremental(feed, True).groupBy("type", "dt").count()
    later = changefeed.bootstrap_vs_incremental(feed, False).groupBy("type", "dt").count()
    return first.unionByName(later).withColumnRenamed("count", "row_count")


def _calendar(t: Standins) -> DataFrame:
    bounds = t.table("orders").agg(
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day")
    )
    return dims.calendar_days(bounds)


@_query("s10_load_calendar")
def _(t: Standins) -> DataFrame:
    landed, table = new_folder(t.spark), new_folder(t.spark)
    sinks.tsv_table(_calendar(t).na.fill(""), landed)
    sinks.columnar_table(files.load_calendar(t.spark, landed), table)
    return files.read_table(t.spark, table)


# Sinks


def _daily_counts(t: Standins, factor: int = 1) -> DataFrame:
    return t.events().groupBy(F.col("day").alias("dt"), "event_type").agg(
        (F.count(F.lit(1)) * factor).alias("n")
    )


@_query("k1_overwrite_partition")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    sinks.overwrite_dynamic(_daily_counts(t), path)
    second = _daily_counts(t, 2).where(F.col("dt") == ED)
    for _again in range(2):
        sinks.overwrite_partition(second, path, ED)
    sinks.overwrite_partition(second.where(F.lit(False)), path, shift(ED, -1))
    return files.read_table(t.spark, path)


@_query("k2_overwrite_dynamic")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    sinks.overwrite_dynamic(_daily_counts(t), path)
    sinks.overwrite_dynamic(_daily_counts(t, 3).where(F.col("dt") >= window_start(ED, 7)), path)
    return files.read_table(t.spark, path)


@_query("k3_accumulate_report")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    for day, factor in ((shift(ED, -1), 1), (ED, 1), (ED, 5)):
        sinks.accumulate_report(_daily_counts(t, factor).where(F.col("dt") == day), path, day)
    return files.read_table(t.spark, path)


@_query("k3_accumulate_distinct")
def _(t: Standins) -> DataFrame:
    old = _daily_counts(t).where(F.col("dt") < ED)
    new = _daily_counts(t).where(F.col("dt") >= shift(ED, -1))
    return sinks.accumulate_distinct(old, new)


@_query("k5_columnar_table")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    sinks.columnar_table(t.events().select("event_id", "user_id", "event_type", "k", "day"), path)
    return files.read_table(t.spark, path)


@_query("k6_tsv_table")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    sinks.tsv_table(t.events().select("event_id", "user_id", "event_type", F.nullif("k", F.lit(0)).alias("k")), path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, k bigint")
    return sinks.read_tsv_table(t.spark, path, schema)


def _odd_text(t: Standins) -> DataFrame:
    """Events with a text that a table of lines must not change: padded, with tabs, line ends and backslashes, empty, NULL."""
    kind, odd = F.col("event_type"), F.col("k") % 8
    texts = [
        F.concat(F.lit("  "), kind, F.lit(" ")), F.concat(kind, F.lit("\t"), kind), F.concat(kind, F.lit("\n"), kind),
        F.concat(F.lit("\\"), kind, F.lit("\\t\\\\")), F.lit(""), F.lit("\\N"), F.concat(F.lit("\r\n\t\\"), kind),
    ]
    value = F.lit(None).cast("string")
    for k, text in enumerate(texts):
        value = F.when(odd == k, text).otherwise(value)
    return t.events().select("event_id", value.alias("text"), "event_type")


@_query("k6_tsv_table_texts")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    rows = _odd_text(t)
    sinks.tsv_table(rows, path)
    return sinks.read_tsv_table(t.spark, path, rows.schema)


@_query("s2_read_snapshot_tsv_texts")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    rows = _odd_text(t)
    files.write_snapshot_tsv(rows, path, ED)
    return files.read_snapshot_tsv(t.spark, path, rows.schema, ED)


@_query("k7_check_partition")
def _(t: Standins) -> DataFrame:
    path = new_folder(t.spark)
    sinks.overwrite_dynamic(_daily_counts(t), path)
    sinks.check_partition(t.spark, path, ED)
    return sinks.partition_counts(files.read_table(t.spark, path))


# Dimensions


@_query("d1_dim_sku")
def _(t: Standins) -> DataFrame:
    rows = dims.dim_sku(**t.sku_sources(), day=OD)

    def listed(column: str, fields: list[str]) -> F.Column:
        text = F.transform(column, lambda a: F.concat_ws(":", *[a[f] for f in fields]))
        return F.array_join(text, ",").alias(column)

    return rows.select(
        *[c for c in rows.columns if not c.endswith("_values")],
        listed("sku_attr_values", ["attr_id", "value_id", "attr_name", "value_name"]),
        listed("sku_sale_attr_values",
               ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"]),
    )


@_query("d2_dim_coupon")
def _(t: Standins) -> DataFrame:
    rows = dims.dim_coupon(t.coupon_info(), t.dictionary_of_regions(), OD)
    return rows.select(
        "id", "coupon_name", "coupon_type_code", "coupon_type_name", "condition_amount", "condition_num",
        "benefit_amount", "benefit_discount", "benefit_rule", "range_type_code", "range_type_name", "limit_num",
        "taken_count", "dt",
    )


@_query("d3_dim_activity")
def _(t: Standins) -> DataFrame:
    rows = dims.dim_activity(t.activity_rule(), t.activity_info(), t.dictionary_of_regions(), OD)
    return rows.drop("start_time", "end_time", "create_time")


@_query("d4_dim_province")
def _(t: Standins) -> DataFrame:
    return dims.dim_province(t.base_province(), t.base_region(), OD)


@_query("d5_dim_promotion_pos")
def _(t: Standins) -> DataFrame:
    return dims.dim_promotion_pos(t.promotion_pos(), OD).select("id", "pos_location", "pos_type", "dt")


@_query("d6_dim_promotion_refer")
def _(t: Standins) -> DataFrame:
    return dims.dim_promotion_refer(t.promotion_refer(), OD).select("id", "refer_name", "dt")


@_query("d7_dim_date")
def _(t: Standins) -> DataFrame:
    return dims.dim_date(_calendar(t)).drop("holiday_id")


def _user_changes(t: Standins, day: str) -> DataFrame:
    return scd2.scd2_changes(t.user_feed(), day, ["id", "name", "user_level"])


def _zipper(t: Standins) -> DataFrame:
    """Two days of changes merged and stored one after the other, as daily runs do, and the history after them."""
    path, open_rows = new_folder(t.spark), t.user_open()
    for day in (shift(ED, -1), ED):
        sinks.write_version(scd2.scd2_merged(open_rows, _user_changes(t, day), day), path, day)
        open_rows = scd2.scd2_current(sinks.read_version(t.spark, path, day, t.user_open().schema))
    return sinks.read_history(t.spark, path, ED, t.user_open().schema)


@_query("d8a_scd2_init")
def _(t: Standins) -> DataFrame:
    return scd2.scd2_init(t.user_boot(), ED, ["id", "name", "user_level"])


@_query("d8b_scd2_merge")
def _(t: Standins) -> DataFrame:
    open_rows, closed = scd2.scd2_merge(t.user_open(), _user_changes(t, ED), ED)
    return open_rows.unionByName(closed)


@_query("d8b_scd2_merge_in_transactions")
def _(t: Standins) -> DataFrame:
    changes = scd2.scd2_changes(t.user_transactions(), ED, ["id", "name", "user_level"])
    return scd2.scd2_merged(t.user_open(), changes, ED)


@_query("d8c_scd2_current")
def _(t: Standins) -> DataFrame:
    return scd2.scd2_current(_zipper(t)).select("id", "name", "user_level", "start_date")


@_query("d8c_scd2_as_of")
def _(t: Standins) -> DataFrame:
    return scd2.scd2_as_of(_zipper(t), shift(ED, -1)).select("id", "name", "user_level", "start_date", "end_date")


@_query("d8c_scd2_join_as_of")
def _(t: Standins) -> DataFrame:
    views = t.page_views().select("user_id", "page_id", F.col("dt").alias("day"))
    rows = scd2.scd2_join_as_of(views, _zipper(t), "user_id", "day")
    return rows.groupBy("day", "user_level").agg(F.count(F.lit(1)).alias("n"))


@_query("d9_decode_dictionary")
def _(t: Standins) -> DataFrame:
    return dims.decode_dictionary(
        t.priority_codes(), t.dictionary(), "payment_type_code", dims.PAY_TYPE, "payment_type_name"
    )


# Facts


@_query("f1_fact_cart_add")
def _(t: Standins) -> DataFrame:
    return facts.fact_cart_add(t.cart_feed(), ED)


@_query("f1_fact_cart_add_first_day")
def _(t: Standins) -> DataFrame:
    boot = t.cart_feed().withColumn("type", F.lit(changefeed.BOOTSTRAP)).withColumn("dt", F.lit(ED))
    return facts.fact_cart_add(boot, ED, first_day=True)


@_query("f2_fact_order_detail")
def _(t: Standins) -> DataFrame:
    return facts.fact_order_detail(*t.order_feeds(changefeed.INSERT), OD)


@_query("f2_fact_order_detail_first_day")
def _(t: Standins) -> DataFrame:
    return facts.fact_order_detail(*t.order_feeds(changefeed.BOOTSTRAP), OD, first_day=True)


@_query("f3_fact_payment_success")
def _(t: Standins) -> DataFrame:
    return facts.fact_payment_success(
        *t.order_feeds(changefeed.INSERT), t.payment_feed(changefeed.UPDATE),
        t.dictionary(), OD,
    )


@_query("f3_fact_payment_success_first_day")
def _(t: Standins) -> DataFrame:
    kind = changefeed.BOOTSTRAP
    return facts.fact_payment_success(
        *t.order_feeds(kind), t.payment_feed(kind), t.dictionary(), OD, first_day=True, allocate=True
    )


@_query("f4_fact_cart_snapshot")
def _(t: Standins) -> DataFrame:
    return facts.fact_cart_snapshot(t.carts(), OD)


def _flow(t: Standins, deliveries: int = 1) -> DataFrame:
    headers = t.order_feeds(changefeed.INSERT)[1]
    for _again in range(deliveries - 1):
        headers = headers.unionByName(headers)
    payments = t.payment_feed(changefeed.UPDATE)
    finished = t.status_feed()
    return facts.fact_trade_flow(t.flow_open(OD), headers, payments, finished, OD)


@_query("f5_fact_trade_flow")
def _(t: Standins) -> DataFrame:
    return _flow(t)


@_query("f5_fact_trade_flow_repeated_inserts")
def _(t: Standins) -> DataFrame:
    return _flow(t, deliveries=2)


@_query("f5_fact_trade_flow_first_day")
def _(t: Standins) -> DataFrame:
    kind = changefeed.BOOTSTRAP
    return facts.fact_trade_flow(
        None, t.order_feeds(kind)[1], t.payment_feed(kind), t.status_feed(kind), OD, first_day=True
    )


@_query("f6_fact_coupon_used")
def _(t: Standins) -> DataFrame:
    return facts.fact_coupon_used(t.coupon_use_feed(changefeed.UPDATE), OD)


@_query("f6_fact_coupon_used_first_day")
def _(t: Standins) -> DataFrame:
    return facts.fact_coupon_used(t.coupon_use_feed(changefeed.BOOTSTRAP), OD, first_day=True)


@_query("f7_fact_favor_add")
def _(t: Standins) -> DataFrame:
    return facts.fact_favor_add(t.favor_feed(), ED)


@_query("f8_fact_page_view")
def _(t: Standins) -> DataFrame:
    rows = facts.fact_page_view(t.log(), None)
    return rows.drop("last_page_id", "from_pos_id", "from_pos_seq", "refer_id")


@_query("f9_fact_register")
def _(t: Standins) -> DataFrame:
    return facts.fact_register(t.register_feed(), t.log(), ED)


@_query("f9_fact_register_dedup")
def _(t: Standins) -> DataFrame:
    return facts.fact_register(t.register_feed(), t.log(), ED, dedup=True)


@_query("f10_fact_login")
def _(t: Standins) -> DataFrame:
    return facts.fact_login(t.log(), None)


@_query("f11_field_changed")
def _(t: Standins) -> DataFrame:
    rows = changefeed.field_changed(t.cart_feed(), "sku_num")
    return rows.select("dt", "data.id", F.col("old")["sku_num"].alias("old_num"), "data.sku_num")


@_query("f12_latest_change")
def _(t: Standins) -> DataFrame:
    return changefeed.latest_change(t.user_feed()).select("ts", "data.*")


@_query("f12_latest_change_in_transactions")
def _(t: Standins) -> DataFrame:
    return changefeed.latest_change(t.user_transactions()).select("ts", "data.*")


@_query("f13_explode_actions")
def _(t: Standins) -> DataFrame:
    return facts.explode_actions(t.log(), None, "UTC")


@_query("f14_explode_displays")
def _(t: Standins) -> DataFrame:
    return facts.explode_displays(t.log(), None, "UTC")


@_query("f15_start_events")
def _(t: Standins) -> DataFrame:
    return facts.start_events(t.log(), None, "UTC")


@_query("f16_error_events")
def _(t: Standins) -> DataFrame:
    return facts.error_events(t.log(), None, "UTC")


# Summaries


def _month_of_lines(t: Standins, province: bool = False) -> DataFrame:
    """Order lines of the longest report window; the range reaches the scan."""
    return t.order_detail(window_start(OD, 30), OD, province)


@_query("a1_user_sku_order_1d")
def _(t: Standins) -> DataFrame:
    return rollups.user_sku_order_1d(t.order_detail(), t.sku(), OD)


@_query("a1_user_sku_order_1d_first_day")
def _(t: Standins) -> DataFrame:
    return rollups.user_sku_order_1d(t.order_detail(), t.sku(), None, dim_day=OD)


@_query("a2_user_order_1d")
def _(t: Standins) -> DataFrame:
    return rollups.user_order_1d(t.order_detail(), OD)


@_query("a2_user_order_1d_first_day")
def _(t: Standins) -> DataFrame:
    return rollups.user_order_1d(t.order_detail(), None)


@_query("a3_user_cart_add_1d")
def _(t: Standins) -> DataFrame:
    return rollups.user_cart_add_1d(t.cart_adds(), None)


@_query("a4_user_payment_1d")
def _(t: Standins) -> DataFrame:
    return rollups.user_payment_1d(t.payments(), None)


@_query("a5_province_order_1d")
def _(t: Standins) -> DataFrame:
    return rollups.province_order_1d(t.order_detail(province=True), t.province(), OD)


@_query("a5_province_order_1d_first_day")
def _(t: Standins) -> DataFrame:
    return rollups.province_order_1d(t.order_detail(province=True), t.province(), None, dim_day=OD)


@_query("a6_user_coupon_used_1d")
def _(t: Standins) -> DataFrame:
    return rollups.user_coupon_used_1d(t.coupon_used(), t.coupon(), None, dim_day=OD)


@_query("a7_sku_favor_add_1d")
def _(t: Standins) -> DataFrame:
    return rollups.sku_favor_add_1d(t.favors(), t.sku(ED), None, dim_day=ED)


@_query("a8_session_page_view_1d")
def _(t: Standins) -> DataFrame:
    return rollups.session_page_view_1d(t.page_views(), None)


@_query("a9_visitor_page_view_1d")
def _(t: Standins) -> DataFrame:
    return rollups.visitor_page_view_1d(t.page_views(), None)


def _user_sku_1d(t: Standins) -> DataFrame:
    return rollups.user_sku_order_1d(_month_of_lines(t), t.sku(), None, dim_day=OD)


def _province_1d(t: Standins) -> DataFrame:
    return rollups.province_order_1d(_month_of_lines(t, True), t.province(), None, dim_day=OD)


@_query("a10_user_sku_order_nd")
def _(t: Standins) -> DataFrame:
    return rollups.user_sku_order_nd(_user_sku_1d(t), OD)


@_query("a11_province_order_nd")
def _(t: Standins) -> DataFrame:
    return rollups.province_order_nd(_province_1d(t), OD)


def _user_order_td(t: Standins) -> DataFrame:
    before = rollups.user_order_td_init(
        rollups.user_order_1d(t.order_detail(last=shift(OD, -1)), None), shift(OD, -1)
    )
    return rollups.user_order_td(before, rollups.user_order_1d(t.order_detail(), OD), OD)


@_query("a12_user_order_td")
def _(t: Standins) -> DataFrame:
    return _user_order_td(t)


@_query("a12_user_order_td_first_day")
def _(t: Standins) -> DataFrame:
    return rollups.user_order_td_init(rollups.user_order_1d(t.order_detail(last=OD), None), OD)


def _login_td(t: Standins, day: str) -> DataFrame:
    return rollups.user_login_td_init(t.logins(), t.logins(), day)


@_query("a13_user_login_td")
def _(t: Standins) -> DataFrame:
    return rollups.user_login_td(_login_td(t, shift(ED, -1)), t.logins(), ED)


@_query("a13_user_login_td_first_day")
def _(t: Standins) -> DataFrame:
    return _login_td(t, ED)


@_query("a14_rolling")
def _(t: Standins) -> DataFrame:
    one_day = rollups.visitor_page_view_1d(t.page_views(), None)
    return rollups.rolling(
        one_day, ED, ["mid_id", "page_id"], ["during_time_1d", "view_count_1d"], windows=(3, 7, 14, 30)
    )


@_query("a14_moving_total")
def _(t: Standins) -> DataFrame:
    """The last of ten days, each made from the day before; one of the days in between is corrected afterwards."""
    keys, measures, length = ["mid_id", "page_id"], ["during_time_1d", "view_count_1d"], 7
    path = new_folder(t.spark)
    sinks.overwrite_dynamic(rollups.visitor_page_view_1d(t.page_views(), None), path)
    one_day = files.read_table(t.spark, path)
    days = [shift(ED, k) for k in range(-9, 1)]
    wrong = days[-4]
    first = rollups.moving_start(one_day, days[0], keys, measures, length)
    state = t.spark.read.schema(first.schema).parquet(_stored(first))
    for day in days[1:]:
        entering = one_day.where(F.col("dt") == day)
        if day == wrong:  # this day was built from a third of its rows
            entering = entering.where(F.pmod(F.xxhash64("mid_id"), F.lit(3)) == 0)
        leaving = one_day.where(F.col("dt") == shift(day, -length))
        state = t.spark.read.schema(state.schema).parquet(_stored(rollups.moving_next(state, entering, leaving, keys, measures)))
    rows = one_day.where(F.col("dt") == wrong)
    state = rollups.moving_corrected(state, rows.where(F.pmod(F.xxhash64("mid_id"), F.lit(3)) == 0), rows, keys, measures)
    return rollups.moving_rows(state, ED, measures, length)


def _stored(rows: DataFrame) -> str:
    path = new_folder(rows.sparkSession)
    rows.write.parquet(path)
    return path


@_query("a15_to_date")
def _(t: Standins) -> DataFrame:
    one_day = rollups.user_cart_add_1d(t.cart_adds(), None).select(
        "user_id", F.col("dt").alias("first_day"), F.col("dt").alias("last_day"), "cart_add_count_1d",
        "cart_add_num_1d", "dt",
    )
    totals = ["cart_add_count_1d", "cart_add_num_1d"]
    return rollups.to_date(
        one_day.where(F.col("dt") < ED), one_day.where(F.col("dt") == ED), "user_id", "first_day", "last_day", totals
    )


# Reports


def _sessions(t: Standins) -> DataFrame:
    return rollups.session_page_view_1d(t.page_views(), None)


@_query("p1_traffic_by_channel")
def _(t: Standins) -> DataFrame:
    return reports.traffic_by_channel(_sessions(t), ED)


@_query("p1_distinct_from_sketches")
def _(t: Standins) -> DataFrame:
    """Visitors and sessions per channel and window, and whether the sketches' counts lie within four standard errors."""
    path, kept = new_folder(t.spark), ["mid_id", "session_id"]
    sinks.overwrite_dynamic(sketches.daily_sketches(_sessions(t), None, ["channel"], kept), path)
    near = sketches.distinct_in_windows(files.read_table(t.spark, path), ED, ["channel"], kept)
    exact = reports.traffic_by_channel(_sessions(t), ED).select("dt", "recent_days", "channel", "uv_count", "sv_count")
    bound = 4 * sketches.standard_error()

    def close(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.ceil(F.col(count) * bound)

    both = exact.join(near, ["dt", "recent_days", "channel"], "left")
    return both.select("dt", "recent_days", "channel", "uv_count", "sv_count", close("mid_id_count", "uv_count").alias("uv_close"), close("session_id_count", "sv_count").alias("sv_close"))


@_query("p2_page_path")
def _(t: Standins) -> DataFrame:
    return reports.page_path(t.page_views(), ED)


@_query("p2_page_path_all_days")
def _(t: Standins) -> DataFrame:
    return reports.page_path(t.page_views(), None)


@_query("p3_user_change")
def _(t: Standins) -> DataFrame:
    both = _login_td(t, shift(ED, -1)).unionByName(_login_td(t, ED))
    return reports.user_change(both, ED)


@_query("p4_user_retention")
def _(t: Standins) -> DataFrame:
    return reports.user_retention(_login_td(t, ED), ED)


@_query("p5_user_stats")
def _(t: Standins) -> DataFrame:
    return reports.user_stats(_login_td(t, ED), ED)


@_query("p6_user_action")
def _(t: Standins) -> DataFrame:
    return reports.user_action(
        rollups.visitor_page_view_1d(t.page_views(), ED), rollups.user_cart_add_1d(t.cart_adds(), ED),
        rollups.user_order_1d(t.event_orders(), ED),
        rollups.user_payment_1d(t.event_orders().where(F.col("split_total_amount") >= 20), ED), ED,
    )


@_query("p7_new_order_user_stats")
def _(t: Standins) -> DataFrame:
    return reports.new_order_user_stats(_user_order_td(t), OD)


@_query("p8_order_continuously_user_count")
def _(t: Standins) -> DataFrame:
    return reports.order_continuously_user_count(rollups.user_order_1d(t.event_orders(), None), ED)


@_query("p8_order_continuously_user_count_span_90")
def _(t: Standins) -> DataFrame:
    return reports.order_continuously_user_count(rollups.user_order_1d(t.event_orders(), None), ED, run=4, span=90)


@_query("p9_repeat_purchase_by_tm")
def _(t: Standins) -> DataFrame:
    return reports.repeat_purchase_by_tm(rollups.user_sku_order_nd(_user_sku_1d(t), OD), OD)


def _sku_summaries(t: Standins) -> tuple[DataFrame, DataFrame]:
    one_day = _user_sku_1d(t)
    return one_day, rollups.user_sku_order_nd(one_day, OD)


@_query("p10_order_stats_by_tm")
def _(t: Standins) -> DataFrame:
    return reports.order_stats_by_tm(*_sku_summaries(t), OD)


@_query("p11_order_stats_by_cate")
def _(t: Standins) -> DataFrame:
    return reports.order_stats_by_cate(*_sku_summaries(t), OD)


@_query("p12_order_by_province")
def _(t: Standins) -> DataFrame:
    one_day = _province_1d(t)
    return reports.order_by_province(one_day, rollups.province_order_nd(one_day, OD), OD)


@_query("p13_coupon_stats")
def _(t: Standins) -> DataFrame:
    return reports.coupon_stats(rollups.user_coupon_used_1d(t.coupon_used(), t.coupon(), OD), OD)


@_query("p14_cart_num_top3_by_cate")
def _(t: Standins) -> DataFrame:
    return reports.cart_num_top3_by_cate(facts.fact_cart_snapshot(t.carts(), OD), t.sku(), OD)


@_query("p15_favor_count_top3_by_tm")
def _(t: Standins) -> DataFrame:
    return reports.favor_count_top3_by_tm(rollups.sku_favor_add_1d(t.favors(), t.sku(ED), ED), ED)


@_query("p16_order_to_pay_interval_avg")
def _(t: Standins) -> DataFrame:
    return reports.order_to_pay_interval_avg(_flow(t), OD)


@_query("p17_order_stats_by_tm_direct")
def _(t: Standins) -> DataFrame:
    return reports.order_stats_by_tm_direct(_month_of_lines(t), t.sku(), OD)


@_query("p18_order_stats_by_tm_nd")
def _(t: Standins) -> DataFrame:
    return reports.order_stats_by_tm_nd(*_sku_summaries(t), OD)


@_query("p19_order_stats_by_cate_nd")
def _(t: Standins) -> DataFrame:
    return reports.order_stats_by_cate_nd(*_sku_summaries(t), OD)


@_query("p20_new_order_user_direct")
def _(t: Standins) -> DataFrame:
    return reports.new_order_user_direct(t.order_detail(last=OD), OD)


@_query("p21_weekly_traffic")
def _(t: Standins) -> DataFrame:
    return reports.weekly_traffic(_sessions(t), ED)


@_query("p22_monthly_traffic")
def _(t: Standins) -> DataFrame:
    return reports.monthly_traffic(_sessions(t), ED)


# Streams

for _name, _build in streams.QUERIES.items():
    _query(_name)(_build)
