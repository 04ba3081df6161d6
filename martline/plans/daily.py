"""A whole day from landed files to report tables, as plain function calls.

A written table lies between two layers, so each step starts from stored columns with known sizes, and any step or
day can be run again with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.dates import OPEN_END, shift
from martline.operators import dims, facts, reports, rollups, scd2, sinks
from martline.sources import files, jdbc, schemas

USER_ZIP = schemas.row(" ".join([*scd2.USER_COLUMNS, "start_date", "end_date", "dt"]))
TRADE_FLOW = schemas.row(
    "order_id user_id province_id order_date_id order_time payment_date_id payment_time finish_date_id finish_time"
    " order_original_amount:d order_activity_amount:d order_coupon_amount:d order_total_amount:d payment_amount:d dt"
)

GROWING_TABLES = ("cart_info", "sku_info", "sku_attr_value", "sku_sale_attr_value", "spu_info", "coupon_info")


class Warehouse:
    """Tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.split('_', 1)[0]}/{table}"

    def read(self, table: str) -> DataFrame:
        return files.read_table(self.spark, self.path(table))

    def feed(self, name: str) -> DataFrame:
        return self._typed(f"ods_{name}_inc", schemas.envelope(schemas.FEED_DATA[name], position=True))

    def snapshot(self, name: str) -> DataFrame:
        return self._typed(f"ods_{name}_full", schemas.SNAPSHOTS[name])

    def log(self) -> DataFrame:
        return self._typed("ods_log_inc", schemas.LOG)

    def _typed(self, table: str, schema: T.StructType) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField("dt", T.StringType())])
        return files.read_table(self.spark, self.path(table), schema)

    def put(self, table: str, df: DataFrame, day: str, spread: bool = False) -> None:
        """Store one day, or with ``spread`` every day that occurs in the rows.

        What must not occur in the table's rows is counted as they are written and ends the run.
        """
        counted, verify = sinks.watched(df, f"{table} on {day}", must_not(table, df.columns))
        if spread:
            # An empty run day first: it leaves the table readable even when no day has a row.
            sinks.overwrite_partition(df.where(F.lit(False)), self.path(table), day)
            sinks.overwrite_dynamic(counted, self.path(table))
        else:
            sinks.overwrite_partition(counted, self.path(table), day)
        verify()


#: Columns of a stored table that every row must fill. Times and amounts that could not be read are NULL.
FILLED = {
    "dwd_trade_cart_add_inc": ["date_id", "sku_num"],
    "dwd_trade_order_detail_inc": ["order_id", "split_total_amount"],
    "dwd_trade_pay_detail_suc_inc": ["date_id", "split_payment_amount"],
    "dwd_tool_coupon_used_inc": ["date_id"],
    "dwd_traffic_page_view_inc": ["view_time"],
    "dwd_user_login_inc": ["login_time"],
    "dws_trade_user_order_1d": ["order_total_amount_1d"],
}


def must_not(table: str, columns: Sequence[str]) -> dict[str, Column]:
    """What must not hold for any row of a table, by what it says."""
    rules = {f"rows without {c}": F.col(c).isNull() for c in FILLED.get(table, ())}
    if {"order_user_count", "order_count"} <= set(columns):
        rules["more buyers than orders"] = F.col("order_user_count") > F.col("order_count")
    if {"retention_count", "new_user_count"} <= set(columns):
        rules["more users retained than new"] = F.col("retention_count") > F.col("new_user_count")
    return rules


def run_day(w: Warehouse, landed: str, day: str, first_day: bool = False) -> None:
    """All layers of one day; ``first_day`` loads the bootstrap copy and spreads it over its own days.

    Each layer is checked before the next one is built on it; a failed check ends the run with its reason.
    """
    check_landed(w, landed)
    load_raw(w, landed, day)
    build_dimensions(w, day, first_day)
    check_dimensions(w, day)
    build_facts(w, day, first_day)
    check_facts(w, day)
    build_summaries(w, day, first_day)
    build_reports(w, day)
    check_reports(w, day)


def check_dimensions(w: Warehouse, day: str) -> None:
    """Users have one open version each, and no version begins before the last one ended."""
    users = sinks.read_version(w.spark, w.path("dim_user_zip"), day, USER_ZIP)
    sinks.check_none(sinks.repeated_keys(scd2.scd2_current(users), "id"), f"users with several open versions on {day}")
    sinks.check_none(sinks.overlapping_versions(users, "id"), f"overlapping versions of a user on {day}")


def check_facts(w: Warehouse, day: str) -> None:
    """An order is open once."""
    flow = sinks.read_version(w.spark, w.path("dwd_trade_trade_flow_acc"), day, TRADE_FLOW)
    open_rows = flow.where(F.col("dt") == F.lit(OPEN_END)).where(F.col("order_id").isNotNull())
    sinks.check_none(sinks.repeated_keys(open_rows, "order_id"), f"orders open several times on {day}")


def check_reports(w: Warehouse, day: str) -> None:
    """Of a day's new users no more come back than there were."""
    kept = w.read("ads_user_retention").where(F.col("dt") == F.lit(day))
    sinks.check_none(kept.where(F.col("retention_count") > F.col("new_user_count")), f"more users retained than new on {day}")


def check_landed(w: Warehouse, landed: str) -> None:
    """Landed rows without a readable time are in no day. They have a folder of their own, so no other one is read."""
    rows = w.spark.read.schema("value string, dt string").text(f"{landed.rstrip('/')}/log")
    sinks.check_none(sinks.unreadable_rows(rows), "log rows without a readable time")


def import_full(
    spark: SparkSession,
    url: str,
    landed: str,
    day: str,
    properties: dict[str, str] | None = None,
    read: Callable[..., DataFrame] = jdbc.import_jdbc_full,
    bounds: Callable[..., tuple[int, int]] = jdbc.key_bounds,
    max_connections: int = 32,
    ids_per_connection: int = 1_000_000,
) -> None:
    """The 17 full table copies from the source database into landed files of ``day``.

    The tables that grow with products and users are read in parallel ranges of their key: a connection for each
    ``ids_per_connection`` ids, ``max_connections`` at most.
    """
    for name, schema in schemas.SNAPSHOTS.items():
        ranges = {}
        if name in GROWING_TABLES:
            low, high = bounds(spark, url, name, "id", properties)
            connections = min(max_connections, 1 + (high - low) // ids_per_connection)
            ranges = {"partition_column": "id", "bounds": (low, high), "partitions": connections}
        rows = read(spark, url, table=name, columns=schema.fieldNames(), properties=properties, **ranges)
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        files.write_snapshot_tsv(typed, f"{landed.rstrip('/')}/full/{name}_full", day)


def load_raw(w: Warehouse, landed: str, day: str) -> None:
    """Landed day of the log, the 13 change feeds and the 17 full copies."""
    landed = landed.rstrip("/")
    sinks.load_partition(files.read_log_json(w.spark, f"{landed}/log", day), w.path("ods_log_inc"), day)
    for name, data in schemas.FEED_DATA.items():
        rows = files.read_change_feed(w.spark, f"{landed}/db", data, day, table=name, position=True)
        sinks.load_partition(rows, w.path(f"ods_{name}_inc"), day)
    for name, schema in schemas.SNAPSHOTS.items():
        rows = files.read_snapshot_tsv(w.spark, f"{landed}/full/{name}_full", schema, day)
        sinks.load_partition(rows, w.path(f"ods_{name}_full"), day)


def build_dimensions(w: Warehouse, day: str, first_day: bool = False) -> None:
    full = w.snapshot
    sku = dims.dim_sku(
        full("sku_info"), full("spu_info"), full("base_category3"), full("base_category2"), full("base_category1"),
        full("base_trademark"), full("sku_attr_value"), full("sku_sale_attr_value"), day,
    )
    w.put("dim_sku_full", sku, day)
    w.put("dim_coupon_full", dims.dim_coupon(full("coupon_info"), full("base_dic"), day), day)
    activity = dims.dim_activity(full("activity_rule"), full("activity_info"), full("base_dic"), day)
    w.put("dim_activity_full", activity, day)
    w.put("dim_province_full", dims.dim_province(full("base_province"), full("base_region"), day), day)
    w.put("dim_promotion_pos_full", dims.dim_promotion_pos(full("promotion_pos"), day), day)
    w.put("dim_promotion_refer_full", dims.dim_promotion_refer(full("promotion_refer"), day), day)

    users, path = w.feed("user_info"), w.path("dim_user_zip")
    if first_day:
        rows = scd2.scd2_init(users, day)
    else:
        open_rows = scd2.scd2_current(sinks.read_version(w.spark, path, shift(day, -1), USER_ZIP))
        rows = scd2.scd2_merged(open_rows, scd2.scd2_changes(users, day), day)
    sinks.write_version(rows, path, day, spread=first_day)


def build_facts(w: Warehouse, day: str, first_day: bool = False) -> None:
    feed, log = w.feed, w.log()
    lines = [feed(n) for n in ("order_detail", "order_info", "order_detail_coupon", "order_detail_activity")]
    payments, dic = feed("payment_info"), w.snapshot("base_dic")
    spread = {
        "dwd_trade_cart_add_inc": facts.fact_cart_add(feed("cart_info"), day, first_day),
        "dwd_trade_order_detail_inc": facts.fact_order_detail(*lines, day, first_day),
        "dwd_trade_pay_detail_suc_inc": facts.fact_payment_success(*lines, payments, dic, day, first_day),
        "dwd_tool_coupon_used_inc": facts.fact_coupon_used(feed("coupon_use"), day, first_day),
        "dwd_interaction_favor_add_inc": facts.fact_favor_add(feed("favor_info"), day, first_day),
        "dwd_user_register_inc": facts.fact_register(feed("user_info"), log, day, first_day),
    }
    for table, rows in spread.items():
        w.put(table, rows, day, spread=first_day)
    w.put("dwd_trade_cart_full", facts.fact_cart_snapshot(w.snapshot("cart_info"), day), day)
    w.put("dwd_traffic_page_view_inc", facts.fact_page_view(log, day), day)
    w.put("dwd_user_login_inc", facts.fact_login(log, day), day)

    path = w.path("dwd_trade_trade_flow_acc")
    before = None
    if not first_day:
        before = sinks.read_version(w.spark, path, shift(day, -1), TRADE_FLOW)
        before = before.where(F.col("dt") == F.lit(OPEN_END))
    flow = facts.fact_trade_flow(before, feed("order_info"), payments, feed("order_status_log"), day, first_day)
    sinks.write_version(flow, path, day, spread=first_day)


def build_summaries(w: Warehouse, day: str, first_day: bool = False) -> None:
    """One-day summaries of the day, or of all history on the first day, then the rolling and to-date ones."""
    read, one = w.read, None if first_day else day
    detail, sku = read("dwd_trade_order_detail_inc"), read("dim_sku_full")
    views = read("dwd_traffic_page_view_inc")
    one_day = {
        "dws_trade_user_sku_order_1d": rollups.user_sku_order_1d(detail, sku, one, day),
        "dws_trade_user_order_1d": rollups.user_order_1d(detail, one),
        "dws_trade_user_cart_add_1d": rollups.user_cart_add_1d(read("dwd_trade_cart_add_inc"), one),
        "dws_trade_user_payment_1d": rollups.user_payment_1d(read("dwd_trade_pay_detail_suc_inc"), one),
        "dws_trade_province_order_1d": rollups.province_order_1d(detail, read("dim_province_full"), one, day),
        "dws_tool_user_coupon_coupon_used_1d": rollups.user_coupon_used_1d(
            read("dwd_tool_coupon_used_inc"), read("dim_coupon_full"), one, day
        ),
        "dws_interaction_sku_favor_add_1d": rollups.sku_favor_add_1d(
            read("dwd_interaction_favor_add_inc"), sku, one, day
        ),
        "dws_traffic_session_page_view_1d": rollups.session_page_view_1d(views, one),
        "dws_traffic_page_visitor_page_view_1d": rollups.visitor_page_view_1d(views, one),
    }
    for table, rows in one_day.items():
        w.put(table, rows, day, spread=first_day)

    user_sku, orders = read("dws_trade_user_sku_order_1d"), read("dws_trade_user_order_1d")
    w.put("dws_trade_user_sku_order_nd", rollups.user_sku_order_nd(user_sku, day), day)
    provinces = rollups.province_order_nd(read("dws_trade_province_order_1d"), day)
    w.put("dws_trade_province_order_nd", provinces, day)
    logins = read("dwd_user_login_inc")
    if first_day:
        order_td = rollups.user_order_td_init(orders, day)
        login_td = rollups.user_login_td_init(read("dwd_user_register_inc"), logins, day)
    else:
        # Without the day before, the totals would silently start again from today.
        for table in ("dws_trade_user_order_td", "dws_user_user_login_td"):
            sinks.check_partition(w.spark, w.path(table), shift(day, -1))
        order_td = rollups.user_order_td(read("dws_trade_user_order_td"), orders, day)
        login_td = rollups.user_login_td(read("dws_user_user_login_td"), logins, day)
    w.put("dws_trade_user_order_td", order_td, day)
    w.put("dws_user_user_login_td", login_td, day)


def build_reports(w: Warehouse, day: str) -> None:
    read = w.read
    sessions = read("dws_traffic_session_page_view_1d")
    user_sku_1d, user_sku_nd = read("dws_trade_user_sku_order_1d"), read("dws_trade_user_sku_order_nd")
    orders_1d, logins = read("dws_trade_user_order_1d"), read("dws_user_user_login_td")
    flow = sinks.read_version(w.spark, w.path("dwd_trade_trade_flow_acc"), day, TRADE_FLOW)
    rows = {
        "ads_traffic_stats_by_channel": reports.traffic_by_channel(sessions, day),
        "ads_page_path": reports.page_path(read("dwd_traffic_page_view_inc"), day),
        "ads_user_change": reports.user_change(logins, day),
        "ads_user_retention": reports.user_retention(logins, day),
        "ads_user_stats": reports.user_stats(logins, day),
        "ads_user_action": reports.user_action(
            read("dws_traffic_page_visitor_page_view_1d"), read("dws_trade_user_cart_add_1d"), orders_1d,
            read("dws_trade_user_payment_1d"), day,
        ),
        "ads_new_order_user_stats": reports.new_order_user_stats(read("dws_trade_user_order_td"), day),
        "ads_order_continuously_user_count": reports.order_continuously_user_count(orders_1d, day),
        "ads_repeat_purchase_by_tm": reports.repeat_purchase_by_tm(user_sku_nd, day),
        "ads_order_stats_by_tm": reports.order_stats_by_tm(user_sku_1d, user_sku_nd, day),
        "ads_order_stats_by_cate": reports.order_stats_by_cate(user_sku_1d, user_sku_nd, day),
        "ads_order_by_province": reports.order_by_province(
            read("dws_trade_province_order_1d"), read("dws_trade_province_order_nd"), day
        ),
        "ads_coupon_stats": reports.coupon_stats(read("dws_tool_user_coupon_coupon_used_1d"), day),
        "ads_sku_cart_num_top3_by_cate": reports.cart_num_top3_by_cate(
            read("dwd_trade_cart_full"), read("dim_sku_full"), day
        ),
        "ads_sku_favor_count_top3_by_tm": reports.favor_count_top3_by_tm(
            read("dws_interaction_sku_favor_add_1d"), day
        ),
        "ads_order_to_pay_interval_avg": reports.order_to_pay_interval_avg(flow, day),
    }
    for table, report in rows.items():
        report, verify = sinks.watched(report, f"{table} on {day}", must_not(table, report.columns))
        sinks.accumulate_report(report, w.path(table), day)
        verify()


def run_week(w: Warehouse, day: str) -> None:
    """Traffic of the seven days that end on ``day``, kept apart from the daily report; meant for Mondays."""
    sessions = w.read("dws_traffic_session_page_view_1d")
    w.put("ads_traffic_stats_weekly", reports.weekly_traffic(sessions, day), day)


def run_month(w: Warehouse, day: str) -> None:
    """Traffic from the first of the month to ``day``; meant for the last day of a month."""
    sessions = w.read("dws_traffic_session_page_view_1d")
    w.put("ads_traffic_stats_monthly", reports.monthly_traffic(sessions, day), day)


def export_reports(
    w: Warehouse, day: str, url: str, upsert: bool = False, tables: Sequence[str] = tuple(schemas.REPORT_KEYS), **options
) -> None:
    """The day's reports into a database, one table each.

    After :func:`run_week` or :func:`run_month` give the table they wrote as ``tables``.
    """
    for table in tables:
        jdbc.export_upsert(w.read(table), url, table, day, upsert, **options)


WEEKLY, MONTHLY = ("ads_traffic_stats_weekly",), ("ads_traffic_stats_monthly",)


def load_calendar_once(w: Warehouse, landed: str) -> None:
    calendar = files.load_calendar(w.spark, f"{landed.rstrip('/')}/calendar")
    sinks.columnar_table(dims.dim_date(calendar), w.path("dim_date"))
