"""Detail facts from change feeds, the click log and table copies.

Every function returns its table's columns plus ``dt``. A normal run reads one day and stamps that day; with
``first_day=True`` it reads the bootstrap copy and spreads the rows over the days they happened on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.changefeed import BOOTSTRAP, INSERT, changed, is_new_row
from martline.functions.columns import MONEY, day_of, in_days, local_day, local_time, money, on_day
from martline.functions.dates import OPEN_END, shift
from martline.operators.dims import PAY_TYPE, decode_dictionary

# Payment state "paid", order state "finished", page of the registration form, zone of the log days.
PAID, FINISHED, REGISTER_PAGE, LOG_ZONE = "1602", "1004", "register", "GMT+8"

# Device and channel attributes of a log event and the column each one becomes.
_DEVICE = {
    "ch": "channel", "ar": "province_id", "vc": "version_code", "mid": "mid_id", "ba": "brand", "md": "model",
    "os": "operate_system",
}
_PAGE_VIEW_COMMON = {
    "ar": "province_id", "ba": "brand", "ch": "channel", "is_new": "is_new", "md": "model", "mid": "mid_id",
    "os": "operate_system", "uid": "user_id", "vc": "version_code",
}


def fact_cart_add(feed: DataFrame, day: str, first_day: bool = False) -> DataFrame:
    """New cart rows, and updates that raise the quantity, counted by the difference."""
    rows = on_day(feed, day)
    old_num = F.col("old")["sku_num"].try_cast("bigint")
    inserted = is_new_row(first_day)
    if first_day:
        rows = rows.where(inserted)
    else:
        rows = rows.where(inserted | (changed("sku_num") & (F.col("data.sku_num") > old_num)))
    added_at = F.when(inserted, F.col("data.create_time")).otherwise(F.col("data.operate_time"))
    added = F.when(inserted, F.col("data.sku_num")).otherwise(F.col("data.sku_num") - old_num)
    return rows.select(
        "data.id", "data.user_id", "data.sku_id", day_of(added_at).alias("date_id"),
        added_at.alias("create_time"), added.alias("sku_num"),
        _stamp(day, first_day, day_of(added_at)),
    )


def fact_order_detail(
    details: DataFrame, orders: DataFrame, coupons: DataFrame, activities: DataFrame, day: str,
    first_day: bool = False,
) -> DataFrame:
    """Order lines with their order, coupon and activity."""
    new = is_new_row(first_day)
    header = on_day(orders, day).where(new).select(
        F.col("data.id").alias("order_id"), "data.user_id", "data.province_id",
        day_of("data.create_time").alias("date_id"), "data.create_time",
    )
    lines = _order_lines(
        on_day(details, day).where(new), header, on_day(coupons, day).where(new), on_day(activities, day).where(new)
    )
    return lines.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount", _stamp(day, first_day, F.col("date_id")),
    )


def _order_lines(
    details: DataFrame, header: DataFrame, coupons: DataFrame, activities: DataFrame, how: str = "left"
) -> DataFrame:
    lines = details.select(
        "data.id", "data.order_id", "data.sku_id", "data.sku_num",
        money(F.col("data.order_price") * F.col("data.sku_num")).alias("split_original_amount"),
        _or_zero("data.split_activity_amount").alias("split_activity_amount"),
        _or_zero("data.split_coupon_amount").alias("split_coupon_amount"),
        "data.split_total_amount",
    )
    coupon = coupons.select(F.col("data.order_detail_id").alias("id"), "data.coupon_id")
    activity = activities.select(
        F.col("data.order_detail_id").alias("id"), "data.activity_id", "data.activity_rule_id"
    )
    # Coupon and activity share the line key, so the lines are exchanged once for both.
    return lines.join(header, "order_id", how).join(coupon, "id", "left").join(activity, "id", "left")


def fact_payment_success(
    details: DataFrame,
    orders: DataFrame,
    coupons: DataFrame,
    activities: DataFrame,
    payments: DataFrame,
    dic: DataFrame,
    day: str,
    first_day: bool = False,
    lookback_days: int = 1,
    allocate: bool = False,
) -> DataFrame:
    """Lines of the orders whose payment turned to paid on ``day``.

    An order may be paid up to ``lookback_days`` after it was placed. Each line carries the total of the whole
    payment; ``allocate`` replaces it by the line's own share.
    """
    paid = F.col("data.payment_status") == F.lit(PAID)
    paid = paid & ((F.col("type") == F.lit(BOOTSTRAP)) if first_day else changed("payment_status"))
    pay = on_day(payments, day).where(paid).select(
        "data.order_id", F.col("data.payment_type").alias("payment_type_code"), "data.callback_time",
        F.col("data.total_amount").alias("split_payment_amount"), day_of("data.callback_time").alias("date_id"),
    )
    pay = decode_dictionary(pay, on_day(dic, day), "payment_type_code", PAY_TYPE, "payment_type_name")

    types = [BOOTSTRAP] if first_day else [INSERT, BOOTSTRAP]
    first = day if first_day else shift(day, -lookback_days)

    def recent(feed: DataFrame) -> DataFrame:
        return in_days(feed, first, day).where(F.col("type").isin(types))

    # Payments meet the order headers first and lines join them as inner side, so only paid lines travel on.
    header = recent(orders).select(F.col("data.id").alias("_order"), "data.user_id", "data.province_id")
    paid_orders = pay.join(header, F.col("order_id") == F.col("_order"), "left").drop("_order")
    lines = _order_lines(recent(details), paid_orders, recent(coupons), recent(activities), how="inner")
    amount = "split_total_amount" if allocate else "split_payment_amount"
    return lines.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "payment_type_code", "payment_type_name", "date_id", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", F.col(amount).alias("split_payment_amount"),
        _stamp(day, first_day, F.col("date_id")),
    )


def fact_cart_snapshot(carts: DataFrame, day: str) -> DataFrame:
    """Carts at the end of the day that were not ordered."""
    return on_day(carts, day).where(F.col("is_ordered") == F.lit("0")).select(
        "id", "user_id", "sku_id", "sku_name", "sku_num", "dt"
    )


def fact_trade_flow(
    open_rows: DataFrame | None,
    orders: DataFrame,
    payments: DataFrame,
    status_log: DataFrame,
    day: str,
    first_day: bool = False,
) -> DataFrame:
    """Order, payment and finish milestones of each order after ``day``.

    ``open_rows`` are the unfinished orders as of the day before (none on the first day). The result holds the orders
    still open under ``9999-12-31`` and those finished by this run under their finish day.
    """
    new_orders = on_day(orders, day).where(is_new_row(first_day)).select(
        F.col("data.id").alias("order_id"), "data.user_id", "data.province_id",
        day_of("data.create_time").alias("order_date_id"), F.col("data.create_time").alias("order_time"),
        F.lit(None).cast("string").alias("payment_date_id"), F.lit(None).cast("string").alias("payment_time"),
        F.lit(None).cast("string").alias("finish_date_id"), F.lit(None).cast("string").alias("finish_time"),
        F.col("data.original_total_amount").alias("order_original_amount"),
        _or_zero("data.activity_reduce_amount").alias("order_activity_amount") if first_day
        else F.col("data.activity_reduce_amount").alias("order_activity_amount"),
        _or_zero("data.coupon_reduce_amount").alias("order_coupon_amount") if first_day
        else F.col("data.coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("data.total_amount").alias("order_total_amount"),
        F.lit(None).cast(MONEY).alias("payment_amount"),
    )
    # A feed may deliver an insert twice; equal rows count once. Dealt by the key first, for the joins below use it again.
    tracked = new_orders if open_rows is None else open_rows.drop("dt").unionByName(new_orders)
    tracked = tracked.repartition("order_id").distinct()

    paid = F.col("data.payment_status") == F.lit(PAID)
    paid = paid & ((F.col("type") == F.lit(BOOTSTRAP)) if first_day else changed("payment_status"))
    pay = on_day(payments, day).where(paid).select(
        F.col("data.order_id").alias("order_id"), day_of("data.callback_time").alias("_pay_date"),
        F.col("data.callback_time").alias("_pay_time"), F.col("data.total_amount").alias("_pay_amount"),
    )
    finished = on_day(status_log, day).where(F.col("data.order_status") == F.lit(FINISHED)).select(
        F.col("data.order_id").alias("order_id"), day_of("data.create_time").alias("_finish_date"),
        F.col("data.create_time").alias("_finish_time"),
    )
    # All three sides meet on the order key, so the open orders are exchanged once.
    flow = tracked.join(pay, "order_id", "left").join(finished, "order_id", "left")
    return flow.select(
        "order_id", "user_id", "province_id", "order_date_id", "order_time",
        F.coalesce("_pay_date", "payment_date_id").alias("payment_date_id"),
        F.coalesce("_pay_time", "payment_time").alias("payment_time"),
        F.coalesce("_finish_date", "finish_date_id").alias("finish_date_id"),
        F.coalesce("_finish_time", "finish_time").alias("finish_time"),
        "order_original_amount", "order_activity_amount", "order_coupon_amount", "order_total_amount",
        F.coalesce("_pay_amount", "payment_amount").alias("payment_amount"),
        F.coalesce("_finish_date", F.lit(OPEN_END)).alias("dt"),
    )


def fact_coupon_used(feed: DataFrame, day: str, first_day: bool = False) -> DataFrame:
    """Coupons whose use (by payment) was recorded."""
    if first_day:
        used = (F.col("type") == F.lit(BOOTSTRAP)) & F.col("data.used_time").isNotNull()
    else:
        used = changed("used_time")
    return on_day(feed, day).where(used).select(
        "data.id", "data.coupon_id", "data.user_id", "data.order_id", day_of("data.used_time").alias("date_id"),
        F.col("data.used_time").alias("payment_time"), _stamp(day, first_day, day_of("data.used_time")),
    )


def fact_favor_add(feed: DataFrame, day: str, first_day: bool = False) -> DataFrame:
    """Favourites added; taking one back is an update and does not count."""
    return on_day(feed, day).where(is_new_row(first_day)).select(
        "data.id", "data.user_id", "data.sku_id", day_of("data.create_time").alias("date_id"), "data.create_time",
        _stamp(day, first_day, day_of("data.create_time")),
    )


def fact_page_view(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """One flat row per page event. ``ts`` is kept to order views of the same second."""
    return on_day(log, day).where(F.col("page").isNotNull()).select(
        *[F.col(f"common.{field}").alias(name) for field, name in _PAGE_VIEW_COMMON.items()],
        F.col("page.item").alias("page_item"), F.col("page.item_type").alias("page_item_type"),
        "page.last_page_id", "page.page_id", "page.from_pos_id", "page.from_pos_seq", "page.refer_id",
        local_day("ts", zone).alias("date_id"), local_time("ts", zone).alias("view_time"),
        F.col("common.sid").alias("session_id"),
        F.col("page.during_time").try_cast("bigint").alias("during_time"), "ts", "dt",
    )


def fact_register(
    users: DataFrame, log: DataFrame, day: str, first_day: bool = False, dedup: bool = False
) -> DataFrame:
    """New users with the device of their registration page; ``dedup`` keeps one page event per user."""
    new = on_day(users, day).where(is_new_row(first_day)).select(
        F.col("data.id").alias("user_id"), "data.create_time"
    )
    pages = on_day(log, day).where(
        (F.col("page.page_id") == F.lit(REGISTER_PAGE)) & F.col("common.uid").isNotNull()
    )
    device = [F.col(f"common.{field}").alias(name) for field, name in _DEVICE.items()]
    if dedup:
        first = F.min(F.struct("ts", F.struct(*device).alias("device"))).alias("first")
        pages = pages.groupBy(F.col("common.uid").alias("user_id")).agg(first).select("user_id", "first.device.*")
    else:
        pages = pages.select(F.col("common.uid").alias("user_id"), *device)
    # A user may have any number of page events. An inner join can be split on that side where an outer one cannot,
    # so users without an event are added by their own join against the distinct users of the pages.
    with_page = new.join(pages, "user_id")
    without = new.join(pages.select("user_id").distinct(), "user_id", "left_anti")
    registered = with_page.unionByName(without, allowMissingColumns=True)
    return registered.select(
        "user_id", day_of("create_time").alias("date_id"), "create_time", *_DEVICE.values(),
        _stamp(day, first_day, day_of("create_time")),
    )


def fact_login(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """First page event of each session that has a user; with ``day=None`` per session and day.

    A grouped minimum instead of a ranked window: it combines on the map side, so a session id shared by very many
    events (a missing one, for instance) is no hot spot. Equal times are settled by the event's attributes.
    """
    events = on_day(log, day).where(F.col("page").isNotNull() & F.col("common.uid").isNotNull())
    attributes = [F.col(f"common.{field}").alias(name) for field, name in _DEVICE.items()]
    first = F.min(F.struct("ts", F.col("common.uid").alias("user_id"), *attributes)).alias("first")
    return (
        events.groupBy("dt", F.col("common.sid").alias("session_id"))
        .agg(first)
        .select(
            "first.user_id", local_day("first.ts", zone).alias("date_id"),
            local_time("first.ts", zone).alias("login_time"),
            *[F.col(f"first.{name}").alias(name) for name in _DEVICE.values()], "dt",
        )
    )


def explode_actions(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """One row per user action on a page."""
    rows = on_day(log, day).select("common", "page", F.explode("actions").alias("action"), "dt")
    return rows.select(
        F.col("common.mid").alias("mid_id"), F.col("common.uid").alias("user_id"),
        F.col("common.sid").alias("session_id"), "page.page_id", "action.action_id",
        F.col("action.item").alias("item"), F.col("action.item_type").alias("item_type"),
        local_time("action.ts", zone).alias("action_time"), "dt",
    )


def explode_displays(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """One row per item shown on a page."""
    rows = on_day(log, day).select("common", "page", "ts", F.explode("displays").alias("display"), "dt")
    return rows.select(
        F.col("common.mid").alias("mid_id"), F.col("common.uid").alias("user_id"),
        F.col("common.sid").alias("session_id"), "page.page_id", "display.display_type",
        F.col("display.item").alias("item"), F.col("display.item_type").alias("item_type"),
        "display.pos_seq", "display.pos_id", local_time("ts", zone).alias("display_time"), "dt",
    )


def start_events(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """One row per application start."""
    return on_day(log, day).where(F.col("start").isNotNull()).select(
        F.col("common.mid").alias("mid_id"), F.col("common.uid").alias("user_id"),
        F.col("common.ch").alias("channel"), "start.*", local_time("ts", zone).alias("start_time"), "dt",
    )


def error_events(log: DataFrame, day: str | None, zone: str = LOG_ZONE) -> DataFrame:
    """One row per event that carries an error, with the page it happened on."""
    return on_day(log, day).where(F.col("err").isNotNull()).select(
        F.col("common.mid").alias("mid_id"), F.col("common.uid").alias("user_id"), "page.page_id", "err.error_code",
        "err.msg", local_time("ts", zone).alias("error_time"), "dt",
    )


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(MONEY))


def _stamp(day: str, first_day: bool, happened_on: Column) -> Column:
    return (happened_on if first_day else F.lit(day)).alias("dt")
