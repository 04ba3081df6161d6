"""Report tables. Each function returns the rows of one run day.

Windows of 1, 7 and 30 days all end on the run day, so they nest: a key counts in a window exactly when its latest
day lies inside it. Distinct counts per window therefore need one pass that keeps the latest day per key, not one
copy of the rows per window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.columns import (
    day_number, day_text, in_days, on_day, ratio, seconds_between, whole_average,
)
from martline.functions.dates import OPEN_END, WINDOWS, month_start, shift, window_start
from martline.operators.ranking import number_and_next, top_ranked

BRAND = ["tm_id", "tm_name"]
CATEGORY = [
    "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name",
]
PROVINCE = ["province_id", "province_name", "area_code", "iso_code", "iso_3166_2"]

# The pages counted by the funnel.
HOME_PAGE, DETAIL_PAGE = "home", "good_detail"


def _starts(day: str, windows: Sequence[int]) -> dict[int, str]:
    return {length: window_start(day, length) for length in windows}


def _since(start: str) -> Column:
    """True where the latest day of a key lies in the window that begins on ``start``."""
    return F.col("latest") >= day_number(F.lit(start))


def _stacked(df: DataFrame, keep: Sequence[str], day: str, per_window: Mapping[int, Mapping[str, Column]]) -> DataFrame:
    """One row per window from columns that hold all windows side by side."""
    entries = [
        F.struct(
            F.lit(length).cast("bigint").alias("recent_days"),
            *[column.alias(name) for name, column in columns.items()],
        )
        for length, columns in per_window.items()
    ]
    rows = df.select(*keep, F.explode(F.array(*entries)).alias("w"))
    return rows.select(F.lit(day).alias("dt"), "w.recent_days", *keep, *[
        f"w.{name}" for name in next(iter(per_window.values()))
    ])


# Traffic


def traffic_by_channel(sessions: DataFrame, day: str, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Visitors, average stay and pages, sessions and bounce rate per channel and window."""
    return _traffic(sessions, day, _starts(day, windows))


def weekly_traffic(sessions: DataFrame, day: str) -> DataFrame:
    return _traffic(sessions, day, {7: window_start(day, 7)})


def monthly_traffic(sessions: DataFrame, day: str) -> DataFrame:
    """Month to date, labelled 30."""
    return _traffic(sessions, day, {30: month_start(day)})


def _traffic(sessions: DataFrame, day: str, starts: Mapping[int, str]) -> DataFrame:
    rows = in_days(sessions, min(starts.values()), day)
    additive, names = [], []
    for length, start in starts.items():
        inside = F.col("dt") >= F.lit(start)
        names += [f"{c}_{length}" for c in ("rows", "stay", "stays", "pages", "paged", "bounces")]
        stay, pages = F.when(inside, F.col("during_time_1d")), F.when(inside, F.col("page_count_1d"))
        additive += [
            F.count(F.when(inside, F.col("one"))).alias(f"rows_{length}"),
            F.sum(stay).alias(f"stay_{length}"), F.count(stay).alias(f"stays_{length}"),
            F.sum(pages).alias(f"pages_{length}"), F.count(pages).alias(f"paged_{length}"),
            F.count(F.when(pages == 1, 1)).alias(f"bounces_{length}"),
        ]
    # One scan: a visitor or session id is one key per channel here, so a hot channel is spread over its keys, and the
    # additive measures ride on the visitors' keys.
    keys = F.explode(F.array(
        F.struct(F.lit("visitor").alias("kind"), F.col("mid_id").alias("id")),
        F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id")),
    ))
    visitor, measures = F.col("k.kind") == "visitor", ("during_time_1d", "page_count_1d")
    per_key = (
        rows.select("channel", "dt", *measures, keys.alias("k"))
        .select("channel", "dt", "k.kind", "k.id", *[F.when(visitor, F.col(c)).alias(c) for c in measures],
                F.when(visitor, F.lit(1)).alias("one"))
        .groupBy("channel", "kind", "id")
        .agg(F.max(day_number("dt")).alias("latest"), *additive)
    )
    seen = [
        F.count(F.when((F.col("kind") == kind) & F.col("id").isNotNull() & _since(start), 1)).alias(f"{kind}_{length}")
        for length, start in starts.items()
        for kind in ("visitor", "session")
    ]
    both = per_key.groupBy("channel").agg(*seen, *[F.sum(c).alias(c) for c in names])
    per_window = {}
    for length in starts:
        sessions_seen = F.coalesce(F.col(f"session_{length}"), F.lit(0))
        per_window[length] = {
            "rows": F.col(f"rows_{length}"),
            "uv_count": F.coalesce(F.col(f"visitor_{length}"), F.lit(0)),
            "avg_duration_sec": whole_average(F.col(f"stay_{length}"), F.col(f"stays_{length}") * F.lit(1000)),
            "avg_page_count": whole_average(F.col(f"pages_{length}"), F.col(f"paged_{length}")),
            "sv_count": sessions_seen,
            "bounce_rate": ratio(F.col(f"bounces_{length}"), sessions_seen),
        }
    return _stacked(both, ["channel"], day, per_window).where(F.col("rows") > 0).drop("rows")


def page_path(views: DataFrame, day: str | None, chunk_minutes: int = 5) -> DataFrame:
    """Steps between consecutive pages of a session; the last page leads to ``out``.

    A session is numbered in pieces of ``chunk_minutes``: long enough that a usual session has few, short enough that
    a session with very many events is spread over hundreds of tasks.
    """
    rows = on_day(views, day).select("dt", "session_id", "view_time", "ts", "page_id")
    piece = F.floor(F.substring("view_time", 15, 2).try_cast("int") / chunk_minutes).cast("string")
    chunk = F.concat(F.substring("view_time", 1, 14), F.lpad(piece, 2, "0"))
    steps = number_and_next(
        rows, ["dt", "session_id"], ["view_time", "ts", "page_id"], chunk, "page_id", "rn", "following"
    )
    following = F.when(F.col("following").isNull(), F.lit("out")).otherwise(F.col("following.v"))
    # The wording of path nodes.
    source = F.concat(F.lit("step-"), F.col("rn").cast("string"), F.lit(":"), F.col("page_id"))
    target = F.concat(F.lit("step-"), (F.col("rn") + 1).cast("string"), F.lit(":"), following)
    return steps.groupBy("dt", source.alias("source"), target.alias("target")).agg(
        F.count(F.lit(1)).alias("path_count")
    )


# Users


def user_change(logins: DataFrame, day: str) -> DataFrame:
    """Users lost (last login exactly seven days ago) and users back after at least eight days."""
    today = on_day(logins, day).where(F.col("login_date_last").isin(day, shift(day, -7)))
    away = (
        on_day(logins, shift(day, -1))
        .where(F.col("login_date_last") <= F.lit(shift(day, -8)))
        .select("user_id", F.lit(True).alias("was_away"))
    )
    back = (F.col("login_date_last") == F.lit(day)) & F.col("was_away")
    lost = (F.col("login_date_last") == F.lit(shift(day, -7))) & F.col("user_id").isNotNull()
    counts = today.join(away, "user_id", "left").agg(
        F.count(F.when(lost, 1)).alias("user_churn_count"), F.count(F.when(back, 1)).alias("user_back_count")
    )
    return counts.select(F.lit(day).alias("dt"), "user_churn_count", "user_back_count")


def user_retention(logins: DataFrame, day: str, days: int = 7) -> DataFrame:
    """Per first-login day: how many of its users logged in on ``day``."""
    cohort = on_day(logins, day).where(
        (F.col("login_date_first") >= F.lit(shift(day, -days))) & (F.col("login_date_first") < F.lit(day))
    )
    kept = F.count(F.when(F.col("login_date_last") == F.lit(day), 1))
    rows = cohort.groupBy(F.col("login_date_first").alias("create_date")).agg(
        kept.alias("retention_count"), F.count("user_id").alias("new_user_count"),
        F.count(F.lit(1)).alias("_all"),
    )
    age = F.datediff(F.lit(day).cast("date"), F.col("create_date").cast("date"))
    return rows.select(
        F.lit(day).alias("dt"), "create_date", age.alias("retention_day"), "retention_count", "new_user_count",
        ratio(F.col("retention_count"), F.col("_all"), 100).alias("retention_rate"),
    )


def user_stats(logins: DataFrame, day: str, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """New and active users per window."""
    starts = _starts(day, windows)
    rows = on_day(logins, day).where(
        F.col("login_date_last").between(F.lit(min(starts.values())), F.lit(day))
    )
    sums = []
    for length, start in starts.items():
        sums += [
            _sum_if(F.col("login_date_first").between(F.lit(start), F.lit(day))).alias(f"new_{length}"),
            _sum_if(F.col("login_date_last") >= F.lit(start)).alias(f"active_{length}"),
        ]
    per_window = {
        n: {"new_user_count": F.col(f"new_{n}"), "active_user_count": F.col(f"active_{n}")} for n in starts
    }
    return _stacked(rows.agg(*sums), [], day, per_window)


def user_action(
    page_views: DataFrame, cart_adds: DataFrame, orders: DataFrame, payments: DataFrame, day: str
) -> DataFrame:
    """Funnel of the day: rows per step of the four summaries, gathered in one aggregate without a join."""
    pages = on_day(page_views, day).where(F.col("page_id").isin(HOME_PAGE, DETAIL_PAGE))
    steps = pages.select(F.col("page_id").alias("step"))
    for name, summary in (("cart", cart_adds), ("order", orders), ("payment", payments)):
        steps = steps.unionByName(on_day(summary, day).select(F.lit(f"#{name}").alias("step")))
    is_page = F.col("step").isin(HOME_PAGE, DETAIL_PAGE)
    counts = steps.agg(
        F.sum(F.when(is_page, (F.col("step") == HOME_PAGE).cast("bigint"))).alias("home_count"),
        F.sum(F.when(is_page, (F.col("step") == DETAIL_PAGE).cast("bigint"))).alias("good_detail_count"),
        *[
            F.count(F.when(F.col("step") == f"#{name}", 1)).alias(f"{name}_count")
            for name in ("cart", "order", "payment")
        ],
    )
    return counts.select(
        F.lit(day).alias("dt"), "home_count", "good_detail_count", "cart_count", "order_count", "payment_count"
    )


def new_order_user_stats(orders_td: DataFrame, day: str, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Users whose first order lies in each window."""
    rows = on_day(orders_td, day)
    return _first_order_counts(rows, F.col("order_date_first"), day, windows)


def new_order_user_direct(detail: DataFrame, day: str, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """The same from order lines: the first order day per user decides every window in one pass."""
    first = (
        detail.where((F.col("dt") <= F.lit(day)) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(day_number("dt")).alias("first"))
    )
    return _first_order_counts(first, day_text("first"), day, windows)


def _first_order_counts(users: DataFrame, first: Column, day: str, windows: Sequence[int]) -> DataFrame:
    starts = _starts(day, windows)
    recent = users.where(first.between(F.lit(min(starts.values())), F.lit(day)))
    known = F.col("user_id").isNotNull()
    counts = recent.agg(*[
        F.count(F.when(known & (first >= F.lit(start)), 1)).alias(f"new_{length}") for length, start in starts.items()
    ])
    return _stacked(counts, [], day, {n: {"new_order_user_count": F.col(f"new_{n}")} for n in starts})


def order_continuously_user_count(
    orders: DataFrame, day: str, run: int = 3, span: int = 7
) -> DataFrame:
    """Users with orders on ``run`` days in a row within the last ``span`` days.

    A user's distinct days, at most ``span``, are one sorted array; in a run the day ``run - 1`` places on is as many days
    later. Distinct days combine before the shuffle, and any ``run`` and ``span`` are right.
    """
    if run < 1 or span < 1:
        raise ValueError("run and span are numbers of days, 1 at least")
    known = in_days(orders, window_start(day, span), day).where(F.col("user_id").isNotNull())
    days = known.select("user_id", day_number("dt").alias("d")).distinct().groupBy("user_id").agg(
        F.array_sort(F.collect_list("d")).alias("days")
    )
    places = F.sequence(F.lit(1), F.size("days") - F.lit(run - 1))
    in_a_row = F.exists(
        places, lambda i: F.element_at("days", i + F.lit(run - 1)) - F.element_at("days", i) == F.lit(run - 1)
    )
    long_enough = F.when(F.size("days") >= run, in_a_row)
    counts = days.agg(F.count(F.when(long_enough, 1)).alias("order_continuously_user_count"))
    return counts.select(
        F.lit(day).alias("dt"), F.lit(span).cast("bigint").alias("recent_days"), "order_continuously_user_count"
    )


# Orders


def repeat_purchase_by_tm(orders_nd: DataFrame, day: str, window: int = 30) -> DataFrame:
    """Share of a brand's buyers with at least two orders in the window."""
    buyers = on_day(orders_nd, day).groupBy("user_id", *BRAND).agg(F.sum(f"order_count_{window}d").alias("n"))
    rates = buyers.groupBy(*BRAND).agg(
        ratio(_sum_if(F.col("n") >= 2), _sum_if(F.col("n") >= 1)).alias("order_repeat_rate")
    )
    return rates.select(
        F.lit(day).alias("dt"), F.lit(window).cast("bigint").alias("recent_days"), *BRAND, "order_repeat_rate"
    )


def order_stats_by_tm(orders_1d: DataFrame, orders_nd: DataFrame, day: str) -> DataFrame:
    """Orders (lines) and buyers per brand and window."""
    return _order_stats(orders_1d, orders_nd, day, BRAND)


def order_stats_by_cate(orders_1d: DataFrame, orders_nd: DataFrame, day: str) -> DataFrame:
    return _order_stats(orders_1d, orders_nd, day, CATEGORY)


def order_stats_by_tm_nd(orders_1d: DataFrame, orders_nd: DataFrame, day: str) -> DataFrame:
    """As :func:`order_stats_by_tm`, but every buyer of the one-day table counts for one day."""
    return _order_stats(orders_1d, orders_nd, day, BRAND, one_day_needs_orders=False)


def order_stats_by_cate_nd(orders_1d: DataFrame, orders_nd: DataFrame, day: str) -> DataFrame:
    """Variant by category that counts every buyer of the longest window in each multi-day window."""
    return _order_stats(orders_1d, orders_nd, day, CATEGORY, one_day_needs_orders=False, nd_needs_orders=False)


def _order_stats(
    orders_1d: DataFrame,
    orders_nd: DataFrame,
    day: str,
    group: Sequence[str],
    one_day_needs_orders: bool = True,
    nd_needs_orders: bool = True,
) -> DataFrame:
    """Both summaries brought to (group, user) with the windows side by side, then to the group.

    Users are counted by a plain aggregate after the first step, so nothing is multiplied by window, and a hot
    brand or category is spread over its users.
    """
    one = on_day(orders_1d, day).select(
        *group, "user_id", F.col("order_count_1d").alias("n_1"), F.lit(None).cast("bigint").alias("n_7"),
        F.lit(None).cast("bigint").alias("n_30"),
    )
    many = on_day(orders_nd, day).select(
        *group, "user_id", F.lit(None).cast("bigint").alias("n_1"), F.col("order_count_7d").alias("n_7"),
        F.col("order_count_30d").alias("n_30"),
    )
    users = one.unionByName(many).groupBy(*group, "user_id").agg(
        *[F.sum(f"n_{n}").alias(f"n_{n}") for n in WINDOWS]
    )
    measures = []
    for n in WINDOWS:
        needs_orders = one_day_needs_orders if n == 1 else nd_needs_orders
        buys = F.col(f"n_{n}") > 0 if needs_orders else F.col(f"n_{n}").isNotNull()
        measures += [
            F.sum(f"n_{n}").alias(f"orders_{n}"),
            F.count(F.when(buys & F.col("user_id").isNotNull(), 1)).alias(f"users_{n}"),
        ]
    stats = users.groupBy(*group).agg(*measures)
    per_window = {
        n: {"order_count": F.col(f"orders_{n}"), "order_user_count": F.col(f"users_{n}")} for n in WINDOWS
    }
    return _stacked(stats, group, day, per_window).where(F.col("order_count").isNotNull())


def order_stats_by_tm_direct(
    detail: DataFrame, sku: DataFrame, day: str, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Distinct orders and buyers per brand straight from order lines, in one scan of the longest window."""
    starts = _starts(day, windows)
    about = on_day(sku, day).select(F.col("id").alias("sku_id"), *BRAND)
    lines = in_days(detail, min(starts.values()), day).select("sku_id", "order_id", "user_id", "dt")
    keys = F.explode(F.array(
        F.struct(F.lit("order").alias("kind"), F.col("order_id").alias("id")),
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
    ))
    latest = (
        lines.join(about, "sku_id", "left").select(*BRAND, "dt", keys.alias("k"))
        .groupBy(*BRAND, "k.kind", "k.id").agg(F.max(day_number("dt")).alias("latest"))
    )
    counts = [F.max("latest").alias("latest")]
    for length, start in starts.items():
        inside = _since(start) & F.col("id").isNotNull()
        counts += [
            F.count(F.when(inside & (F.col("kind") == kind), 1)).alias(f"{kind}s_{length}")
            for kind in ("order", "user")
        ]
    stats = latest.groupBy(*BRAND).agg(*counts)
    per_window = {
        n: {
            "inside": _since(start),
            "order_count": F.col(f"orders_{n}"), "order_user_count": F.col(f"users_{n}"),
        }
        for n, start in starts.items()
    }
    return _stacked(stats, BRAND, day, per_window).where("inside").drop("inside")


def order_by_province(orders_1d: DataFrame, orders_nd: DataFrame, day: str) -> DataFrame:
    """Orders and amount per province and window; the summaries already have the report's grain."""
    one = _stacked(
        on_day(orders_1d, day), PROVINCE, day,
        {1: {"order_count": F.col("order_count_1d"), "order_total_amount": F.col("order_total_amount_1d")}},
    )
    many = _stacked(
        on_day(orders_nd, day), PROVINCE, day,
        {
            n: {"order_count": F.col(f"order_count_{n}d"), "order_total_amount": F.col(f"order_total_amount_{n}d")}
            for n in (7, 30)
        },
    )
    return one.unionByName(many).withColumnRenamed("iso_3166_2", "iso_code_3166_2")


def coupon_stats(used_1d: DataFrame, day: str) -> DataFrame:
    rows = on_day(used_1d, day).groupBy("coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").alias("used_count"), F.count("user_id").alias("used_user_count")
    )
    return rows.select(F.lit(day).alias("dt"), "coupon_id", "coupon_name", "used_count", "used_user_count")


def cart_num_top3_by_cate(carts: DataFrame, sku: DataFrame, day: str, limit: int = 3) -> DataFrame:
    """Products with the most pieces in carts, per category; summed per product before the dimension join."""
    about = on_day(sku, day).select(F.col("id").alias("sku_id"), "sku_name", *CATEGORY)
    in_carts = on_day(carts, day).groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    ranked = top_ranked(in_carts.join(about, "sku_id", "left"), "category3_id", "cart_num", limit)
    return ranked.select(F.lit(day).alias("dt"), *CATEGORY, "sku_id", "sku_name", "cart_num", "rk")


def favor_count_top3_by_tm(favors_1d: DataFrame, day: str, limit: int = 3) -> DataFrame:
    ranked = top_ranked(on_day(favors_1d, day), "tm_id", "favor_add_count_1d", limit)
    return ranked.select(
        F.lit(day).alias("dt"), "tm_id", "tm_name", "sku_id", "sku_name",
        F.col("favor_add_count_1d").alias("favor_count"), "rk",
    )


def order_to_pay_interval_avg(flow: DataFrame, day: str) -> DataFrame:
    """Average seconds from order to payment over the orders paid on ``day``."""
    rows = flow.where(F.col("dt").isin(OPEN_END, day) & (F.col("payment_date_id") == F.lit(day)))
    waited = seconds_between("order_time", "payment_time")
    average = whole_average(F.sum(waited), F.count(waited))
    return rows.agg(average.alias("order_to_pay_interval_avg")).select(
        F.lit(day).alias("dt"), "order_to_pay_interval_avg"
    )


def _sum_if(condition: Column) -> Column:
    """Count of true rows that is NULL, not zero, over no rows at all."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))
