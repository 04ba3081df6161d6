"""Summaries: one-day, rolling and to-date.

One-day functions group by ``dt`` as well, so the same code serves a daily run (``day`` given, one partition read)
and the first load over all history (``day=None``). Aggregation comes before the dimension join: the join then sees
one row per group instead of one per detail row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.columns import MONEY, day_number, day_text, in_days, money, on_day
from martline.functions.dates import shift, window_start

SKU_ATTRIBUTES = [
    "sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id",
    "category3_name", "tm_id", "tm_name",
]
PROVINCE_ATTRIBUTES = ["province_name", "area_code", "iso_code", "iso_3166_2"]
COUPON_ATTRIBUTES = ["coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"]

ORDER_MEASURES = [
    "order_count_1d", "order_num_1d", "order_original_amount_1d", "activity_reduce_amount_1d",
    "coupon_reduce_amount_1d", "order_total_amount_1d",
]
PROVINCE_MEASURES = [m for m in ORDER_MEASURES if m != "order_num_1d"]


def user_sku_order_1d(detail: DataFrame, sku: DataFrame, day: str | None, dim_day: str | None = None) -> DataFrame:
    """Orders per user and product. ``order_count_1d`` counts order lines."""
    lines = _add_up(on_day(detail, day), ["user_id", "sku_id"], F.count(F.lit(1)))
    rows = _describe(lines, sku, "sku_id", SKU_ATTRIBUTES, dim_day or day)
    return rows.select("user_id", "sku_id", *SKU_ATTRIBUTES, *ORDER_MEASURES, "dt")


def user_order_1d(detail: DataFrame, day: str | None) -> DataFrame:
    rows = _orders_counted_once(on_day(detail, day), ["user_id"])
    return rows.select("user_id", *ORDER_MEASURES, "dt")


def user_cart_add_1d(cart_adds: DataFrame, day: str | None) -> DataFrame:
    return on_day(cart_adds, day).groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")
    )


def user_payment_1d(payments: DataFrame, day: str | None) -> DataFrame:
    per_order = on_day(payments, day).groupBy("dt", "user_id", "order_id").agg(
        F.sum("sku_num").alias("num"), F.sum("split_payment_amount").alias("amount")
    )
    return per_order.groupBy("dt", "user_id").agg(
        F.count("order_id").alias("payment_count_1d"), F.sum("num").alias("payment_num_1d"),
        money(F.sum("amount")).alias("payment_amount_1d"),
    )


def province_order_1d(
    detail: DataFrame, province: DataFrame, day: str | None, dim_day: str | None = None
) -> DataFrame:
    rows = _orders_counted_once(on_day(detail, day), ["province_id"])
    rows = _describe(rows, province, "province_id", PROVINCE_ATTRIBUTES, dim_day or day)
    return rows.select("province_id", *PROVINCE_ATTRIBUTES, *PROVINCE_MEASURES, "dt")


def user_coupon_used_1d(
    used: DataFrame, coupon: DataFrame, day: str | None, dim_day: str | None = None
) -> DataFrame:
    rows = on_day(used, day).groupBy("dt", "user_id", "coupon_id").agg(F.count(F.lit(1)).alias("used_count_1d"))
    rows = _describe(rows, coupon, "coupon_id", COUPON_ATTRIBUTES, dim_day or day)
    return rows.select("user_id", "coupon_id", *COUPON_ATTRIBUTES, "used_count_1d", "dt")


def sku_favor_add_1d(favors: DataFrame, sku: DataFrame, day: str | None, dim_day: str | None = None) -> DataFrame:
    rows = on_day(favors, day).groupBy("dt", "sku_id").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    rows = _describe(rows, sku, "sku_id", SKU_ATTRIBUTES, dim_day or day)
    return rows.select("sku_id", *SKU_ATTRIBUTES, "favor_add_count_1d", "dt")


def session_page_view_1d(views: DataFrame, day: str | None) -> DataFrame:
    keys = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"]
    return on_day(views, day).groupBy(*keys, "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d")
    )


def visitor_page_view_1d(views: DataFrame, day: str | None) -> DataFrame:
    keys = ["mid_id", "brand", "model", "operate_system", "page_id"]
    return on_day(views, day).groupBy(*keys, "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")
    )


def rolling(
    one_day: DataFrame, day: str, keys: Sequence[str], measures: Sequence[str], windows: Sequence[int] = (7, 30)
) -> DataFrame:
    """Sums over several windows ending on ``day`` from one scan of the longest one."""
    longest = max(windows)
    sums = []
    for length in windows:
        start = F.lit(window_start(day, length))
        for measure in measures:
            value = F.col(measure)
            if length != longest:
                value = F.when(F.col("dt") >= start, value).otherwise(F.lit(0))
            total = F.sum(value)
            if dict(one_day.dtypes)[measure].startswith("decimal"):
                total = money(total)
            sums.append(total.alias(measure.removesuffix("_1d") + f"_{length}d"))
    rows = in_days(one_day, window_start(day, longest), day)
    return rows.groupBy(*keys).agg(*sums).withColumn("dt", F.lit(day))


def user_sku_order_nd(one_day: DataFrame, day: str, windows: Sequence[int] = (7, 30)) -> DataFrame:
    return rolling(one_day, day, ["user_id", "sku_id", *SKU_ATTRIBUTES], ORDER_MEASURES, windows)


def province_order_nd(one_day: DataFrame, day: str, windows: Sequence[int] = (7, 30)) -> DataFrame:
    return rolling(one_day, day, ["province_id", *PROVINCE_ATTRIBUTES], PROVINCE_MEASURES, windows)


def to_date(
    previous: DataFrame, today: DataFrame, key: str, first: str, last: str, totals: Sequence[str]
) -> DataFrame:
    """Running totals after adding one day: both frames have the same columns, one row per key each."""
    dtypes = dict(today.dtypes)
    sums = [
        (money(F.sum(c)) if dtypes[c].startswith("decimal") else F.sum(c)).alias(c) for c in totals
    ]
    columns = [key, first, last, *totals]
    return previous.select(*columns).unionByName(today.select(*columns)).groupBy(key).agg(
        _first_day(first).alias(first), _last_day(last).alias(last), *sums
    )


_ORDER_TOTALS = {
    "order_count_1d": "order_count_td", "order_num_1d": "order_num_td",
    "order_original_amount_1d": "original_amount_td", "activity_reduce_amount_1d": "activity_reduce_amount_td",
    "coupon_reduce_amount_1d": "coupon_reduce_amount_td", "order_total_amount_1d": "total_amount_td",
}


def user_order_td_init(one_day: DataFrame, day: str) -> DataFrame:
    """First load: totals over all one-day rows up to ``day``."""
    rows = one_day.where(F.col("dt") <= F.lit(day))
    sums = [
        (F.sum(c) if c.startswith("order_count") or c.startswith("order_num") else money(F.sum(c))).alias(name)
        for c, name in _ORDER_TOTALS.items()
    ]
    return rows.groupBy("user_id").agg(
        _first_day("dt").alias("order_date_first"), _last_day("dt").alias("order_date_last"), *sums
    ).withColumn("dt", F.lit(day))


def user_order_td(previous: DataFrame, one_day: DataFrame, day: str) -> DataFrame:
    """Totals of the day before plus the rows of ``day``."""
    before = on_day(previous, shift(day, -1))
    today = on_day(one_day, day).select(
        "user_id", F.lit(day).alias("order_date_first"), F.lit(day).alias("order_date_last"),
        *[F.col(c).alias(name) for c, name in _ORDER_TOTALS.items()],
    )
    totals = list(_ORDER_TOTALS.values())
    return to_date(before, today, "user_id", "order_date_first", "order_date_last", totals).withColumn(
        "dt", F.lit(day)
    )


def user_login_td_init(registrations: DataFrame, logins: DataFrame, day: str) -> DataFrame:
    """First load: earlier registrations stand for the logins from before there was a log."""
    registered = registrations.where(F.col("dt") < F.lit(day)).select("user_id", "dt")
    logged_in = logins.where(F.col("dt") == F.lit(day)).select("user_id", "dt")
    return registered.unionByName(logged_in).groupBy("user_id").agg(
        _last_day("dt").alias("login_date_last"), _first_day("dt").alias("login_date_first"),
        F.count(F.lit(1)).alias("login_count_td"),
    ).withColumn("dt", F.lit(day))


def user_login_td(previous: DataFrame, logins: DataFrame, day: str) -> DataFrame:
    before = on_day(previous, shift(day, -1))
    today = on_day(logins, day).groupBy("user_id").agg(F.count(F.lit(1)).alias("login_count_td")).select(
        "user_id", F.lit(day).alias("login_date_last"), F.lit(day).alias("login_date_first"), "login_count_td"
    )
    merged = to_date(before, today, "user_id", "login_date_first", "login_date_last", ["login_count_td"])
    return merged.select(
        "user_id", "login_date_last", "login_date_first", "login_count_td", F.lit(day).alias("dt")
    )


def _first_day(column: str) -> Column:
    return day_text(F.min(day_number(column)))


def _last_day(column: str) -> Column:
    return day_text(F.max(day_number(column)))


def _add_up(lines: DataFrame, keys: list[str], order_count: Column) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    return lines.groupBy("dt", *keys).agg(
        order_count.alias("order_count_1d"),
        F.sum("sku_num").alias("order_num_1d"),
        money(F.sum("split_original_amount")).alias("order_original_amount_1d"),
        money(F.sum(F.coalesce("split_activity_amount", zero))).alias("activity_reduce_amount_1d"),
        money(F.sum(F.coalesce("split_coupon_amount", zero))).alias("coupon_reduce_amount_1d"),
        money(F.sum("split_total_amount")).alias("order_total_amount_1d"),
    )


def _orders_counted_once(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per key with distinct orders: first per order, then per key.

    The first step spreads a hot key (a province, a missing user) over its orders, the second combines on the map
    side, and no row is copied for the distinct count.
    """
    per_order = _add_up(lines, [*keys, "order_id"], F.count(F.lit(1)))
    return per_order.groupBy("dt", *keys).agg(
        F.count("order_id").alias("order_count_1d"),
        F.sum("order_num_1d").alias("order_num_1d"),
        *[money(F.sum(m)).alias(m) for m in ORDER_MEASURES if m.endswith("amount_1d")],
    )


def _describe(
    rows: DataFrame, dim: DataFrame, key: str, attributes: list[str], dim_day: str | None
) -> DataFrame:
    if "dt" in dim.columns:
        if dim_day is None:
            raise ValueError("name the dimension's day when loading all history")
        dim = on_day(dim, dim_day)
    about = dim.select(F.col("id").alias(key), *attributes)
    return rows.join(about, key, "left")


# Moving totals: a window's sums from yesterday's sums, the day that enters and the day that leaves.


def _counted(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], sign: int) -> DataFrame:
    """One-day rows as changes of a moving total: each measure, how often it is known, and the rows."""
    known = [F.when(F.col(m).isNotNull(), F.lit(sign)).otherwise(F.lit(0)).cast("bigint").alias(f"n_{m}") for m in measures]
    values = [(F.coalesce(F.col(m), F.lit(0)) * F.lit(sign)).cast(_wide(rows, m)).alias(m) for m in measures]
    return rows.select(*keys, *values, *known, F.lit(sign).cast("bigint").alias("n_rows"))


def _wide(rows: DataFrame, measure: str) -> str:
    kind = dict(rows.dtypes)[measure]
    return "decimal(38,2)" if kind.startswith("decimal") else kind


def _summed(changes: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    sums = [F.sum(m).cast(dict(changes.dtypes)[m]).alias(m) for m in (*measures, *(f"n_{m}" for m in measures), "n_rows")]
    return changes.groupBy(*keys).agg(*sums).where("n_rows <> 0")


def moving_start(one_day: DataFrame, day: str, keys: Sequence[str], measures: Sequence[str], length: int) -> DataFrame:
    """State of a moving total after ``day`` from one scan of its window, for the first run or to begin anew."""
    rows = in_days(one_day, window_start(day, length), day)
    return _summed(_counted(rows, keys, measures, 1), keys, measures)


def moving_next(state: DataFrame, entering: DataFrame, leaving: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The state one day on: reads two days of rows and the state, however long the window is.

    ``state`` is yesterday's, ``entering`` today's one-day rows, ``leaving`` those of the day that is out of the window from
    today on, both as stored when they were added. Sums are exact (whole numbers and decimals only). A key whose last row
    leaves is gone, one whose values are all missing stays without a sum; ``n_rows`` and ``n_<measure>`` count for that.
    """
    for m in measures:
        if not dict(entering.dtypes)[m].startswith(("decimal", "bigint", "int")):
            raise TypeError(f"{m} cannot be subtracted exactly")
    changes = state.unionByName(_counted(entering, keys, measures, 1)).unionByName(_counted(leaving, keys, measures, -1))
    return _summed(changes, keys, measures)


def moving_corrected(state: DataFrame, before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The state when a day inside its window is replaced: what the day held goes, what it holds now comes."""
    return moving_next(state, after, before, keys, measures)


def moving_rows(state: DataFrame, day: str, measures: Sequence[str], length: int) -> DataFrame:
    """The table of a moving total, as :func:`rolling` gives it for one window."""
    counts = {f"n_{m}" for m in measures} | {"n_rows"}
    keys = [c for c in state.columns if c not in counts and c not in measures]
    sums = []
    for m in measures:
        value = money(m) if dict(state.dtypes)[m].startswith("decimal") else F.col(m)
        sums.append(F.when(F.col(f"n_{m}") > 0, value).alias(m.removesuffix("_1d") + f"_{length}d"))
    return state.select(*keys, *sums, F.lit(day).alias("dt"))
