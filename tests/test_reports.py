from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import Decimal

from martline.functions.dates import shift
from martline.operators import reports, rollups
from martline.operators.ranking import top_ranked

DAY = "2022-06-08"


def login_td(spark, entries):
    return spark.createDataFrame(
        entries, "user_id string, login_date_last string, login_date_first string, login_count_td bigint, dt string"
    )


def test_user_change_worked_dates(spark, rows):
    """Lost: last login exactly on the first. Back: logged in on the eighth after being away since the month before."""
    td = login_td(spark, [
        ("lost", "2022-06-01", "2022-05-01", 1, DAY), ("lost long ago", "2022-05-31", "2022-05-01", 1, DAY),
        ("active", "2022-06-02", "2022-05-01", 1, DAY),
        ("back", DAY, "2022-05-01", 2, DAY), ("back", "2022-05-31", "2022-05-01", 1, shift(DAY, -1)),
        ("not away", DAY, "2022-05-01", 2, DAY), ("not away", "2022-06-01", "2022-05-01", 1, shift(DAY, -1)),
        ("new", DAY, DAY, 1, DAY),
    ])
    assert rows(reports.user_change(td, DAY)) == [(DAY, 1, 1)]


def test_user_change_of_an_empty_day(spark, rows):
    assert rows(reports.user_change(login_td(spark, []), DAY)) == [(DAY, 0, 0)]


def test_retention_and_stats(spark, rows):
    td = login_td(spark, [
        ("a", DAY, "2022-06-07", 2, DAY), ("b", "2022-06-07", "2022-06-07", 1, DAY), ("c", DAY, "2022-06-07", 2, DAY),
        ("d", DAY, "2022-06-01", 2, DAY), ("e", DAY, "2022-05-31", 2, DAY), ("f", DAY, DAY, 1, DAY),
    ])
    assert rows(reports.user_retention(td, DAY)) == [
        (DAY, "2022-06-01", 7, 1, 1, Decimal("100.00")), (DAY, "2022-06-07", 1, 2, 3, Decimal("66.67")),
    ]
    assert rows(reports.user_stats(td, DAY)) == [(DAY, 1, 1, 5), (DAY, 30, 6, 6), (DAY, 7, 4, 6)]


def orders_on(spark, days_of_users):
    entries = [(user, shift(DAY, -back)) for user, backs in days_of_users.items() for back in backs]
    return spark.createDataFrame(entries, "user_id string, dt string")


def test_consecutive_days(spark, rows):
    orders = orders_on(spark, {
        "three": [0, 1, 2], "four": [3, 4, 5, 6], "gap": [0, 1, 3, 4, 6], "two": [0, 1], "outside": [5, 6, 7],
        None: [0, 1, 2],
    })
    assert rows(reports.order_continuously_user_count(orders, DAY)) == [(DAY, 7, 2)]
    assert rows(reports.order_continuously_user_count(orders, DAY, run=2)) == [(DAY, 7, 5)]


def test_days_in_a_row_over_any_span(spark, rows):
    days = {"one": [0], "far": [0, 66, 90], "run": [70, 71, 72], "early": [88, 89], "twice": [64, 64, 65, 66]}
    df = spark.createDataFrame([(u, shift(DAY, -d)) for u, ds in days.items() for d in ds] + [(None, DAY)], "user_id string, dt string")
    assert rows(reports.order_continuously_user_count(df, DAY, span=64)) == [(DAY, 64, 0)]
    assert rows(reports.order_continuously_user_count(df, DAY, span=90)) == [(DAY, 90, 2)]
    assert rows(reports.order_continuously_user_count(df, DAY, run=2, span=90)) == [(DAY, 90, 3)]
    assert rows(reports.order_continuously_user_count(df, DAY, run=1, span=1)) == [(DAY, 1, 2)]


def test_top_ranked_keeps_ties_and_missing_groups(spark, rows):
    random.seed(5)
    items = [(random.choice(["a", "b", None]), random.choice([1, 1, 2, 3, None]), i) for i in range(400)]
    items += [("c", 7, 1000), ("c", 6, 1001), ("c", 6, 1002), ("c", 5, 1003)]
    df = spark.createDataFrame(items, "g string, v bigint, id int")
    expected = []
    for g, v, i in items:
        rank = 1 + sum(1 for h, w, _ in items if h == g and w is not None and (v is None or w > v))
        if rank <= 3:
            expected.append((g, v, i, rank))
    ours = rows(top_ranked(df, "g", "v", 3), "g", "v", "id", "rk")
    assert ours == sorted(expected, key=lambda r: tuple((x is not None, str(x)) for x in r))


def paths_by_hand(views):
    sessions, counts = defaultdict(list), Counter()
    for session, time, ts, page in views:
        sessions[session].append((time, ts, (page is not None, page), page))
    for steps in sessions.values():
        pages = [s[3] for s in sorted(steps, key=lambda s: s[:3])]
        for i, page in enumerate(pages, 1):
            after = pages[i] if i < len(pages) else "out"
            source = None if page is None else f"step-{i}:{page}"
            target = None if after is None else f"step-{i + 1}:{after}"
            counts[(DAY, source, target)] += 1
    return sorted(((*k, n) for k, n in counts.items()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_page_path_with_one_session_that_holds_a_third_of_all_rows(spark, rows):
    random.seed(3)
    views = []
    for i in range(900):
        session = random.choice(["hot", f"s{i % 40}", None if i % 7 == 0 else f"s{i % 40}"])
        minute, second = random.randrange(1440), random.randrange(60)
        time = f"{DAY} {minute // 60:02d}:{minute % 60:02d}:{second:02d}"
        views.append((session, time, i, random.choice(["home", "cart", "pay", None])))
    df = spark.createDataFrame(
        [(*v, DAY) for v in views], "session_id string, view_time string, ts bigint, page_id string, dt string"
    )
    assert rows(reports.page_path(df, DAY)) == paths_by_hand(views)


def test_traffic_windows_against_brute_force(spark, rows):
    random.seed(11)
    sessions = [
        (f"s{i // 2}", random.choice(["m1", "m2", "m3", None]), random.choice(["web", "app", None]),
         random.randrange(5000), random.choice([1, 2, 3]), shift(DAY, -random.randrange(40)))
        for i in range(300)
    ]
    df = spark.createDataFrame(
        sessions, "session_id string, mid_id string, channel string, during_time_1d bigint, page_count_1d bigint, dt string"
    )
    expected = []
    for length in (1, 7, 30):
        for channel in ("web", "app", None):
            inside = [s for s in sessions if s[2] == channel and shift(DAY, 1 - length) <= s[5] <= DAY]
            if inside:
                seen = len({s[0] for s in inside})
                bounced = sum(s[4] == 1 for s in inside)
                rate = (Decimal(bounced) / seen).quantize(Decimal("0.01"), "ROUND_HALF_UP")
                expected.append((
                    DAY, length, channel, len({s[1] for s in inside} - {None}),
                    sum(s[3] for s in inside) // (1000 * len(inside)), sum(s[4] for s in inside) // len(inside),
                    seen, rate,
                ))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(reports.traffic_by_channel(df, DAY)) == sorted(expected, key=key)
    assert rows(reports.weekly_traffic(df, DAY)) == sorted((r for r in expected if r[1] == 7), key=key)
    assert all(r[1] == 30 for r in rows(reports.monthly_traffic(df, DAY)))


def test_funnel_and_interval(spark, rows):
    pages = spark.createDataFrame(
        [("m1", "home", DAY), ("m2", "home", DAY), ("m1", "good_detail", DAY), ("m1", "cart", DAY),
         ("m9", "home", shift(DAY, -1))], "mid_id string, page_id string, dt string",
    )
    users = orders_on(spark, {"u1": [0], "u2": [0, 1]})
    assert rows(reports.user_action(pages, users, users, users.where("user_id = 'u1'"), DAY)) == [(DAY, 2, 1, 2, 2, 1)]
    flow = spark.createDataFrame(
        [("9999-12-31", DAY, f"{shift(DAY, -1)} 23:59:50", f"{DAY} 00:00:10"), (DAY, DAY, f"{DAY} 01:00:00", f"{DAY} 01:00:31"),
         ("9999-12-31", None, f"{DAY} 01:00:00", None)],
        "dt string, payment_date_id string, order_time string, payment_time string",
    )
    assert rows(reports.order_to_pay_interval_avg(flow, DAY)) == [(DAY, 25)]


def lines(spark, seed=2, n=400):
    random.seed(seed)
    entries = []
    for i in range(n):
        order = random.randrange(120)
        amount = Decimal(random.randrange(100, 9999)) / 100
        entries.append((
            str(i), f"o{order}", f"u{order % 25}", f"s{random.randrange(8)}", f"p{order % 4}", random.randrange(1, 5),
            amount, Decimal("0.10"), Decimal("0.00"), amount, shift(DAY, -(order % 45)),
        ))
    return spark.createDataFrame(
        entries,
        "id string, order_id string, user_id string, sku_id string, province_id string, sku_num bigint,"
        " split_original_amount decimal(16,2), split_activity_amount decimal(16,2),"
        " split_coupon_amount decimal(16,2), split_total_amount decimal(16,2), dt string",
    )


def skus(spark):
    names = rollups.SKU_ATTRIBUTES
    entries = [(f"s{i}", *[f"{n}{i % 3}" for n in names], DAY) for i in range(7)]
    return spark.createDataFrame(entries, ", ".join(f"{n} string" for n in ["id", *names, "dt"]))


def test_to_date_day_by_day_equals_all_history(spark, rows):
    one_day = rollups.user_order_1d(lines(spark), None).cache()
    total = rollups.user_order_td_init(one_day, shift(DAY, -4))
    for back in (3, 2, 1, 0):
        total = rollups.user_order_td(total, one_day, shift(DAY, -back))
    assert rows(total) == rows(rollups.user_order_td_init(one_day, DAY))


def test_rolling_week_equals_a_sum_of_days(spark, rows):
    one_day = rollups.user_sku_order_1d(lines(spark), skus(spark), None, dim_day=DAY).cache()
    rolled = rollups.user_sku_order_nd(one_day, DAY)
    week = one_day.where(f"dt between '{shift(DAY, -6)}' and '{DAY}'").groupBy("user_id", "sku_id").agg(
        {"order_count_1d": "sum", "order_total_amount_1d": "sum"}
    )
    some = rolled.where("order_count_7d > 0").select("user_id", "sku_id", "order_count_7d", "order_total_amount_7d")
    assert rows(some) == rows(week, "user_id", "sku_id", "sum(order_count_1d)", "sum(order_total_amount_1d)")


def test_brand_report_from_summaries_and_from_lines_agree_on_buyers(spark, rows):
    detail, sku = lines(spark), skus(spark)
    one_day = rollups.user_sku_order_1d(detail, sku, None, dim_day=DAY).cache()
    nd = rollups.user_sku_order_nd(one_day, DAY)
    report = reports.order_stats_by_tm(one_day, nd, DAY)
    direct = reports.order_stats_by_tm_direct(detail, sku, DAY)
    shown = ("recent_days", "tm_id", "order_user_count")
    assert rows(report.where("order_count > 0"), *shown) == rows(direct, *shown)
    assert report.where("order_user_count > order_count").isEmpty()
    assert rows(reports.order_stats_by_tm_nd(one_day, nd, DAY)) == rows(report)


def test_first_buyers_from_summary_and_from_lines_agree(spark, rows):
    detail = lines(spark, seed=8)
    td = rollups.user_order_td_init(rollups.user_order_1d(detail, None), DAY)
    assert rows(reports.new_order_user_stats(td, DAY)) == rows(reports.new_order_user_direct(detail, DAY))


def test_history_load_equals_single_days(spark, rows):
    detail = lines(spark)
    assert rows(rollups.user_order_1d(detail, None).where(f"dt = '{DAY}'")) == rows(rollups.user_order_1d(detail, DAY))


def test_one_day_summary_needs_a_dimension_day(spark):
    import pytest

    with pytest.raises(ValueError):
        rollups.user_sku_order_1d(lines(spark), skus(spark), None)
