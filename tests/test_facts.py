from __future__ import annotations

from decimal import Decimal

from martline.functions.dates import OPEN_END
from martline.operators import facts

DAY, BEFORE = "2022-06-09", "2022-06-08"


def test_cart_add_counts_inserts_and_raises_only(feed, rows):
    cart = feed("cart_info", [
        ("insert", 1, {"id": "a", "sku_num": 2, "create_time": f"{DAY} 10:00:00"}, None, DAY),
        ("update", 2, {"id": "a", "sku_num": 5, "operate_time": f"{DAY} 11:00:00"}, {"sku_num": "2"}, DAY),
        ("update", 3, {"id": "b", "sku_num": 1, "operate_time": f"{DAY} 11:00:00"}, {"sku_num": "4"}, DAY),
        ("update", 4, {"id": "c", "sku_num": 9, "operate_time": f"{DAY} 11:00:00"}, {"is_checked": "0"}, DAY),
        ("update", 5, {"id": "d", "sku_num": 10, "operate_time": f"{DAY} 12:00:00"}, {"sku_num": "9"}, DAY),
        ("bootstrap-insert", 6, {"id": "e", "sku_num": 1, "create_time": f"{DAY} 12:00:00"}, None, DAY),
        ("insert", 7, {"id": "f", "sku_num": 1, "create_time": f"{BEFORE} 12:00:00"}, None, BEFORE),
        ("update", 8, {"id": "g", "sku_num": 10, "operate_time": f"{DAY} 12:00:00"}, {"sku_num": "x"}, DAY),
    ])
    assert rows(facts.fact_cart_add(cart, DAY), "id", "sku_num", "create_time") == [
        ("a", 2, f"{DAY} 10:00:00"), ("a", 3, f"{DAY} 11:00:00"), ("d", 1, f"{DAY} 12:00:00"),
    ]
    assert rows(facts.fact_cart_add(cart, DAY, first_day=True), "id", "sku_num", "dt") == [("e", 1, DAY)]


def order_feeds(feed):
    details = feed("order_detail", [
        ("insert", 1, {"id": "1", "order_id": "o1", "sku_id": "s", "sku_num": 2, "order_price": Decimal("10.00"),
                       "split_total_amount": Decimal("18.00"), "split_activity_amount": Decimal("2.00")}, None, BEFORE),
        ("insert", 1, {"id": "2", "order_id": "o2", "sku_id": "s", "sku_num": 1, "order_price": Decimal("5.00"),
                       "split_total_amount": Decimal("5.00")}, None, DAY),
        ("insert", 1, {"id": "3", "order_id": "o0", "sku_id": "s", "sku_num": 1, "order_price": Decimal("7.00"),
                       "split_total_amount": Decimal("7.00")}, None, "2022-06-07"),
    ])
    orders = feed("order_info", [
        ("insert", 1, {"id": o, "user_id": u, "province_id": "p", "create_time": f"{d} 23:50:00",
                       "total_amount": Decimal("18.00"), "original_total_amount": Decimal("20.00")}, None, d)
        for o, u, d in (("o1", "u1", BEFORE), ("o2", "u2", DAY), ("o0", "u0", "2022-06-07"))
    ])
    coupons = feed("order_detail_coupon", [("insert", 1, {"order_detail_id": "2", "coupon_id": "c"}, None, DAY)])
    activities = feed("order_detail_activity", [
        ("insert", 1, {"order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"}, None, BEFORE)
    ])
    return details, orders, coupons, activities


def test_order_detail_fills_missing_discounts(feed, rows):
    result = facts.fact_order_detail(*order_feeds(feed), DAY)
    assert rows(result, "id", "user_id", "coupon_id", "activity_id", "split_original_amount",
                "split_activity_amount", "split_coupon_amount", "date_id", "dt") == [
        ("2", "u2", "c", None, Decimal("5.00"), Decimal("0.00"), Decimal("0.00"), DAY, DAY)
    ]


def test_payment_across_midnight_and_lookback(spark, feed, rows):
    pay = feed("payment_info", [
        ("update", 1, {"order_id": o, "payment_type": "1101", "payment_status": status,
                       "callback_time": f"{DAY} 00:10:00", "total_amount": Decimal("18.00")}, old, DAY)
        for o, status, old in (
            ("o1", "1602", {"payment_status": "1601"}), ("o2", "1601", {"payment_status": "1600"}),
            ("o2", "1602", {"callback_content": "x"}), ("o0", "1602", {"payment_status": "1601"}),
        )
    ])
    dic = spark.createDataFrame([("1101", "card", "11", DAY), ("1101", "other", "32", DAY)],
                                "dic_code string, dic_name string, parent_code string, dt string")
    feeds = order_feeds(feed)
    result = facts.fact_payment_success(*feeds, pay, dic, DAY)
    columns = ("id", "user_id", "activity_id", "payment_type_name", "split_payment_amount", "dt")
    assert rows(result, *columns) == [("1", "u1", "a", "card", Decimal("18.00"), DAY)]
    wider = facts.fact_payment_success(*feeds, pay, dic, DAY, lookback_days=2, allocate=True)
    assert rows(wider, "id", "split_payment_amount") == [("1", Decimal("18.00")), ("3", Decimal("7.00"))]


def flow_day(feed, before, day, orders=(), paid=(), finished=(), first_day=False):
    kind = "bootstrap-insert" if first_day else "insert"
    order_feed = feed("order_info", [
        (kind, 1, {"id": o, "create_time": f"{day} 08:00:00", "total_amount": Decimal(9)}, None, day) for o in orders
    ])
    pay = feed("payment_info", [
        ("bootstrap-insert" if first_day else "update", 1,
         {"order_id": o, "payment_status": "1602", "callback_time": f"{day} 08:00:30", "total_amount": Decimal(9)},
         {"payment_status": "1601"}, day) for o in paid
    ])
    log = feed("order_status_log", [
        ("insert", 1, {"order_id": o, "order_status": "1004", "create_time": f"{day} 20:00:00"}, None, day)
        for o in finished
    ])
    return facts.fact_trade_flow(before, order_feed, pay, log, day, first_day)


def test_trade_flow_milestones_over_days_and_again(feed, rows):
    columns = ("order_id", "order_date_id", "payment_date_id", "finish_date_id", "dt")
    first = flow_day(feed, None, "2022-06-08", orders=["a", "b"], paid=["a"], first_day=True)
    second = flow_day(feed, first, "2022-06-09", orders=["c"], paid=["b"], finished=["a"])
    assert rows(second, *columns) == [
        ("a", "2022-06-08", "2022-06-08", "2022-06-09", "2022-06-09"),
        ("b", "2022-06-08", "2022-06-09", None, OPEN_END),
        ("c", "2022-06-09", None, None, OPEN_END),
    ]
    again = flow_day(feed, first, "2022-06-09", orders=["c"], paid=["b"], finished=["a"])
    assert rows(again) == rows(second)
    still_open = second.where(f"dt = '{OPEN_END}'")
    third = flow_day(feed, still_open, "2022-06-10", finished=["b"])
    assert rows(third, *columns) == [
        ("b", "2022-06-08", "2022-06-09", "2022-06-10", "2022-06-10"),
        ("c", "2022-06-09", None, None, OPEN_END),
    ]


EVENT = {"common": {"mid": "m", "uid": "u", "sid": "s", "ch": "web"}, "page": {"page_id": "home", "during_time": "900"}}


def test_page_view_uses_the_log_zone_not_the_session_zone(spark, log, rows):
    late = 1654704000000 - 1  # one millisecond before midnight in the log's zone
    events = [{**EVENT, "ts": late, "dt": DAY}, {**EVENT, "ts": late + 1, "dt": DAY},
              {"start": {"entry": "icon"}, "ts": late, "dt": DAY}]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        views = facts.fact_page_view(log(events), DAY)
        assert rows(views, "date_id", "view_time", "during_time") == [
            ("2022-06-08", "2022-06-08 23:59:59", 900), ("2022-06-09", "2022-06-09 00:00:00", 900),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_login_is_the_first_event_with_a_user(log, rows):
    def event(sid, uid, ts, ch):
        return {"common": {"sid": sid, "uid": uid, "ch": ch}, "page": {"page_id": "home"}, "ts": ts, "dt": DAY}

    events = [event("s1", None, 1, "a"), event("s1", "u1", 3000, "b"), event("s1", "u1", 2000, "c"),
              event(None, "u2", 5000, "d"), event(None, "u3", 4000, "e"),
              {"common": {"sid": "s9", "uid": "u9"}, "start": {"entry": "icon"}, "ts": 1, "dt": DAY}]
    assert rows(facts.fact_login(log(events), DAY), "user_id", "channel") == [("u1", "c"), ("u3", "e")]


def test_register_keeps_users_without_a_page_and_can_drop_repeats(feed, log, rows):
    users = feed("user_info", [
        ("insert", 1, {"id": u, "create_time": f"{DAY} 01:00:00"}, None, DAY) for u in ("u1", "u2")
    ] + [("update", 1, {"id": "u3", "create_time": f"{DAY} 01:00:00"}, None, DAY)])
    pages = log([
        {"common": {"uid": "u1", "ch": ch}, "page": {"page_id": "register"}, "ts": ts, "dt": DAY}
        for ts, ch in ((2, "late"), (1, "early"))
    ])
    assert rows(facts.fact_register(users, pages, DAY), "user_id", "channel") == [
        ("u1", "early"), ("u1", "late"), ("u2", None)
    ]
    assert rows(facts.fact_register(users, pages, DAY, dedup=True), "user_id", "channel") == [
        ("u1", "early"), ("u2", None)
    ]


def test_coupon_and_favor(feed, rows):
    coupons = feed("coupon_use", [
        ("update", 1, {"id": "1", "used_time": f"{DAY} 01:00:00"}, {"used_time": None}, DAY),
        ("update", 1, {"id": "2"}, {"using_time": None}, DAY),
        ("bootstrap-insert", 1, {"id": "3", "used_time": f"{BEFORE} 01:00:00"}, None, DAY),
        ("bootstrap-insert", 1, {"id": "4"}, None, DAY),
    ])
    assert rows(facts.fact_coupon_used(coupons, DAY), "id", "dt") == [("1", DAY)]
    assert rows(facts.fact_coupon_used(coupons, DAY, first_day=True), "id", "dt") == [("3", BEFORE)]
    favors = feed("favor_info", [
        (kind, 1, {"id": kind, "create_time": f"{DAY} 01:00:00"}, None, DAY) for kind in ("insert", "update")
    ])
    assert rows(facts.fact_favor_add(favors, DAY), "id") == [("insert",)]
