"""Three days from landed files to reports, and the same days again."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from martline.functions.dates import OPEN_END, shift
from martline.operators import sinks
from martline.plans import daily
from martline.plans.daily import TRADE_FLOW, USER_ZIP, Warehouse
from martline.sources import schemas

FIRST = "2022-06-08"
SECOND, THIRD = shift(FIRST, 1), shift(FIRST, 2)
NOON = 1654660800000  # noon of the first day in the log's zone


def lines(folder, name, texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{t}\n" for t in texts))


def land(root, day, changes, events, snapshots):
    lines(root / "log" / f"dt={day}", "a.json", [json.dumps(e) for e in events])
    for table in schemas.FEED_DATA:
        entries = [
            json.dumps({"type": kind, "ts": i, "data": data, "old": old})
            for i, (kind, data, old) in enumerate(changes.get(table, []))
        ]
        lines(root / "db" / f"table={table}_inc" / f"dt={day}", "a.json", entries)
    for table, schema in schemas.SNAPSHOTS.items():
        texts = [
            "\t".join(str(r.get(f, "")) for f in schema.fieldNames()) for r in snapshots.get(table, [])
        ]
        lines(root / "full" / f"{table}_full" / f"dt={day}", "a.tsv", texts)


def order(kind, number, user, day, price=10):
    info = {"id": f"o{number}", "user_id": user, "province_id": "1", "create_time": f"{day} 09:00:00",
            "total_amount": price * 2, "original_total_amount": price * 2}
    return {
        "order_info": [(kind, info, None)],
        "order_detail": [
            (kind, {"id": f"d{number}{sku}", "order_id": f"o{number}", "sku_id": sku, "order_price": price,
                    "sku_num": 1, "split_total_amount": price}, None) for sku in ("1", "2")
        ],
    }


def paid(number, day, first=False):
    data = {"order_id": f"o{number}", "payment_type": "1101", "payment_status": "1602", "total_amount": 20,
            "callback_time": f"{day} 09:01:00"}
    return {"payment_info": [("bootstrap-insert" if first else "update", data, {"payment_status": "1601"})]}


def finished(number, day):
    return {"order_status_log": [
        ("insert", {"order_id": f"o{number}", "order_status": "1004", "create_time": f"{day} 22:00:00"}, None)
    ]}


def user(kind, number, name, day):
    return {"user_info": [(kind, {"id": f"u{number}", "name": name, "create_time": f"{day} 07:00:00"}, None)]}


def merged(*parts):
    result = {}
    for part in parts:
        for table, entries in part.items():
            result.setdefault(table, []).extend(entries)
    return result


def visit(uid, sid, day_index, page, step, stay="2000"):
    return {"common": {"mid": f"m{uid}", "uid": uid, "sid": sid, "ch": "web", "ar": "1"},
            "page": {"page_id": page, "during_time": stay}, "ts": NOON + day_index * 86400000 + step * 1000}


SNAPSHOTS = {
    "sku_info": [{"id": i, "spu_id": "1", "price": "10.00", "sku_name": f"sku{i}", "weight": "1.00", "tm_id": i,
                  "category3_id": "1", "is_sale": "1"} for i in "12"],
    "spu_info": [{"id": "1", "spu_name": "spu", "category3_id": "1", "tm_id": "1"}],
    "base_category1": [{"id": "1", "name": "c1"}],
    "base_category2": [{"id": "1", "name": "c2", "category1_id": "1"}],
    "base_category3": [{"id": "1", "name": "c3", "category2_id": "1"}],
    "base_trademark": [{"id": i, "tm_name": f"tm{i}"} for i in "12"],
    "sku_attr_value": [{"id": "1", "attr_id": "1", "value_id": "1", "sku_id": "1", "attr_name": "a", "value_name": "v"}],
    "base_province": [{"id": "1", "name": "prov", "region_id": "1", "area_code": "1"}],
    "base_region": [{"id": "1", "region_name": "reg"}],
    "base_dic": [{"dic_code": "1101", "dic_name": "card", "parent_code": "11"}],
    "cart_info": [{"id": str(i), "user_id": "u1", "sku_id": s, "sku_num": n, "is_ordered": o}
                  for i, (s, n, o) in enumerate([("1", 3, "0"), ("2", 5, "0"), ("2", 9, "1")])],
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    landed = root / "landed"
    boot = "bootstrap-insert"
    land(landed, FIRST, merged(
        user(boot, 1, "ann", "2022-06-01"), user(boot, 2, "bob", "2022-06-02"), order(boot, 1, "u1", "2022-06-07"),
        paid(1, "2022-06-07", first=True), order(boot, 2, "u2", FIRST),
    ), [visit("u1", "s1", 0, "home", 0), visit("u1", "s1", 0, "good_detail", 5)], SNAPSHOTS)
    land(landed, SECOND, merged(
        user("update", 1, "anna", SECOND), user("insert", 3, "cy", SECOND), order("insert", 3, "u3", SECOND),
        order("insert", 4, "u1", SECOND), paid(2, SECOND), finished(1, SECOND),
        {"favor_info": [("insert", {"id": "1", "user_id": "u1", "sku_id": "2", "create_time": f"{SECOND} 10:00:00"}, None)]},
    ), [visit("u3", "s2", 1, "register", 0), visit("u3", "s2", 1, "home", 9), visit("u1", "s3", 1, "home", 0)], SNAPSHOTS)
    land(landed, THIRD, merged(
        user("update", 3, "cyd", THIRD), order("insert", 5, "u1", THIRD), paid(3, THIRD), finished(2, THIRD),
    ), [visit("u1", "s4", 2, "home", 0)], SNAPSHOTS)
    w = Warehouse(spark, str(root / "tables"))
    daily.run_day(w, str(landed), FIRST, first_day=True)
    daily.run_day(w, str(landed), SECOND)
    daily.run_day(w, str(landed), THIRD)
    return w, str(landed)


def everything(w, rows):
    """Contents of every table the days wrote."""
    spark = w.spark
    tables = {t: rows(w.read(t)) for t in [*schemas.REPORT_KEYS, "dws_trade_user_order_td", "dws_user_user_login_td",
                                            "dws_trade_user_sku_order_nd", "dwd_trade_pay_detail_suc_inc",
                                            "dwd_trade_order_detail_inc"]}
    for day in (FIRST, SECOND, THIRD):
        tables[f"zip {day}"] = rows(sinks.read_history(spark, w.path("dim_user_zip"), day, USER_ZIP))
        tables[f"flow {day}"] = rows(sinks.read_history(spark, w.path("dwd_trade_trade_flow_acc"), day, TRADE_FLOW))
    return tables


def test_results_of_three_days(built, rows):
    w, _ = built
    spark = w.spark
    zipper = sinks.read_history(spark, w.path("dim_user_zip"), THIRD, USER_ZIP)
    assert rows(zipper, "id", "name", "start_date", "end_date") == [
        ("u1", "ann", FIRST, FIRST), ("u1", "anna", SECOND, OPEN_END), ("u2", "bob", FIRST, OPEN_END),
        ("u3", "cy", SECOND, SECOND), ("u3", "cyd", THIRD, OPEN_END),
    ]
    flow = sinks.read_history(spark, w.path("dwd_trade_trade_flow_acc"), THIRD, TRADE_FLOW)
    assert rows(flow, "order_id", "payment_date_id", "finish_date_id", "dt") == [
        ("o1", "2022-06-07", SECOND, SECOND), ("o2", SECOND, THIRD, THIRD), ("o3", THIRD, None, OPEN_END),
        ("o4", None, None, OPEN_END), ("o5", None, None, OPEN_END),
    ]
    brands = w.read("ads_order_stats_by_tm").where(f"dt = '{THIRD}'")
    assert rows(brands, "recent_days", "tm_name", "order_count", "order_user_count") == [
        (1, "tm1", 1, 1), (1, "tm2", 1, 1), (30, "tm1", 5, 3), (30, "tm2", 5, 3), (7, "tm1", 5, 3), (7, "tm2", 5, 3),
    ]
    td = w.read("dws_trade_user_order_td").where(f"dt = '{THIRD}'")
    assert rows(td, "user_id", "order_date_first", "order_date_last", "order_count_td", "total_amount_td") == [
        ("u1", "2022-06-07", THIRD, 3, Decimal("60.00")), ("u2", FIRST, FIRST, 1, Decimal("20.00")),
        ("u3", SECOND, SECOND, 1, Decimal("20.00")),
    ]
    logins = w.read("dws_user_user_login_td").where(f"dt = '{THIRD}'")
    assert rows(logins, "user_id", "login_date_first", "login_date_last", "login_count_td") == [
        ("u1", "2022-06-01", THIRD, 4), ("u2", "2022-06-02", "2022-06-02", 1), ("u3", SECOND, SECOND, 1),
    ]
    assert rows(w.read("ads_order_to_pay_interval_avg")) == [(None, FIRST), (86460, SECOND), (86460, THIRD)]
    assert rows(w.read("ads_sku_cart_num_top3_by_cate").where(f"dt = '{THIRD}'"), "sku_id", "cart_num", "rk") == [
        ("1", 3, 2), ("2", 5, 1)
    ]
    assert rows(w.read("ads_page_path").where(f"dt = '{FIRST}'"), "source", "target", "path_count") == [
        ("step-1:home", "step-2:good_detail", 1), ("step-2:good_detail", "step-3:out", 1)
    ]
    assert rows(w.read("ads_user_action"), "dt", "home_count", "order_count", "payment_count") == [
        (FIRST, 1, 1, 0), (SECOND, 2, 2, 1), (THIRD, 1, 1, 1)
    ]


def test_running_days_again_changes_nothing(built, rows):
    w, landed = built
    before = everything(w, rows)
    daily.run_day(w, landed, SECOND)
    daily.run_day(w, landed, THIRD)
    after = everything(w, rows)
    for table, content in before.items():
        assert after[table] == content, table


def test_week_month_and_export(built, rows):
    w, _ = built
    daily.run_week(w, THIRD)
    daily.run_month(w, THIRD)
    assert rows(w.read("ads_traffic_stats_weekly"), "recent_days", "sv_count") == [(7, 4)]
    assert rows(w.read("ads_traffic_stats_monthly"), "recent_days", "sv_count") == [(30, 4)]
    staged, ran = [], []
    daily.export_reports(
        w, THIRD, "jdbc:x", stage=lambda r, _u, table, _p: staged.append(table),
        run=lambda _s, _u, statements, _p: ran.extend(statements),
    )
    assert staged == [f"{t}_staging" for t in schemas.REPORT_KEYS] and len(ran) == 32


def test_totals_need_the_day_before(built):
    w = built[0] if isinstance(built, tuple) else built
    with pytest.raises(sinks.EmptyPartition, match="dws_trade_user_order_td"):
        daily.build_summaries(w, shift(THIRD, 5))


def test_checks_stop_the_run(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    row = {f.name: None for f in USER_ZIP} | {"id": "7", "start_date": FIRST, "end_date": OPEN_END, "dt": OPEN_END}
    sinks.write_version(spark.createDataFrame([tuple(row.values())] * 2, USER_ZIP), w.path("dim_user_zip"), FIRST)
    with pytest.raises(sinks.FailedCheck, match="several open versions"):
        daily.check_dimensions(w, FIRST)
    order = {f.name: None for f in TRADE_FLOW} | {"order_id": "1", "dt": OPEN_END}
    sinks.write_version(spark.createDataFrame([tuple(order.values())] * 2, TRADE_FLOW), w.path("dwd_trade_trade_flow_acc"), FIRST)
    with pytest.raises(sinks.FailedCheck, match="open several times"):
        daily.check_facts(w, FIRST)
