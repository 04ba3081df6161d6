from __future__ import annotations

import json
import shutil

from test_daily import FIRST, SECOND, SNAPSHOTS, finished, land, lines, merged, order, paid, user, visit

from martline.functions.dates import shift
from martline.operators import sinks
from martline.plans import daily, reruns
from martline.plans.daily import Warehouse


def landing(root):
    boot = "bootstrap-insert"
    land(root, FIRST, merged(user(boot, 1, "ann", "2022-06-01"), order(boot, 1, "u1", "2022-06-07"), paid(1, "2022-06-07", first=True)),
         [visit("u1", "s1", 0, "home", 0)], SNAPSHOTS)
    land(root, SECOND, merged(user("update", 1, "anna", SECOND), order("insert", 3, "u1", SECOND), finished(1, SECOND)), [visit("u1", "s2", 1, "home", 0)], SNAPSHOTS)


def late(root):
    """One order line and its order, and one page view, of the second day."""
    for table, entries in order("insert", 9, "u1", SECOND).items():
        texts = [json.dumps({"type": kind, "ts": 99, "data": data, "old": old}) for kind, data, old in entries]
        lines(root / "db" / f"table={table}_inc" / f"dt={SECOND}", "late.json", texts)
    lines(root / "log" / f"dt={SECOND}", "late.json", [json.dumps(visit("u8", "s8", 1, "home", 3))])


def test_late_rows_run_their_day_again(spark, tmp_path, rows):
    landed, tables, other = tmp_path / "landed", tmp_path / "tables", tmp_path / "other"
    landing(landed)
    w = Warehouse(spark, str(tables))
    reruns.run_noted(w, str(landed), FIRST, first_day=True)
    shutil.copytree(tables, other)
    reruns.run_noted(w, str(landed), SECOND)
    assert reruns.stale_days(w, str(landed)) == []
    late(landed)
    assert reruns.rerun(w, str(landed)) == [SECOND]
    fresh = Warehouse(spark, str(other))
    daily.run_day(fresh, str(landed), SECOND)
    for table in ("ads_order_stats_by_tm", "ads_traffic_stats_by_channel", "dws_trade_user_order_td", "dws_user_user_login_td", "dwd_trade_order_detail_inc"):
        assert rows(w.read(table)) == rows(fresh.read(table)), table
    users = [rows(sinks.read_history(spark, x.path("dwd_trade_trade_flow_acc"), SECOND, daily.TRADE_FLOW)) for x in (w, fresh)]
    assert users[0] == users[1] and len(users[0]) == 3


def test_later_days_run_again_and_earlier_ones_do_not(spark, tmp_path, monkeypatch):
    landed, ran = tmp_path / "landed", []
    days = [shift(FIRST, k) for k in range(5)]
    for day in days:
        lines(landed / "log" / f"dt={day}", "a.json", ["{}"])
    monkeypatch.setattr(daily, "run_day", lambda _w, _landed, day, first_day=False: ran.append((day, first_day)))
    w = Warehouse(spark, str(tmp_path / "tables"))
    for day in days[:4]:
        reruns.run_noted(w, str(landed), day, first_day=day == FIRST)
    ran.clear()
    assert reruns.rerun(w, str(landed)) == [] == ran
    lines(landed / "log" / f"dt={days[4]}", "b.json", ["{}"])  # has not run yet
    lines(landed / "db" / "table=x_inc" / f"dt={days[2]}", "late.json", ["{}"])
    assert reruns.stale_days(w, str(landed)) == [days[2]]
    assert reruns.rerun(w, str(landed)) == days[2:4] and ran == [(d, False) for d in days[2:4]]
    assert reruns.rerun(w, str(landed)) == []
    (landed / "log" / f"dt={FIRST}" / "a.json").unlink()
    lines(landed / "log" / f"dt={FIRST}", "c.json", ["{}"])
    ran.clear()
    assert reruns.rerun(w, str(landed)) == days[:4] and ran[0] == (FIRST, True) and not any(f for _, f in ran[1:])
