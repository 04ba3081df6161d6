"""Headline queries at one scale: each runs twice and the second time counts. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from martline.plans.catalog import QUERIES
from martline.session import build_session

HEADLINE = [
    "a1_user_sku_order_1d_first_day", "a2_user_order_1d_first_day", "a4_user_payment_1d",
    "a5_province_order_1d_first_day", "a6_user_coupon_used_1d", "a8_session_page_view_1d", "a10_user_sku_order_nd",
    "a12_user_order_td", "a13_user_login_td", "d1_dim_sku", "d8b_scd2_merge", "d8c_scd2_join_as_of",
    "f2_fact_order_detail_first_day", "f3_fact_payment_success_first_day", "f5_fact_trade_flow",
    "f5_fact_trade_flow_first_day", "f8_fact_page_view", "f10_fact_login", "p1_traffic_by_channel",
    "p2_page_path_all_days", "p3_user_change", "p4_user_retention", "p6_user_action", "p7_new_order_user_stats",
    "p8_order_continuously_user_count", "p9_repeat_purchase_by_tm", "p10_order_stats_by_tm",
    "p11_order_stats_by_cate", "p12_order_by_province", "p14_cart_num_top3_by_cate",
    "p16_order_to_pay_interval_avg", "p17_order_stats_by_tm_direct", "p20_new_order_user_direct",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            # Each table here is one row group, so one task scans it. A threshold scaled down with the data keeps the
            # plans of large tables: fact joins shuffle, which also puts every core to work after the scan.
            "spark.sql.autoBroadcastJoinThreshold": "1m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = seconds(spark, name, sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
