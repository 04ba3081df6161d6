from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from martline.operators import facts, reports, rollups
from martline.plans import streams
from martline.streaming import stateful
from martline.streaming.order_flow import OrderFlow, _decoded, _feed, _of

HOUR, DAY = 3_600_000, 86_400_000


@pytest.fixture
def source(spark, tmp_path):
    """A folder that gets one file per batch, and its stream."""
    folder = tmp_path / "in"
    folder.mkdir()

    def put(n, rows):
        file = folder / f"{n:03d}.json"
        file.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))  # files are read in this order

    def stream(schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))

    return put, stream


def test_repeats_go_late_rows_are_counted_and_state_stays_bounded(spark, tmp_path, source):
    put, stream = source
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    late = stateful.LateRows(spark, str(tmp_path / "late"))
    sizes = []

    def run():
        rows = stream("id string, ts long").withColumn("at", stateful.event_time("ts"))
        query = stateful.start_appending(stateful.first_of_key(rows, ["id"], "at", "2 hours"), out, ck, once=True)
        query.awaitTermination()
        for p in query.recentProgress:
            late.note(str(p.id), p.batchId, [s.numRowsDroppedByWatermark for s in p.stateOperators])
            sizes.extend(s.numRowsTotal for s in p.stateOperators)
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    for n in range(6):
        rows = [{"id": f"{n}-{k}", "ts": DAY + n * 6 * HOUR + k * 1000} for k in range(50)]
        put(n, rows + rows[:20] + [{"id": f"{n - 3}-49", "ts": DAY + (n - 3) * 6 * HOUR + 49_000}] * (n > 2))
    expected = sorted(f"{n}-{k}" for n in range(6) for k in range(50))
    assert run() == expected
    assert max(sizes) <= 150  # two batches' keys, never all 300
    assert late.count().agg(F.sum("late")).first()[0] == 3
    assert run() == expected  # nothing new
    put(7, [{"id": "5-3", "ts": DAY + 30 * HOUR + 3000}, {"id": "new", "ts": DAY + 31 * HOUR}])  # a repeat over a restart
    assert run() == sorted([*expected, "new"])


def test_traffic_of_closed_days_equals_the_report(spark, tmp_path, source):
    put, stream = source
    fields = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel", "during_time", "ts"]
    rows = []
    for k in range(400):
        mid, day = f"m{k % 23}", k * 4 // 400
        rows.append([None if k % 50 == 7 else f"s{k % 37}-{day}", mid, "b", f"md{k % 2}", "os", "v", None if k % 31 == 3 else f"ch{k % 3}", None if k % 17 == 0 else 1000 * k, 16 * HOUR + day * DAY + (k % 100) * 800_000])
    for n in range(4):
        put(n, [dict(zip(fields, r, strict=True)) for r in rows[n * 100 : n * 100 + 100]])
    put(5, [dict(zip(fields, rows[0][:-1] + [16 * HOUR + 9 * DAY], strict=True)), dict(zip(fields, rows[5][:-1] + [17 * HOUR], strict=True))])
    put(6, [dict(zip(fields, rows[0][:-1] + [16 * HOUR + 9 * DAY], strict=True)), dict(zip(fields, rows[5], strict=True))])
    schema = ", ".join(f"{f} {'long' if f in ('ts', 'during_time') else 'string'}" for f in fields)
    views = stream(schema).withColumn("at", stateful.event_time("ts"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    query = stateful.start_appending(stateful.channel_traffic(views, "at", "1 hour", offset="16 hours"), out, ck, once=True)
    query.awaitTermination()
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 2  # the old rows of the last two batches
    got = spark.read.parquet(out).withColumn("dt", F.date_add(F.to_date("window_start"), 1).cast("string"))
    daily = spark.createDataFrame([(*r, f"1970-01-0{2 + (r[-1] - 16 * HOUR) // DAY}") for r in rows], f"{schema}, dt string")
    columns = ["channel", "uv_count", "avg_duration_sec", "avg_page_count", "sv_count", "bounce_rate"]
    for day in ("1970-01-02", "1970-01-03", "1970-01-04", "1970-01-05"):
        report = reports.traffic_by_channel(rollups.session_page_view_1d(daily, day), day, [1])
        a = sorted(map(str, report.select(*columns).collect()))
        b = sorted(map(str, got.where(F.col("dt") == day).select(*columns).collect()))
        assert a == b and a, day


def changes(n):
    """Orders, payments and finishes of ``n`` orders as the topic has them."""
    out = []
    for k in range(n):
        t = f"2022-06-08 {k % 24:02d}:00:00"
        order = {"id": str(k), "user_id": str(k % 7), "province_id": "1", "create_time": t, "original_total_amount": "10.50", "total_amount": "9.50"}
        out.append(("order_info", {"type": "insert", "ts": k, "data": order}))
        if k % 3:
            pay = {"order_id": str(k), "payment_status": "1602", "callback_time": t, "total_amount": "9.50"}
            out.append(("payment_info", {"type": "update", "ts": k, "data": pay, "old": {"payment_status": "1601"}}))
        if k % 4 == 1:
            out.append(("order_status_log", {"type": "insert", "ts": k, "data": {"order_id": str(k), "order_status": "1004", "create_time": t}}))
    return [(table, json.dumps(body)) for table, body in out]


@pytest.mark.parametrize("fold_every", [2, 50])
def test_order_flow_in_batches_equals_one_run(spark, tmp_path, rows, fold_every):
    every = changes(40)
    whole = spark.createDataFrame(every, "table string, value string")
    once = facts.fact_trade_flow(None, *[_feed(whole, t) for t in ("order_info", "payment_info", "order_status_log")], None)
    flow = OrderFlow(spark, str(tmp_path / "flow"), fold_every)
    # payments come before orders for some; finishes come with or after payments
    batches = [every[0:30:2], every[1:30:2], every[30:50] + every[3:9], every[50:], [], every[:4]]
    batches[0], late = [c for c in batches[0] if c[0] != "order_status_log"], [c for c in batches[0] if c[0] == "order_status_log"]
    batches[3] = batches[3] + late
    for n, part in enumerate(batches):
        df = spark.createDataFrame(part, "table string, value string")
        flow.batch(df, n)
        if n in (1, 3):  # replayed
            before = rows(flow.current())
            flow.batch(df, n)
            assert rows(flow.current()) == before
    assert rows(flow.current()) == rows(once)
    assert len(rows(flow.current(1))) < 40


def test_order_flow_as_a_stream(spark, tmp_path, source, rows):
    put, stream = source
    every = changes(24)
    for n in range(3):
        put(n, [{"table": t, "value": v} for t, v in every[n::3]])
    flow = OrderFlow(spark, str(tmp_path / "flow"))
    for _again in range(2):
        flow.start(stream("table string, value string"), str(tmp_path / "ck"), once=True).awaitTermination()
    whole = spark.createDataFrame(every, "table string, value string")
    once = facts.fact_trade_flow(None, *[_feed(whole, t) for t in ("order_info", "payment_info", "order_status_log")], None)
    paid = [r for r in rows(once, "order_id", "payment_time", "dt") if r[1] or r[2] == "9999-12-31"]
    got = rows(flow.current(), "order_id", "payment_time", "dt")
    assert {r[0] for r in got} == {r[0] for r in rows(once, "order_id")} and {r for r in got if r[2] == "9999-12-31"} <= set(paid)


def test_batches_arrive_one_by_one_in_files_sized_from_the_data(spark, tmp_path):
    # the first batch has one row and the third none: neither takes rows of the next batch along
    numbers = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows = numbers.withColumn("n", F.when(F.col("id") == 0, 0).when(F.col("id") % 2 == 0, 1).otherwise(3))
    small = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(small)
    spark.conf.set(small, "100k")
    try:
        seen, folders = [], []
        for stream, folder in streams._arriving(rows):
            folders.append(folder)
            query = stream.writeStream.foreachBatch(lambda df, n: seen.append((n, df.count(), df.agg(F.sum("id")).first()[0])))
            query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(small, kept)
    even = 2 * sum(range(1, 10_000))
    assert seen == [(0, 1, 0), (1, 9_999, even), (2, 10_000, even + 10_000)]
    assert [f and f[-1] for f in folders] == ["0", "1", "3", None]
    assert len(spark.read.parquet(folders[2]).inputFiles()) > 2


def test_changes_decoded_once_equal_those_of_each_table(spark):
    odd = [
        ("order_info", '{"type": "insert", "data": {"id": 5, "user_id": "1", "total_amount": 9.5, "surplus": [1, {"a": 2}]}}'),
        ("order_info", '{"type": "insert", "data": {"id": "6", "total_amount": "no number"'), ("order_info", "no json"),
        ("payment_info", '{"type": "update", "data": {"order_id": "5", "payment_status": "1602"}, "old": {"payment_status": null}}'),
        ("payment_info", '{"type": "update", "data": null, "old": {"payment_status": "1601"}}'), ("payment_info", None),
        ("order_status_log", '{"type": "insert", "data": {"order_id": "5", "order_status": "1004", "create_time": "2022-06-08 01:00:00"}}'),
    ]
    rows = spark.createDataFrame(odd + changes(9), "table string, value string")
    keyed = _decoded(rows.withColumn("order_id", F.lit("k")))
    for table in ("order_info", "payment_info", "order_status_log"):
        a, b = _of(keyed, table), _feed(rows, table)
        used = ["type", "old", *[f"data.{c}" for c in a.schema["data"].dataType.fieldNames() if c in b.schema["data"].dataType.fieldNames()]]
        assert sorted(map(str, a.select(*used).collect())) == sorted(map(str, b.select(*used).collect()))
        assert len(used) > 4
    waiting = keyed.where(F.col("table") != "order_info").select("table", "value").collect()
    assert sorted(map(str, waiting)) == sorted(map(str, rows.where(F.col("table") != "order_info").collect()))
