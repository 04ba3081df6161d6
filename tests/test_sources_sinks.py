from __future__ import annotations

import gzip
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.dates import OPEN_END
from martline.operators import sinks
from martline.plans import scratch
from martline.sources import files, jdbc, schemas

DAY = "2022-06-08"


def write_gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")


def test_log_fields_may_be_missing_or_unknown(spark, tmp_path, rows):
    events = [{"common": {"mid": "m", "extra": 1}, "page": {}, "ts": 5}, {"ts": 6, "err": {"error_code": 3}}]
    write_gz(tmp_path / f"dt={DAY}" / "a.gz", [json.dumps(e) for e in events])
    log = files.read_log_json(spark, str(tmp_path), DAY)
    assert rows(log, "ts", "common.mid", "err.error_code", log["page"].isNotNull(), "dt") == [
        (5, "m", None, True, DAY), (6, None, 3, False, DAY),
    ]


def test_whole_numbers_may_be_quoted_and_a_bad_one_costs_only_itself(spark, tmp_path, rows):
    changes = [
        {"type": "insert", "ts": "7", "data": {"id": 1, "sku_num": "3", "cart_price": "1.50"}},
        {"type": "insert", "ts": 8, "data": {"id": "2", "sku_num": "many", "cart_price": 2}},
        {"type": "insert", "ts": 9},
    ]
    write_gz(tmp_path / f"dt={DAY}" / "a.gz", [json.dumps(c) for c in changes])
    feed = files.read_change_feed(spark, str(tmp_path), schemas.FEED_DATA["cart_info"], DAY)
    assert rows(feed, "ts", "data.id", "data.sku_num", "data.cart_price", feed["data"].isNull()) == [
        (7, "1", 3, Decimal("1.50"), False), (8, "2", None, Decimal("2.00"), False), (9, None, None, None, True),
    ]


def test_change_feed_of_one_table_under_a_common_root(spark, tmp_path, rows):
    change = {"type": "update", "ts": 1, "data": {"id": "1", "sku_num": 2}, "old": {"sku_num": None}}
    write_gz(tmp_path / "table=cart_info_inc" / f"dt={DAY}" / "a.gz", [json.dumps(change)])
    write_gz(tmp_path / "table=favor_info_inc" / f"dt={DAY}" / "a.gz", [json.dumps(change)])
    feed = files.read_change_feed(spark, str(tmp_path), schemas.FEED_DATA["cart_info"], DAY, table="cart_info")
    assert rows(feed, "type", "data.sku_num") == [("update", 2)]
    assert feed.selectExpr("map_contains_key(old, 'sku_num')").first()[0]


def test_tsv_has_no_quoting_and_empty_text_is_null(spark, tmp_path, rows):
    write_gz(tmp_path / f"dt={DAY}" / "a.gz", ['1\t\t3.50\ta "quoted" name'])
    schema = schemas.row("id spu_id price:d sku_name")
    assert rows(files.read_snapshot_tsv(spark, str(tmp_path), schema, DAY)) == [
        ("1", None, Decimal("3.50"), 'a "quoted" name', DAY)
    ]


def test_overwrite_partition_can_empty_a_day(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([(1, "2022-06-07"), (2, DAY)], "v int, dt string")
    sinks.overwrite_dynamic(two, path)
    sinks.overwrite_partition(two.where("false"), path, DAY)
    assert rows(files.read_table(spark, path)) == [(1, "2022-06-07")]
    sinks.check_partition(spark, path, "2022-06-07")
    with pytest.raises(sinks.EmptyPartition):
        sinks.check_partition(spark, path, DAY)


def test_versions_are_read_by_run(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), schemas.row("id dt")
    sinks.write_version(spark.createDataFrame([("a", "9999-12-31"), ("b", "9999-12-31")], "id string, dt string"), path, "2022-06-07")
    second = spark.createDataFrame([("a", "2022-06-07"), ("a2", "9999-12-31")], "id string, dt string")
    for _again in range(2):
        sinks.write_version(second, path, DAY)
    assert rows(sinks.read_version(spark, path, "2022-06-07", schema)) == [("a", "9999-12-31"), ("b", "9999-12-31")]
    assert rows(sinks.read_history(spark, path, DAY, schema)) == [("a", "2022-06-07"), ("a2", "9999-12-31")]
    sinks.write_version(second.where("false"), path, DAY)
    assert rows(sinks.read_history(spark, path, DAY, schema)) == []


def test_jdbc_read_options():
    options = jdbc.jdbc_read_options("jdbc:x", "sku_info", None, ["id", "price"], "id", (1, 100), 4)
    assert options["dbtable"] == "(SELECT id, price FROM sku_info) src"
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "4", "100")
    assert jdbc.jdbc_read_options("jdbc:x", None, "SELECT 1", None, None, None, 1)["dbtable"] == "(SELECT 1) src"
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", "t", "SELECT 1", None, None, None, 1)
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", "t", None, None, "id", None, 1)


def test_import_copies_every_table_and_splits_the_growing_ones(spark, tmp_path, rows):
    from martline.plans import daily

    asked = {}

    def read(session, url, table, columns, properties, **ranges):
        asked[table] = ranges
        values = ", ".join(f"'{7 if c != 'sku_name' else 'a name'}' as {c}" for c in columns)
        return session.sql(f"select {values}")

    daily.import_full(spark, "jdbc:x", str(tmp_path), DAY, read=read, bounds=lambda *_: (1, 2_500_000))
    assert set(asked) == set(schemas.SNAPSHOTS)
    assert {t for t, r in asked.items() if r} == set(daily.GROWING_TABLES)
    assert asked["sku_info"] == {"partition_column": "id", "bounds": (1, 2_500_000), "partitions": 3}
    back = files.read_snapshot_tsv(spark, str(tmp_path / "full" / "sku_info_full"), schemas.SNAPSHOTS["sku_info"], DAY)
    assert rows(back, "id", "price", "sku_name") == [("7", Decimal("7.00"), "a name")]


def test_export_stages_the_day_then_replaces_it(spark):
    done = []
    report = spark.createDataFrame([(DAY, 1), ("2022-06-07", 2)], "dt string, n int")
    jdbc.export_upsert(
        report, "jdbc:x", "ads_user_action", DAY,
        stage=lambda rows, url, table, _: done.append((table, [tuple(r) for r in rows.collect()])),
        run=lambda _spark, _url, statements, _: done.append(list(statements)),
    )
    assert done == [
        ("ads_user_action_staging", [(DAY, 1)]),
        [f"DELETE FROM ads_user_action WHERE dt = '{DAY}'",
         "INSERT INTO ads_user_action (dt, n) SELECT dt, n FROM ads_user_action_staging"],
    ]
    assert jdbc.export_statements("t", "s", ["dt", "n"], DAY, upsert=True) == [
        "REPLACE INTO t (dt, n) SELECT dt, n FROM s"
    ]


def test_every_report_has_a_key_and_every_source_a_schema():
    assert len(schemas.REPORT_KEYS) == 16
    assert (len(schemas.FEED_DATA), len(schemas.SNAPSHOTS)) == (13, 17)


@pytest.mark.parametrize("null", ["", "\\N"])
def test_tsv_gives_back_every_text(spark, tmp_path, null):
    texts = ["  padded  ", "a\tb", "a\nb", "a\r\nb\r", "\\", "\\\\t", "\\\t\\", "\\N", "tab\\t", '"quoted" , x', "", None, "é\u2028"]
    rows = [(k, text, k / 2) for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, value double")
    files.write_tsv(df, str(tmp_path / "t"), null=null)
    got = sorted(tuple(r) for r in files.read_tsv(spark, str(tmp_path / "t"), df.schema, null=null).collect())
    assert got == [(k, text if text or null else None, v) for k, text, v in rows]


def test_old_open_rows_can_be_pruned(spark, tmp_path):
    path = str(tmp_path / "zip")
    schema = T.StructType.fromDDL("id string, dt string")
    days = [f"2024-01-0{n}" for n in range(1, 6)]
    for n, day in enumerate(days):
        rows = [("open", OPEN_END)] + [(f"closed{n}", day)]
        sinks.write_version(spark.createDataFrame(rows, schema), path, day)
    before = {d: sorted(map(tuple, sinks.read_history(spark, path, d, schema).collect())) for d in days[2:]}
    assert sinks.prune_versions(spark, path, days[-1], keep_days=2) == days[:2]
    assert sinks.prune_versions(spark, path, days[-1], keep_days=2) == []
    assert {d: sorted(map(tuple, sinks.read_history(spark, path, d, schema).collect())) for d in days[2:]} == before
    assert sinks.read_version(spark, path, days[0], schema).where(F.col("dt") == OPEN_END).isEmpty()


def test_first_load_writes_a_file_per_day(spark, tmp_path):
    rows = spark.range(400, numPartitions=8).select(F.col("id").cast("string"), F.format_string("2024-02-%02d", F.col("id") % 20 + 1).alias("dt"))
    sinks.write_version(rows, str(tmp_path / "t"), "2024-03-01", spread=True)
    assert len(list((tmp_path / "t").rglob("*.orc"))) == 20


def test_named_checks_fail_with_the_row(spark):
    users = spark.createDataFrame([("1", "2024-01-01", "2024-01-05"), ("1", "2024-01-05", OPEN_END), ("2", "2024-01-01", "2024-01-04"), ("2", "2024-01-05", OPEN_END)], "id string, start_date string, end_date string")
    sinks.check_none(sinks.repeated_keys(users, "id", "start_date"), "keys")
    with pytest.raises(sinks.FailedCheck, match="overlap.*'id': '1'"):
        sinks.check_none(sinks.overlapping_versions(users, "id"), "overlap")
    assert [r["id"] for r in sinks.overlapping_versions(users, "id").collect()] == ["1"]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.new_folder(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/y"
    assert scratch.new_folder(Session).startswith("hdfs://x/y/")
