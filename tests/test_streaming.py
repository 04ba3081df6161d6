from __future__ import annotations

import json

import pytest

from martline.operators import sinks
from martline.sources import files, schemas
from martline.streaming import landing

NIGHT = 1654704000000  # midnight between the eighth and the ninth in the log's zone


def put(folder, name, documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents) + "\n")


def test_log_lands_by_its_own_time_and_restart_adds_only_new_files(spark, tmp_path, rows):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    put(source, "a.log", [{"ts": NIGHT - 1, "common": {"mid": "m1"}}, {"ts": NIGHT, "common": {"mid": "m2"}}, "broken"])

    def land():
        lines = landing.tail_files_stream(spark, str(source), "*.log")
        landing.land_log_stream(lines, out, checkpoint, once=True).awaitTermination()
        return rows(files.read_log_json(spark, out, None), "dt", "common.mid")

    first = land()
    assert first == [(None, None), ("2022-06-08", "m1"), ("2022-06-09", "m2")]
    assert land() == first
    put(source, "b.log", [{"ts": NIGHT + 1, "common": {"mid": "late file"}}])
    assert land() == sorted([*first, ("2022-06-09", "late file")], key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert rows(files.read_log_json(spark, out, "2022-06-08"), "common.mid") == [("m1",)]


def test_changes_are_routed_by_table_and_day(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.json", [
        {"table": "cart_info", "type": "insert", "ts": NIGHT // 1000 - 1, "data": {"id": "1"}},
        {"table": "favor_info", "type": "insert", "ts": NIGHT // 1000, "data": {"id": "2"}},
    ])
    topic = landing.tail_files_stream(spark, str(source))
    landing.land_change_stream(topic, out, str(tmp_path / "ck"), once=True).awaitTermination()
    for table, expected in (("cart_info", ("1", "2022-06-08")), ("favor_info", ("2", "2022-06-09"))):
        feed = files.read_change_feed(spark, out, schemas.FEED_DATA[table], None, table=table)
        assert rows(feed, "data.id", "dt") == [expected]


def test_a_batch_writes_few_files_and_a_closed_day_is_compacted(spark, tmp_path, rows):
    source, out, closed = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "closed")
    for k in range(12):
        put(source, f"{k}.log", [{"ts": NIGHT + (k % 2) * 86_400_000 - i, "common": {"mid": f"m{k}-{i}"}} for i in range(1, 9)] + ["broken"])
    lines = landing.tail_files_stream(spark, str(source))
    landing.land_log_stream(lines, out, str(tmp_path / "ck"), once=True, splits=2).awaitTermination()
    files_written = list((tmp_path / "out").rglob("*.txt.gz"))
    assert len(files_written) <= 3 * 2  # two days and the rows without one
    landed = spark.read.schema("value string, dt string").text(out)
    assert sinks.unreadable_rows(landed).count() == 12
    with pytest.raises(sinks.FailedCheck, match="unreadable"):
        sinks.check_none(sinks.unreadable_rows(landed), "unreadable")
    for _again in range(2):
        landing.compact_day(spark, out, closed, "2022-06-08")
    assert rows(files.read_log_json(spark, closed, None), "common.mid") == rows(files.read_log_json(spark, out, "2022-06-08"), "common.mid")
    assert len(list((tmp_path / "closed").rglob("*.gz"))) == 1 and not (tmp_path / "closed" / "_spark_metadata").exists()
