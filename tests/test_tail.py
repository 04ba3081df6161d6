from __future__ import annotations

import json
import os
import shutil

import pytest

from martline.streaming import tail
from martline.streaming.tail import Tail, tail_growing_files


@pytest.fixture
def tailed(spark, tmp_path):
    """All lines read so far, after one more run of the query on the same checkpoint."""
    folder, out, checkpoint = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "ck")
    folder.mkdir()

    def run(split=1 << 20):
        lines = tail_growing_files(spark, str(folder), "app*", split)
        query = lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r["value"] for r in spark.read.schema("value string").parquet(out).collect())

    return folder, run


def add(file, text):
    with open(file, "a", newline="") as f:
        f.write(text)


def test_growth_half_lines_rotation_and_truncation(tailed):
    folder, run = tailed
    app = folder / "app.log"
    add(app, "one: the first line\ntwo: the second line\nthr")
    add(folder / "other", "not wanted\n")
    assert run() == ["one: the first line", "two: the second line"]
    assert run() == ["one: the first line", "two: the second line"]  # nothing new
    add(app, "ee: é\r\n")
    expected = ["one: the first line", "three: é", "two: the second line"]
    assert run() == expected
    add(app, "four\nfi")
    os.rename(app, folder / "app.log.1")
    add(folder / "app.log.1", "ve\n")
    add(app, "six in a new file of the old name\n")
    expected = sorted([*expected, "four", "five", "six in a new file of the old name"])
    assert run() == expected
    shutil.copy(app, folder / "app.log.2")  # copied, then truncated
    add(folder / "app.log.2", "")
    app.write_text("seven, after truncation\n")
    expected = sorted([*expected, "seven, after truncation"])
    assert run() == expected
    app.write_text("8\n")  # shorter than what was read of it
    assert run() == sorted([*expected, "8"])


def test_a_backlog_is_split_and_each_line_read_once(tailed):
    folder, run = tailed
    lines = [f"{k:05d} {'x' * (k % 97)}" for k in range(3000)]
    add(folder / "app.log", "\n".join(lines[:1000]) + "\n" + lines[1000][:7])
    assert run(split=500) == lines[:1000]
    add(folder / "app.log", lines[1000][7:] + "\n" + "\n".join(lines[1001:]) + "\n")
    assert run(split=1 << 14) == lines


def test_a_file_renamed_between_planning_and_reading(tmp_path):
    (tmp_path / "app.log").write_text("a line that is long enough to be known\nand another one\n")
    reader = Tail({"path": f"file://{tmp_path}"})
    end = reader.latestOffset()
    assert json.loads(json.dumps(end)) == end
    parts = reader.partitions({}, end)
    os.rename(tmp_path / "app.log", tmp_path / "app.log.1")
    (tmp_path / "app.log").write_text("other content that is not older than the first one, and longer by far\n")
    got = [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert got == ["a line that is long enough to be known", "and another one"]
    os.remove(tmp_path / "app.log.1")
    with pytest.raises(FileNotFoundError, match="lost bytes"):
        list(reader.read(parts[0]))
    later = reader.latestOffset()
    assert [p.low for p in reader.partitions(end, later)] == [0]


@pytest.mark.parametrize("split", [1, 2, 3, 5, 8, 1000])
def test_every_split_size_reads_each_line_once(tmp_path, monkeypatch, split):
    monkeypatch.setattr(tail, "BLOCK", 4)
    text = "a\n\nbbb\ncc\r\n\n\ndddddddd\ne\n"
    (tmp_path / "f").write_text(text + "half", newline="")
    reader = Tail({"path": f"file://{tmp_path}", "splitBytes": str(split)})
    end = reader.latestOffset()
    rows = [r for p in reader.partitions({}, end) for b in reader.read(p) for r in b.to_pylist()]
    assert [r["value"] for r in rows] == ["a", "", "bbb", "cc", "", "", "dddddddd", "e"]
    assert all(text[r["position"] :].startswith(r["value"]) for r in rows) and len({r["position"] for r in rows}) == len(rows)
    assert Tail({"path": f"file://{tmp_path}/none"}).latestOffset() == {}
