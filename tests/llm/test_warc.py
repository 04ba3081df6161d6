from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from martline.llm import warc
from martline.plans.scratch import new_folder

SCHEMA = "page_id long, url string, html string, payload_digest string"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(9), r, i) for i in range(rng.randrange(6))) for r in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(e for r in runs for e in r)


@pytest.mark.parametrize(("url", "key"), [
    ("https://www.Example.com/A?b=1#c", "com,example)/a?b=1"), ("http://m.a.org", "org,a,m)"), ("nonsense", "nonsense"), ("", ""), ("http://h:80/x", "h:80)/x"),
])
def test_url_key(spark, url, key):
    assert spark.range(1).select(warc.url_key(F.lit(url))).first()[0] == key


def rows():
    long = "<p>é\r\n\r\nWARC/1.0\r\n" + "x" * 120
    out = [(k, f"http://h{k % 4}.com/{k}", f"page {k} " * 40, "d") for k in range(60)]
    out += [(70, "http://a.com/ b\n", long, "d"), (65, "http://a.com/", long, "d"), (90, None, long, "d"), (66, "x", "short", "d"), (67, "x", "short", "d")]
    return [*out, (80, "http://n.com", None, "d"), (81, "http://n.com", "", "d"), (90, None, long, "d"), (None, "http://z.com", long, "d"), (99, "http://big.com", "y" * 2_000_000, "d")]


def captured():
    return F.date_format(F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) * -1 + 1_700_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    done = warc.histories(pages, captured(), run_bytes=20_000)
    got = done.collect()
    first = {}
    for i, _, h, _ in rows():
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    expected = []
    for i, _, h, _ in rows():
        raw = (h or "").encode()
        again = len(raw) >= 100 and first[h] != i
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(expected, key=key)
    assert len({r["run"] for r in got}) > 4


def test_runs_are_sorted_and_ranges_follow_each_other(spark):
    folder = new_folder(spark)
    warc.write_archives(spark.createDataFrame(rows(), SCHEMA).repartition(4), folder, captured(), run_bytes=20_000)
    index = warc.read_archives(spark, folder).withColumn("key", warc.url_key(F.col("url")))
    order = lambda r: (r["key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0)
    runs = {}
    for r in index.collect():
        runs.setdefault(r["run"], []).append((r["at"], order(r)))
    for r in runs.values():
        placed = [o for _, o in sorted(r)]
        assert placed == sorted(placed)
    parts = warc.merged(warc.read_archives(spark, folder), 3).withColumn("part", F.spark_partition_id()).collect()
    assert len({r["part"] for r in parts}) == 3
    whole = [order(r) for r in sorted(parts, key=lambda r: r["part"])]
    assert whole == sorted(whole)


def test_empty_table(spark):
    assert warc.histories(spark.createDataFrame([], SCHEMA), captured()).collect() == []


def test_damage_is_found():
    import gzip

    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 5\r\n\r\nH\r\n\r\n\r\n\r\n"
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parsed(gzip.compress(record)))
