"""WARC archives of pages and the merge of their indexes (operator 5).

Every page becomes a record. Of pages with equal payloads one is stored as a response and the others as revisits that
point to it. Each task writes a capture run, sorted by URL key and time, through Spark's own text writer: a record ends
with two line ends, which is the writer's line separator, so runs are committed like any table and need no local files.

Reading an archive back gives one index entry per record. The entries of a file are a locally sorted run. They are dealt
into ranges of (URL key, time, page), and each range merges its parts of all runs by a tree of losers: the globally
ordered capture histories. A URL key with a third of all captures is divided over ranges by time and page.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm import frames
from martline.plans.scratch import new_folder

#: Payloads below this many bytes are always stored; a run file holds about this many bytes.
LEAST_REVISIT, RUN_BYTES = 100, 8 << 20
_LINE = "\r\n"
_INDEX = "page_id long, url string, captured string, record_type string, refers_to long, payload_bytes long, payload_digest string, run string, at long"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query, in lower case and without the fragment."""
    plain = F.regexp_replace(F.lower(url), "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(plain, r"^[^:/?#]+://([^/?]*)", 1), r"^www\.", "")
    rest = F.regexp_extract(plain, r"^[^:/?#]+://[^/?]*(.*)$", 1)
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)).otherwise(plain)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_LINE))


def records(pages: DataFrame, page_id: str, url: str, html: str, captured: Column, least: int) -> DataFrame:
    """``key, captured, page_id, record``: each page as the text of its record, without the two line ends after it."""
    own = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("payload"),
        F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\x00-\x20]", "%20").alias("url"), captured.alias("captured"),
    ).withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    same = own.filter(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    marked = own.join(same.filter("copies > 1").select("digest", "first"), "digest", "left")
    revisit = (F.col("n") >= least) & F.coalesce(F.col("first") < F.col("page_id"), F.col("first").isNotNull() & F.col("page_id").isNull())
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _header("Content-Length", F.col("n").cast("string")), F.lit(_LINE))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _header("WARC-Target-URI", F.col("url")), _header("WARC-Date", F.col("captured")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"),
            _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        )).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), _header("Content-Length", F.octet_length("block").cast("string")), F.lit(_LINE),
    )
    return marked.withColumn("block", block).select(url_key(F.col("url")).alias("key"), "captured", "page_id", F.concat(head, F.col("block")).alias("record"))


def write_archives(pages: DataFrame, folder: str, captured: Column, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, run_bytes: int = RUN_BYTES) -> None:
    """Archives of all ``pages`` under ``folder``, each sorted by URL key, time and page.

    ``captured`` is the capture time as text (``2024-01-31T00:00:00Z``). A null ``html`` is an empty payload, a null URL an
    empty one; control characters and spaces in URLs become ``%20``. Of equal payloads of ``least`` bytes or more the
    smallest page id is stored, a null one last; rows that share the smallest id are all stored.
    """
    # The mean size sets the records of a file, so that a reader never holds a large file.
    size = pages.agg(F.sum(F.octet_length(F.col(f"`{html}`"))).alias("bytes"), F.count("*").alias("n")).first()
    each = max(1, run_bytes // (600 + (size["bytes"] or 0) // max(1, size["n"])))
    made = records(pages, page_id, url, html, captured, least).sortWithinPartitions("key", "captured", "page_id")
    made.select("record").write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=each).text(folder)


def parsed(content: bytes) -> Iterator[dict]:
    """Index entry of each record of an archive: the payload is read, counted and hashed."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16)
    while version := stream.readline():
        if version.strip() == b"":
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = _headers(stream)
        block = io.BytesIO(stream.read(int(head["content-length"])))
        block.readline()
        http = _headers(block)
        payload = block.read()
        revisit = head["warc-type"] == "revisit"
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in {head['warc-record-id']}")
        number = head["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
        yield {
            "page_id": int(number) if number else None, "url": head["warc-target-uri"], "captured": head["warc-date"], "record_type": head["warc-type"],
            "refers_to": int(head["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">")) if revisit else None,
            "payload_bytes": int(http["content-length"]) if revisit else len(payload), "payload_digest": digest,
        }


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").lower()] = value.strip().decode()
    return out


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("run", pa.string()), ("at", pa.int64()),
])


def read_archives(spark, folder: str) -> DataFrame:
    """Index entries of all archives under ``folder``, with their file as ``run`` and place there as ``at``."""
    frames.ready(spark)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                rows = [{**r, "run": path, "at": k} for k, r in enumerate(parsed(content.as_py()))]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    return files.mapInArrow(frames.per_task(indexed), _INDEX)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next winner needs one path only."""

    _LAST = ((2,),)

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.tree = [-1] * self.k
        for run in range(self.k):
            self._climb(run)

    def _head(self, run: int) -> tuple:
        """Sorts behind all entries once the run is empty."""
        return (0, self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else (1, ())

    def _climb(self, run: int) -> None:
        node, winner = (run + self.k) // 2, run
        while node > 0:
            held = self.tree[node]
            if held < 0:  # still being built: wait here for the opponent
                self.tree[node] = winner
                return
            if self._head(held) < self._head(winner):
                self.tree[node], winner = winner, held
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            run = self.tree[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._climb(run)


def merged(index: DataFrame, ranges: int | None = None) -> DataFrame:
    """``index`` with its ``key``, in ``ranges`` partitions that follow each other in order of key, time and page, each sorted.

    A partition holds its part of every run in memory: ``ranges`` follows the session's shuffle partitions.
    """
    keyed = index.withColumn("key", url_key(F.col("url")))
    names = keyed.columns
    place = [names.index(c) for c in ("key", "captured", "page_id")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema = None
        for b in batches:
            schema = b.schema
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                order = tuple((row[p] is not None, row[p]) if row[p] is not None else (False, 0) for p in place)
                runs.setdefault(row[names.index("run")], []).append((order, row[names.index("at")], row))
        for run in runs.values():  # blocks of a run may arrive in any order
            if any(a > b for a, b in zip(run, run[1:])):  # noqa: B905
                run.sort(key=lambda e: e[:2])
        # Equal entries of two runs are told apart by the run.
        tree = LoserTree([[(order, name, at, row) for order, at, row in run] for name, run in sorted(runs.items())])
        held: list[tuple] = []
        for entry in tree:
            held.append(entry[3])
            if len(held) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return keyed.repartitionByRange(ranges or frames.width(index.sparkSession), "key", "captured", "page_id").mapInArrow(frames.per_task(merge), keyed.schema)


def histories(pages: DataFrame, captured: Column, **kw) -> DataFrame:
    """Archives written and read back, their index runs stored and merged: the ordered histories as a table."""
    folder = new_folder(pages.sparkSession)
    write_archives(pages, folder, captured, **kw)
    return frames.written(merged(frames.written(read_archives(pages.sparkSession, folder))))


def op5_warc_index_merge(spark, sf_dir: str) -> DataFrame:
    """Operator 5 over ``pages``; the capture time is made from the page id, as the table has none."""
    seconds = F.lit(1_704_067_200) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(31_536_000))
    captured = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    done = histories(frames.table(spark, sf_dir, "pages"), captured)
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
    min(page_id) OVER (PARTITION BY payload_digest) AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM d
"""
