"""Quality rules from the frequency of lines across the documents of a host (operator 7).

A line is normalised (A-Z in lower case, runs of white space as one space, digits as 0) and hashed. Per host, the
distinct documents that hold it are counted; lines in more than ``max_documents`` are removed, however large the host is,
and a document left with less than ``min_left`` of its words is rejected.

Exact and near copies count as one document, else the copies of a good text would all be rejected, the first one too.
They are told by what else a document has: its other lines that stand, as they are, in at most ``max_documents`` different
texts of the host, and are no slight changes of lines that stand in more. Boilerplate has no part in that, however much of
the page it is: a page with two words of its own is as much a document as one with many. Of these lines' windows of three
words, ``SKETCHES`` least hashes are taken. Documents with the line that share one are taken for copies, and each counts as
one part of the largest such group that it is in; groups are not linked on, so texts that share a phrase do not run together
in a large host. Documents that have no such lines, as copies with a few words changed, are one group. A line counts as
changed from a more frequent one if it shares one of its least hashes. Counting combines before each shuffle, so a host or
a line with a third of all rows costs one row per task and text; a document's lines are never copied for each of its
frequent lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames, words

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
#: Documents of a host that a line may be in, and the share of its words that a document must keep.
MAX_DOCUMENTS, MIN_LEFT = 20, 0.3
#: Least hashes of a line, and of a document's own lines.
SKETCHES = 8

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_NEW_LINE = 10
_SEEDS = words.mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
_KEYS = [f"s{k}" for k in range(SKETCHES)]


def normalised(line: bytes) -> bytes:
    return re.sub(rb"0+", b"0", b" ".join(line.translate(_NORMAL).split()))


def line_hash(line: bytes) -> int:
    """Signed XXH64 of the normalised line."""
    from xxhash import xxh64_intdigest

    h = xxh64_intdigest(normalised(line))
    return h - (1 << 64) if h >> 63 else h


def _repeat_words(found: words.Words, hashes: np.ndarray) -> np.ndarray:
    """Per text: words inside windows of three words that the text holds twice or more."""
    at = np.flatnonzero(found.left() >= REPEAT_WINDOW)
    texts = np.repeat(np.arange(len(found.first) - 1), found.counts())
    keys = words.mix(words.windows(hashes, at, REPEAT_WINDOW) ^ (texts[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, back, n = np.unique(keys, return_inverse=True, return_counts=True)
    inside = np.zeros(len(hashes) + REPEAT_WINDOW, bool)
    hit = at[n[back] > 1]
    for k in range(REPEAT_WINDOW):
        inside[hit + k] = True
    sums = np.concatenate([[0], np.cumsum(inside[: len(hashes)])])
    return sums[found.first[1:]] - sums[found.first[:-1]]


def _sketches(found: words.Words, hashes: np.ndarray) -> list[np.ndarray]:
    """Per text: its least hashes of windows of three words, or of words where there are fewer; empty without words."""
    out = []
    for low, n in zip(found.first[:-1].tolist(), found.counts().tolist(), strict=True):
        own = hashes[low : low + n]
        if n >= REPEAT_WINDOW:
            own = words.windows(own, np.arange(n - REPEAT_WINDOW + 1), REPEAT_WINDOW)
        out.append(words.mix(own ^ _SEEDS[:, None]).min(1).view(np.int64) if n else np.zeros(0, np.int64))
    return out


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Columns that this operator adds.
MADE = (*_BASE, "n_removed_words", "removed_lines", "base_failed", "kept")
_LINE = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("line", "exact", "n", *_KEYS)]))


def _measured(texts: pa.Array) -> dict[str, list]:
    """Base counts, lines with words (hash, words and sketches) and hash of each text."""
    from xxhash import xxh64_intdigest

    data, at = words.raw(texts)
    found = words.scan(texts)
    hashes = found.hashes()
    starts = (data & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {
        "n_words": found.counts().tolist(), "word_chars": _per_text(starts & words.INSIDE[data], at).tolist(),
        "n_symbols": _per_text(symbol[data], at).tolist(), "n_repeat_words": _repeat_words(found, hashes).tolist(),
        "n_dup_lines": [], "lines": [], "copy": [],
    }
    for low, high in zip(at[:-1], at[1:], strict=True):
        whole = data[low:high].tobytes()
        every = [x for x in whole.split(b"\n") if x.split()]
        out["n_dup_lines"].append(len(every) - len(set(every)))
        out["lines"].append(_lines(every))
        out["copy"].append(xxh64_intdigest(whole) - (1 << 63) if every else None)
    return out


def _lines(every: list[bytes]) -> list[dict[str, int]]:
    from xxhash import xxh64_intdigest

    found = words.scan(pa.array(every, pa.binary()))
    least = _sketches(found, found.hashes()) if every else []
    return [
        {"line": line_hash(x), "exact": xxh64_intdigest(x) - (1 << 63), "n": len(x.split()), **dict(zip(_KEYS, k.tolist(), strict=True))}
        for x, k in zip(every, least, strict=True)
    ]


def measured(docs: DataFrame, text: str, host: str, carry: Sequence[str]) -> DataFrame:
    """``row`` (the columns ``carry``), ``host``, the base counts, ``lines`` and ``copy`` (hash of the text) of each document."""
    frames.ready(docs.sparkSession)
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"), F.col(f"`{host}`").cast("string").alias("host"))
    schema = T.StructType([
        dealt.schema["row"], dealt.schema["host"], *[T.StructField(c, T.LongType()) for c in _BASE],
        T.StructField("lines", _LINE), T.StructField("copy", T.LongType()),
    ])
    arrow = {**{c: pa.int64() for c in (*_BASE, "copy")}, "lines": pa.list_(pa.struct([(c, pa.int64()) for c in ("line", "exact", "n", *_KEYS)]))}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high in words.slices(b.column("text")):
                part = b.slice(low, high - low)
                m = _measured(part.column("text"))
                names = [*_BASE, "lines", "copy"]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("host"), *[pa.array(m[c], arrow[c]) for c in names]], ["row", "host", *names])

    return dealt.mapInArrow(frames.per_task(each), schema)


def _at(many: DataFrame, few: DataFrame, column: str) -> DataFrame:
    """``many`` with ``among``: whether ``host`` and ``column`` are in ``few``."""
    few = few.select(F.col("host").alias("its host"), F.col(column).alias("its value"))
    there = (F.col(column) == F.col("its value")) & F.col("host").eqNullSafe(F.col("its host"))
    return many.join(few, there, "left").withColumn("among", F.col("its value").isNotNull()).drop("its host", "its value")


def _own(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` with ``least`` and ``other`` instead of ``own``: per key the least hash of the own lines with its line, and the
    least one of the other lines. Lines that share a key with a frequent line (``known``) are left out: they are changed from it."""
    each = docs.select("at", "host", F.posexplode("own").alias("i", "x"))
    keyed = each.select("at", "host", "i", F.posexplode(F.array(*[F.col("x")[k] for k in _KEYS])).alias("k", "key"))
    changed = keyed.alias("a").join(known.alias("b"), F.expr("a.k = b.k AND a.key = b.key AND a.host <=> b.host"), "left_semi").select("at", "i").distinct()
    left = each.join(changed, ["at", "i"], "left_anti").groupBy("at").agg(F.collect_list("x").alias("own"))
    both = docs.drop("own").join(left, "at", "left")

    def pairs(k: str) -> Column:
        return F.transform("own", lambda x: F.struct(x[k].alias("key"), x["line"].alias("line")))

    def apart(k: str) -> Column:
        return F.filter(pairs(k), lambda p: p["line"] != F.col(f"least {k}")["line"])

    both = both.withColumns({f"least {k}": F.array_min(pairs(k)) for k in _KEYS})
    return both.withColumns({f"other {k}": F.array_min(apart(k)) for k in _KEYS}).drop("own")


def _documents(lined: DataFrame, max_documents: int) -> DataFrame:
    """``host, line, n``: the distinct documents of the lines that are in more than ``max_documents`` different texts."""

    def often(some: DataFrame, column: str) -> DataFrame:
        texts = some.select("host", "copy", column).distinct().groupBy("host", column).agg(F.count("*").alias("n"))
        return frames.written(texts.filter(F.col("n") > max_documents).select("host", column))

    lines = lined.select("at", "host", "copy", F.explode("lines").alias("x")).select("at", "host", "copy", "x.*")
    found = _at(lines, often(lines, "line"), "line")
    found = _at(found.withColumnRenamed("among", "held"), often(found.filter("among"), "exact"), "exact")
    docs = found.groupBy("at", "host").agg(
        F.collect_set(F.when(F.col("held"), F.col("line"))).alias("held"),
        F.collect_list(F.when(~F.col("among"), F.struct("line", *_KEYS))).alias("own"),
    )
    docs = frames.written(docs.filter(F.size("held") > 0))
    known = found.filter("among").select("host", *_KEYS).distinct()
    known = frames.written(known.select("host", F.posexplode(F.array(*_KEYS)).alias("k", "key")).distinct())
    docs = _own(docs, known).withColumn("line", F.explode("held"))
    keys = [F.when(F.col(f"least {k}")["line"] != F.col("line"), F.col(f"least {k}")["key"]).otherwise(F.col(f"other {k}")["key"]).alias(k) for k in _KEYS]
    alike = frames.written(docs.select("host", "line", *keys).groupBy("host", "line", *_KEYS).agg(F.count("*").alias("rows")))

    keyed = alike.filter(F.col(_KEYS[0]).isNotNull()).select("*", F.posexplode(F.array(*_KEYS)).alias("k", "key"))
    sizes = keyed.groupBy("host", "line", "k", "key").agg(F.sum("rows").alias("size"), F.count("*").alias("parts")).filter("parts > 1")
    met = keyed.alias("a").join(sizes.alias("b"), F.expr("a.line = b.line AND a.k = b.k AND a.key = b.key AND a.host <=> b.host"), "left")
    met = met.groupBy("a.host", "a.line", *_KEYS).agg(F.max(F.coalesce("size", "rows")).alias("size"), F.first("rows").alias("rows"))
    bare = alike.filter(F.col(_KEYS[0]).isNull()).select("host", "line", F.lit(1.0).alias("part"))
    parts = met.select("host", "line", (F.col("rows") / F.col("size")).alias("part")).union(bare)
    return parts.groupBy("host", "line").agg(F.round(F.sum("part"), 6).alias("n"))  # whole groups add up to 1 but for rounding


def frequent_lines(lined: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``host, line`` of the lines in more than ``max_documents`` distinct documents, in a host of any size."""
    return _documents(lined, max_documents).filter(F.col("n") > max_documents).select("host", "line")


def judged(docs: DataFrame, text: str = "text", host: str = "source", max_documents: int = MAX_DOCUMENTS, min_left: float = MIN_LEFT, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (of it the columns ``carry``, if given) with the base counts, ``n_removed_words`` (in frequent lines), ``removed_lines``
    (their hashes), ``base_failed`` and ``kept``.

    Null and empty texts have no words, so they fail the base rules. A null host is a host of its own. Repeated rows are
    each judged; they count as one document. Columns of these names in ``docs`` are replaced.
    """
    columns = list(docs.columns if carry is None else carry)
    lined = frames.written(_numbered(measured(docs, text, host, columns)))
    often = frequent_lines(lined, max_documents)
    lines = lined.select("at", "host", F.explode("lines").alias("x")).select("at", "host", "x.line", "x.n")
    hit = lines.alias("a").join(often.alias("b"), F.expr("a.line = b.line AND a.host <=> b.host"), "left_semi")
    lost = hit.groupBy("at").agg(F.sum("n").alias("lost"), F.collect_set("line").alias("removed_lines"))
    all_ = lined.join(lost, "at", "left").withColumn("n_removed_words", F.coalesce("lost", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = ~failed & (F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words"))
    return frames.unpacked(all_.withColumn("base_failed", failed).withColumn("kept", kept), columns, *MADE)


def _cleared(text: str | None, lines: list[int]) -> str:
    gone = set(lines)
    return "\n".join(x for x in (text or "").split("\n") if not (b := x.encode()).split() or line_hash(b) not in gone)


def cleared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Judged ``docs`` whose text has lost its ``removed_lines``; texts without any stay as they are."""
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), F.col(f"`{text}`").alias("text"), F.col("removed_lines").alias("lines"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            if b.column("lines").null_count < len(b):
                both = zip(texts, b.column("lines"), strict=True)
                texts = pa.array([_cleared(t.as_py(), lines.as_py()) if lines.is_valid else t.as_py() for t, lines in both], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), texts], ["row", "text"])

    schema = T.StructType([dealt.schema["row"], T.StructField("text", T.StringType())])
    done = dealt.mapInArrow(frames.per_task(each), schema)
    return done.select(*[F.col("text").alias(text) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def _numbered(df: DataFrame) -> DataFrame:
    """A number for each row, unique and fixed once the table is written: ids may be null or repeat."""
    return df.withColumn("at", F.monotonically_increasing_id())


def op7_line_frequency_rules(spark, sf_dir: str) -> DataFrame:
    """Operator 7 over ``documents``, with ``source`` as host."""
    done = judged(frames.table(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=["doc_id"])
    return done.select("doc_id", *_BASE, "base_failed", "kept", "n_removed_words")
