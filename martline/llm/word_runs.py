"""Stretches of words that repeat with a period (operator 12).

Method: the branching-tandem test on an enhanced suffix array. The suffix array of the words and its LCP table give the LCP
intervals; an interval of depth d holds all suffixes that begin with one string of d words. Two suffixes i and i + d of
one interval that lie in different children of it are a square of period d that the next word does not continue. For each
interval the suffixes of all children but the largest look up, in the inverse suffix array, whether i + d or i - d is in
the interval too, outside their own child. Every run ends in such squares. They are rotated to the left as far as the words allow,
and squares with the same ends merge into one run with its least period. No tree is built: intervals are index ranges.

Words are coded exactly, by their bytes. Texts of a few megabytes are worked together, each ended by a code of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames, words

#: Words a run has at least, and how often its period fits into it at least.
MIN_LENGTH, MIN_TURNS = 6, 4
_RUN = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, its inverse, and per doubling k the rank of each suffix by its first 2**k codes.

    Prefix doubling; only suffixes whose rank is still shared are sorted again. The last code must occur nowhere else.
    """
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    sorted_ = codes[sa]
    head = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    ranks = [rank]
    span = 1
    while True:
        shared = ~head | np.concatenate([~head[1:], [False]])
        where = np.flatnonzero(shared)
        if not len(where):
            return sa, rank, ranks
        group = sa[where]
        # a suffix that shares its rank has not met its end mark yet, so i + span is inside
        key = rank[group].astype(np.int64) * n + rank[group + span]
        order = np.argsort(key, kind="stable")
        sa[where] = group[order]
        key = key[order]
        head[where] = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        at = np.maximum.accumulate(np.where(head[where], where, 0))
        rank[sa[where]] = at
        ranks.append(rank)
        span *= 2


def lcp_table(sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Codes that each suffix shares with the one before it in the suffix array, from equal ranks of falling spans."""
    lcp = np.zeros(len(sa), np.int64)
    near = np.flatnonzero(ranks[0][sa[1:]] == ranks[0][sa[:-1]]) + 1
    a, b = sa[near - 1].copy(), sa[near].copy()
    for k in range(len(ranks) - 1, -1, -1):
        # the last code is unique, so a suffix that is equal so far is not at its end
        same = ranks[k][a] == ranks[k][b]
        a[same] += 1 << k
        b[same] += 1 << k
    lcp[near] = b - sa[near]
    return lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All LCP intervals: first, last and depth of each, then of each child its interval and first index; bottom up."""
    first, last, depth, child_of, child_at = [], [], [], [], []
    stack: list[tuple[int, int, list[int]]] = []  # depth, first index, first indexes of the children
    near = np.flatnonzero(lcp)
    if not len(near):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    before = -1

    def closed(top: tuple[int, int, list[int]], end: int) -> None:
        child_of.extend([len(first)] * len(top[2]))
        child_at.extend(top[2])
        first.append(top[1])
        last.append(end)
        depth.append(top[0])

    for j, d in zip(near.tolist(), lcp[near].tolist(), strict=True):
        if j != before + 1:
            while stack:
                closed(stack.pop(), before)
        left = j - 1
        while stack and stack[-1][0] > d:
            top = stack.pop()
            closed(top, j - 1)
            left = top[1]
        if stack and stack[-1][0] == d:
            stack[-1][2].append(j)
        else:
            stack.append((d, left, [left, j]))
        before = j
    while stack:
        closed(stack.pop(), before)
    return tuple(np.array(x, np.int64) for x in (first, last, depth, child_of, child_at))


def _spread(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its own index and its members, one after another."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + begin[owner]


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that the next code does not continue."""
    first, last, depth, child_of, child_at = intervals(lcp)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = np.concatenate([child_of[1:] == child_of[:-1], [False]])
    end = np.where(own, np.concatenate([child_at[1:], [0]]) - 1, last[child_of])
    size = end - child_at + 1
    # the largest child of each interval is left out: its squares are met from their other half
    order = np.lexsort((np.arange(len(size)), -size, child_of))
    largest = np.zeros(len(size), bool)
    largest[order[np.concatenate([[True], child_of[order][1:] != child_of[order][:-1]])]] = True
    small = np.flatnonzero(~largest)
    starts, periods = [], []
    step = 1 << 20
    total = np.cumsum(size[small])
    low = 0
    while low < len(small):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + step, "right")))
        some = small[low:high]
        owner, at = _spread(child_at[some], size[some])
        child = some[owner]
        box = child_of[child]
        d, i = depth[box], sa[at]
        for other, begin in ((i + d, i), (i - d, i - d)):
            inside = (other >= 0) & (other < len(sa))
            place = isa[np.where(inside, other, 0)]
            hit = inside & (place >= first[box]) & (place <= last[box]) & ((place < child_at[child]) | (place > end[child]))
            starts.append(begin[hit])
            periods.append(d[hit])
        low = high
    return np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.int64), *periods])


def _rotated(codes: np.ndarray, start: int, period: int) -> int:
    """Where the square at ``start`` ends up when it is rotated to the left while the words allow."""
    step = 16
    while start:
        low = max(0, start - step)
        unlike = np.flatnonzero(codes[low:start] != codes[low + period : start + period])
        if len(unlike):
            return low + int(unlike[-1]) + 1
        start, step = low, min(2 * step, 1 << 20)
    return 0


def runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_turns: int = MIN_TURNS) -> np.ndarray:
    """Rows (start, end, period) by start, then period; ``codes`` are texts one after another, each ended by a code of its own."""
    if len(codes) < min_length or len(codes) < 2:
        return np.zeros((0, 3), np.int64)
    sa, isa, ranks = suffix_array(codes)
    start, period = branching_squares(sa, isa, lcp_table(sa, ranks))
    # a run of enough turns has its words one and two periods before the square too
    long = start >= max(0, min_turns - 2) * period
    start, period = start[long], period[long]
    if min_turns > 2:
        back = (min_turns - 2) * period
        alike = (codes[start - 1] == codes[start - 1 + period]) & (codes[start - back] == codes[start - back + period])
        start, period = start[alike], period[alike]
    found: dict[int, list[tuple[int, int]]] = {}
    for end, p in sorted(zip((start + 2 * period).tolist(), period.tolist(), strict=True)):
        held = found.setdefault(end, [])
        # a multiple of a period found for this end is the same run
        if not any(p % q == 0 and end - 2 * p >= s for s, q in held):
            held.append((_rotated(codes, end - 2 * p, p), p))
    rows = [(s, end, p) for end, held in found.items() for s, p in held if end - s >= max(min_length, min_turns * p)]
    return np.array(sorted(rows, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _coded(texts: pa.Array) -> tuple[words.Words, pa.Array, np.ndarray, np.ndarray]:
    """The words of the texts, as an array, and their codes with an end mark of its own after each text; where each text begins there."""
    found = words.scan(texts)
    n, size = len(found.starts), found.ends - found.starts
    edge = np.zeros(len(found.data) + 1, np.int8)
    edge[found.starts] += 1
    edge[found.ends] -= 1
    body = found.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
    own = every.dictionary_encode().indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), found.counts())
    codes = np.empty(n + len(texts), np.int64)
    codes[np.arange(n) + text] = own + len(texts)
    codes[found.first[1:] + np.arange(len(texts))] = np.arange(len(texts))
    return found, every, codes, found.first[:-1] + np.arange(len(texts))


def _worked(texts: pa.Array, min_length: int, min_turns: int) -> tuple[list[int], list[list[dict]], pa.Array]:
    """Words, runs and text without the repeats of each text."""
    found, every, codes, begin = _coded(texts)
    rows = runs(codes, min_length, min_turns)
    owner = np.searchsorted(begin, rows[:, 0], "right") - 1
    turn = np.zeros(len(codes) + 1, np.int64)
    np.add.at(turn, rows[:, 0] + rows[:, 2], 1)
    np.add.at(turn, rows[:, 1], -1)
    text = np.repeat(np.arange(len(texts)), found.counts())
    kept = np.cumsum(turn)[np.arange(len(every)) + text] == 0
    lists: list[list[dict]] = [[] for _ in range(len(texts))]
    for k, (s, e, p) in zip(owner.tolist(), rows.tolist(), strict=True):
        lists[k].append({"start": s - int(begin[k]), "length": e - s, "period": p})
    left = every.filter(pa.array(kept))
    offsets = np.concatenate([[0], np.cumsum(kept)])[found.first]
    whole = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), left)
    return found.counts().tolist(), lists, pc.binary_join(whole, b" ")


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_turns: int = MIN_TURNS, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (of it the columns ``carry``, if given) with ``n_words``, ``runs`` (``start, length, period`` by start, then period) and ``collapsed``.

    A run is a stretch of words with a smallest period, at least ``min_length`` words and ``min_turns`` (two or more)
    periods long, that no neighbouring word continues. ``collapsed`` holds the words that no run has after its first
    period, joined by a space. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated rows are
    each worked; columns of these names in ``docs`` are replaced. A text is worked whole: its words need about 200 bytes
    each, and 4 more for each doubling up to its longest repeat.
    """
    if min_turns < 2:
        raise ValueError("a run has two turns or more")
    frames.ready(docs.sparkSession)
    columns = list(docs.columns if carry is None else carry)
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n, _ in _RUN]))
    schema = T.StructType([dealt.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", kind), T.StructField("collapsed", T.StringType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high in words.slices(b.column("text")):
                part = b.slice(low, high - low)
                n, found, left = _worked(part.column("text"), min_length, min_turns)
                made = [pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.struct(_RUN))), left.cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *made], ["row", "n_words", "runs", "collapsed"])

    return frames.unpacked(dealt.mapInArrow(frames.per_task(each), schema), columns, "n_words", "runs", "collapsed")


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of a tenth of the documents, chosen by id, the words from a place on repeat a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    own = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("own").cast("long")
    planted = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, own).alias("own"))
    planted = planted.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    turned = F.transform("own", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("own", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return planted.select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", turned)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Operator 12 over ``documents``: each one's longest run, and digests of all runs and of what is left."""
    done = find_runs(with_periods(frames.table(spark, sf_dir, "documents")), carry=["doc_id"])
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return done.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", (-F.col("top.shorter")).alias("length"), "top.period",
        F.expr("(-1000 * top.shorter) div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
