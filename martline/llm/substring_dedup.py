"""Removal of word passages that occur more than once in the corpus (operator 1).

Method: difference-cover anchors. Let ``D`` be a difference cover modulo ``v``: every residue is a difference of two
members. Anchors are windows of ``length - v + 1`` words, hashed only where the position in the document modulo ``v`` is
in ``D``. Two equal passages of ``length`` words share, whatever their positions, an offset below ``v`` at which both have
an anchor, and these anchors are equal. So only windows that contain a repeated anchor can repeat; they are extended to
their full length and compared.

Documents are dealt into chunks by a hash. A chunk sends each distinct hash once (twice if it occurs there more than
once) to the hash's range, which answers with the repeated ones. A passage in a third of all documents is therefore one
entry per chunk, and no task sees all places of a passage. All three passes read one shuffle of the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames, words

# Perfect difference sets, period: residues.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Words an anchor has at least, if the passage is long enough: shorter ones repeat by chance.
LEAST_ANCHOR = 12


def cover(length: int) -> tuple[int, tuple[int, ...], int]:
    """Period, residues and anchor words for passages of ``length`` words."""
    fit = [v for v in COVERS if v == 1 or length - v + 1 >= min(LEAST_ANCHOR, (length + 1) // 2)]
    period = max(v for v in fit if v <= length)
    return period, COVERS[period], length - period + 1


def _anchors(found: words.Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and hash of each anchor."""
    period, residues, size = cover(length)
    chosen = np.zeros(period, bool)
    chosen[list(residues)] = True
    at = np.flatnonzero(chosen[found.place() % period] & (found.left() >= size))
    return at, words.windows(hashes, at, size)


def _twice(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted values, each at most twice."""
    values = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    third = np.zeros(len(values), bool)
    third[2:] = values[2:] == values[:-2]
    return values[~third]


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _dealt(chunk: int, values: np.ndarray, ranges: int) -> pa.Table:
    """One row for each range of hashes that the chunk has values of."""
    frames.trim()
    part = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    names, begin = np.unique(part, return_index=True)
    cut = np.split(values, begin[1:]) if len(names) else []
    return pa.table({
        "chunk": pa.array([chunk] * len(cut), pa.int64()), "part": pa.array(names.astype(np.int64)),
        "hashes": pa.array([c.tobytes() for c in cut], pa.binary()),
    })


def _repeated(rows: DataFrame) -> DataFrame:
    """For each chunk those of its hashes that occur at least twice in all."""

    def answer(group: pa.Table) -> pa.Table:
        sent = [np.frombuffer(b, np.uint64) for b in group["hashes"].to_pylist()]
        every = np.sort(np.concatenate(sent))
        again = np.unique(every[1:][every[1:] == every[:-1]])
        back = [np.unique(s[_member(s, again)]).tobytes() for s in sent]
        frames.trim()
        return pa.table({"chunk": group["chunk"], "hashes": pa.array(back, pa.binary())}).filter(pa.array([b != b"" for b in back], pa.bool_()))

    return rows.groupBy("part").applyInArrow(answer, "chunk long, hashes binary")


def _known(answers: pa.Table) -> np.ndarray:
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(b, np.uint64) for b in answers["hashes"].to_pylist())]))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 35, chunks: int | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_text``: the words outside all repeated windows, joined by a space.

    A word goes if a window of ``length`` words covers it whose word sequence also starts anywhere else, in the same
    document or in another. Windows are judged on the input. Null and empty texts have no words and an empty
    ``kept_text``; repeated rows are documents of their own, so their long passages go. Other columns stay as they are.
    Windows are compared by 64-bit hashes. ``chunks`` follows the session's shuffle partitions and must be so large that
    a chunk's texts fit in a worker's memory.
    """
    spark = docs.sparkSession
    frames.ready(spark)
    parts = frames.width(spark)
    chunks = chunks or 2 * parts
    ranges = max(1, parts // 2)
    body = F.col(f"`{text}`")
    chunk = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map" not in kind]), F.lit(chunks)).cast("long")
    dealt = frames.packed(docs, text=body, chunk=chunk)

    def anchors(group: pa.Table) -> pa.Table:
        parts = []
        for low, high in words.slices(group["text"]):
            found = words.scan(group["text"].slice(low, high - low))
            parts.append(_twice([_anchors(found, found.hashes(), length)[1]]))
        return _dealt(group["chunk"][0].as_py(), _twice(parts), ranges)

    def extended(group: pa.Table, answers: pa.Table) -> pa.Table:
        known, parts = _known(answers), []
        for low, high in words.slices(group["text"]) if len(known) else []:
            found = words.scan(group["text"].slice(low, high - low))
            hashes = found.hashes()
            at, anchor = _anchors(found, hashes, length)
            seen = np.zeros(len(hashes) + 1, np.int64)
            seen[at[_member(anchor, known)] + 1] = 1
            seen = np.cumsum(seen)
            whole = np.flatnonzero(found.left() >= length)
            period = cover(length)[0]
            parts.append(_twice([words.windows(hashes, whole[seen[whole + period] > seen[whole]], length)]))
        return _dealt(group["chunk"][0].as_py() if len(group) else 0, _twice(parts), ranges)

    def removed(group: pa.Table, answers: pa.Table) -> pa.Table:
        known, kept, n_removed, n_words = _known(answers), [], [], []
        for low, high in words.slices(group["text"]):
            found = words.scan(group["text"].slice(low, high - low))
            gone = np.zeros(len(found.starts), bool)
            if len(known):
                whole = np.flatnonzero(found.left() >= length)
                hit = whole[_member(words.windows(found.hashes(), whole, length), known)]
                turn = np.zeros(len(gone) + 1, np.int64)
                turn[hit] += 1
                turn[hit + length] -= 1
                gone = np.cumsum(turn)[:-1] > 0
            data = found.data
            for k in range(high - low):
                a, b = found.first[k], found.first[k + 1]
                own = data[found.starts[a] : found.ends[b - 1]].tobytes().split() if b > a else []
                lost = gone[a:b]
                n_words.append(int(b - a))
                n_removed.append(int(lost.sum()))
                kept.append(b" ".join(own if not n_removed[-1] else [own[i] for i in np.flatnonzero(~lost)]))
        frames.trim()
        return pa.table({
            "row": group["row"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        })

    sent = "chunk long, part long, hashes binary"
    by = dealt.groupBy("chunk")
    first = _repeated(by.applyInArrow(anchors, sent))
    second = _repeated(by.cogroup(first.groupBy("chunk")).applyInArrow(extended, sent))
    out = T.StructType([
        T.StructField("row", dealt.schema["row"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
    ])
    done = by.cogroup(second.groupBy("chunk")).applyInArrow(removed, out)
    return frames.unpacked(done, docs.columns, "n_words", "n_removed", "kept_text")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Operator 1 over ``documents``; the digest of the kept words."""
    kept = remove_repeats(frames.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), p AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35
), h AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k FROM p
), hit AS (
  SELECT doc_id, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM hit)
), lists AS (
  SELECT doc_id, list(j) AS js, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(ws, ' ')
    ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(js, i)), lambda i: ws[i]), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN lists ON w.doc_id = lists.doc_id
"""
