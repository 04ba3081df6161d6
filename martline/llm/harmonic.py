"""Packing of documents into sequences by harmonic classes (operator 6).

A class ``k`` holds pieces that are longer than ``capacity // (k + 1)`` and at most ``capacity // k`` tokens long, and a
bin of the class is filled with ``k`` of them. As documents may be cut freely, they are cut to the classes: pieces of the
whole capacity first, then, of what is left, the longest ``capacity // k`` that fits, until the rest is shorter than
``small`` and is a piece as it is. A full bin of ``capacity // k`` pieces wastes fewer than ``k`` tokens, one of small
pieces less than one part in ``k + 1``.

Each task fills its bins alone, so nothing is shuffled. The bins that its classes could not fill at the end are emptied
again and their pieces put together, longest first, into the first bin with room. Sequence numbers count from the task's number times 2**33.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames
from martline.llm.tokens import TextEncoder

CAPACITY, SMALL = 2048, 96
END_ID = 1
_TASK = 1 << 33


def cuts(n: int, capacity: int = CAPACITY, small: int = SMALL) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left >= small:
        k = -(-capacity // left)
        out.append(capacity // k)
        left -= out[-1]
    return [*out, left] if left else out


class Bins:
    """Open bins of one task: ``put`` returns the pieces of a bin once it is full."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: dict[int, list[tuple[int, object]]] = {}

    def put(self, length: int, piece: object) -> list[tuple[int, object]] | None:
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, piece))
        return self.open.pop(k) if len(held) == k else None

    def rest(self) -> Iterator[list[tuple[int, object]]]:
        """What is left, longest pieces first, each in the first bin with room for it."""
        left = sorted((p for held in self.open.values() for p in held), key=lambda p: -p[0])
        self.open = {}
        bins: list[list] = []
        room: list[int] = []
        for length, piece in left:
            at = next((i for i, r in enumerate(room) if r >= length), len(bins))
            if at == len(bins):
                bins.append([])
                room.append(self.capacity)
            bins[at].append((length, piece))
            room[at] -= length
        yield from bins


_PIECES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, small: int = SMALL, end_id: int = END_ID, carry: Sequence[str] | None = None, with_ids: bool = True) -> DataFrame:
    """A row for each piece: the columns ``carry`` of its document, where it begins there and its length in tokens, its
    ``ids`` (left out unless ``with_ids``), their CRC-32, the document's tokens, its sequence and its place there.

    ``tokenizer`` is the path of a byte-level BPE file, which every executor must have. A null or empty text is the end
    token alone. Repeated rows are packed as often as they occur. Columns of these names in ``docs`` are replaced.
    The pieces depend on the documents and their division into tasks, so a retried task gives the same rows as long as
    its input comes in the same order, as it does from files.
    """
    frames.ready(docs.sparkSession)
    columns = list(docs.columns if carry is None else carry)
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"), F.spark_partition_id().alias("task"))
    ids_type = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([dealt.schema["row"], *[T.StructField(c, T.LongType()) for c in _PIECES], *ids_type])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins, base, number = TextEncoder.of(tokenizer), Bins(capacity), 0, 0
        done: list[tuple] = []

        def close(bin_: list) -> None:
            nonlocal number
            at = 0
            for length, piece in bin_:
                done.append((*piece, base + number, at))
                at += length
            number += 1

        def flush() -> Iterator[pa.RecordBatch]:
            if not done:
                return
            taken = pa.concat_arrays([p[0] for p in done])
            columns = [taken, *[pa.array([p[k] for p in done], pa.int64()) for k in (1, 2, 3, 4, 6, 7)]]
            if with_ids:
                columns.append(pa.array([np.frombuffer(p[5], "<u4").astype(np.int32) for p in done], pa.list_(pa.int32())))
            done.clear()
            yield pa.RecordBatch.from_arrays(columns, schema.names)

        for b in batches:
            if b.num_rows:
                base = b.column("task")[0].as_py() * _TASK
            rows = b.column("row")
            for k, ids in enumerate(encoder.encode([t or "" for t in b.column("text").to_pylist()])):
                ids += end_id.to_bytes(4, "little")
                total, at, own = len(ids) // 4, 0, rows.take(pa.array([k]))  # a copy: a waiting piece must not hold its batch
                for n in cuts(total, capacity, small):
                    part = ids[4 * at : 4 * (at + n)]
                    full = bins.put(n, (own, at, n, zlib.crc32(part), total, part if with_ids else b""))
                    if full:
                        close(full)
                    at += n
                if len(done) >= 4096:
                    yield from flush()
        for bin_ in bins.rest():
            close(bin_)
        yield from flush()

    names = [*_PIECES, *(["ids"] if with_ids else [])]
    return frames.unpacked(dealt.mapInArrow(frames.per_task(packed), schema), columns, *names)


def op6_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    """Operator 6 over ``documents``."""
    from public_tokenizers import path

    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, path("byte_bpe_50k.json"), carry=["doc_id"], with_ids=False)
