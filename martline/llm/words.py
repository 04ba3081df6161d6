"""Words of many texts as numpy arrays: byte ranges, hashes of words and of windows of words.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Hashes
are 64-bit sums of mixed values times powers of an odd number, so the hash of any window is a difference of two running
sums. They depend on the bytes alone: every task and every retry gets the same values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_BLOCK = 1 << 20
_U = np.uint64
#: Bytes of words.
INSIDE = np.ones(256, bool)
INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BYTE_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = max(n, 1 << 16)
        held = np.full(size, base, np.uint64)
        held[0] = 1
        held = _POWERS[base] = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums of ``values[i] * base**i``, starting with 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=out[1:])
    return out


def _between(sums: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Position-free hash of the values in ``first:last``."""
    back = _powers(pow(base, -1, 1 << 64), len(sums))
    return (sums[last] - sums[first]) * back[first]


@dataclass
class Words:
    """``starts``/``ends``: bytes of each word in ``data``; ``first``: index of each text's first word, with one past the last."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return self.stems(())[0][1]

    def stems(self, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Word indexes and hashes: of all words whole, then for each of ``sizes`` of the first bytes of words that long."""
        out: list[list[tuple[np.ndarray, np.ndarray]]] = [[(np.zeros(0, np.int64), np.zeros(0, np.uint64))] for _ in (0, *sizes)]
        at = 0
        while at < len(self.starts):
            upto = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + _BLOCK)))
            low, high = self.starts[at], self.ends[upto - 1]
            sums = _sums(_BYTES[self.data[low:high]], _BYTE_BASE)
            s, e = self.starts[at:upto] - low, self.ends[at:upto] - low
            every = np.arange(at, upto)
            out[0].append((every, mix(_between(sums, s, e, _BYTE_BASE) + (e - s).astype(np.uint64))))
            for k, n in enumerate(sizes, 1):
                long = e - s >= n
                out[k].append((every[long], mix(_between(sums, s[long], s[long] + n, _BYTE_BASE) ^ _U(n << 32))))
            at = upto
        return [(np.concatenate([x[0] for x in part]), np.concatenate([x[1] for x in part])) for part in out]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def place(self) -> np.ndarray:
        """Index of each word within its text."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts())

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts()) - np.arange(len(self.starts))


def windows(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each of the word indexes ``at``."""
    return mix(_between(_sums(hashes, _WORD_BASE), at, at + size, _WORD_BASE) + _U(size))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins, with one past the last; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # too large for one array of 32-bit offsets
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks])
    if texts.null_count:
        texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def scan(texts: pa.Array, inside: np.ndarray = INSIDE) -> Words:
    """Words of all texts; ``inside`` says which bytes belong to words."""
    data, at = raw(texts)
    inside = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


def slices(texts: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``most`` bytes; a longer text is a range of its own."""
    _, at = raw(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield low, high
        low = high
