"""BPE with word ends: encoding by merge ranks in a priority queue over a linked list of symbols, and decoding (operator 8).

A word starts as its bytes' letters, the last one with the word-end mark. All neighbours that can merge wait in a heap by
rank and place. The best pair merges, its symbol takes the place of the left one, the right one leaves the list, and the
pairs with the new neighbours join the heap. Entries whose symbols have changed meanwhile are skipped when they come up.

A task encodes each distinct word once, as long as it is in a store of bounded size; texts of any length go through piece
by piece. Nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames
from martline.llm.tokens import byte_letters

# What the file's normalizer and pre-tokenizer do.
WORD_END = "</w>"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^" + WHITE + "\\p{L}\\p{N}]+"

_SPLIT = re.compile(f"[{WHITE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


class Store:
    """Values by key in two generations of at most ``size`` keys each: what is in use stays, memory is bounded."""

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """The keys without a value; all others are in the young generation afterwards."""
        if len(self.young) + len(keys) > self.size:
            self.young, self.old = {}, self.young
        new = []
        for k in keys - self.young.keys():
            v = self.old.get(k)
            if v is None:
                new.append(k)
            else:
                self.young[k] = v
        return new


class WordBpe:
    """The model of one vocabulary file."""

    _HELD: dict[str, WordBpe] = {}
    STORE_SIZE = 150_000

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab: dict[str, int] = file["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in (vocab | self.special).items():
            self.strings[i] = token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letters = byte_letters()
        self.inner = {b: vocab[c] for c, b in letters.items()}
        self.last = {b: vocab[c + WORD_END] for c, b in letters.items()}
        self.pattern = regex.compile(PATTERN)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces, self.words = Store(self.STORE_SIZE), Store(self.STORE_SIZE)

    @classmethod
    def of(cls, path: str) -> WordBpe:
        """The worker's model of this file, kept from task to task."""
        if path not in cls._HELD:
            cls._HELD[path] = cls(path)
        return cls._HELD[path]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        if n == 1:
            return ids
        merges = self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has merged since
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((made, ids[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, made, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], made))
                if found:
                    heapq.heappush(queue, (found[0], h, ids[h], made, found[1]))
        return [i for i in ids if i >= 0]

    def _cut(self, text: str) -> list[str]:
        """Pieces between white space; special tokens as they are, after a line break, which no piece holds."""
        out: list[str] = []
        parts = self.specials.split(text) if self.specials and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append("\n" + part)
            elif _SEPARATORS.search(part):  # Python's own split takes them for white space
                out.extend(p for p in _SPLIT.split(part) if p)
            else:
                out.extend(part.split())
        return out

    def _learn(self, pieces: set[str]) -> None:
        unknown = self.pieces.missing(pieces)
        held: dict[str, list[str]] = {}
        for p in unknown:
            if p[0] == "\n":
                continue
            plain = p if p.isascii() else unicodedata.normalize("NFC", p)
            plain = plain.lower() if "Σ" not in plain else "".join(c.lower() for c in plain)  # letter by letter: no final sigma
            held[p] = self.pattern.findall(plain)
        every: set[str] = set()
        every.update(*held.values())
        for w in self.words.missing(every):
            self.words.young[w] = np.array(self.encode_word(w), "<u4").tobytes()
        known = self.words.young
        for p in unknown:
            self.pieces.young[p] = b"".join(map(known.__getitem__, held[p])) if p in held else np.array([self.special[p[1:]]], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian 32-bit numbers."""
        cut = [self._cut(t) for t in texts]
        every: set[str] = set()
        every.update(*cut)
        self._learn(every)
        known = self.pieces.young
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings of all ids, special tokens too, with a space between, as the library joins them without a decoder."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _mapped(df: DataFrame, source: str, name: str, kind: T.DataType, arrow: pa.DataType, each) -> DataFrame:
    """``df`` with the column ``name``, made from batches of ``source``."""
    frames.ready(df.sparkSession)
    dealt = frames.packed(df, value=F.col(f"`{source}`"))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(each(b.column("value").to_pylist()), arrow)], ["row", name])

    return frames.unpacked(dealt.mapInArrow(frames.per_task(mapped), T.StructType([dealt.schema["row"], T.StructField(name, kind)])), df.columns, name)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as little-endian 32-bit numbers; a null text counts as empty and has none.

    ``vocabulary`` is the path of the file, which every executor must have. Special tokens are found in the text as the
    library finds them. Repeated rows are encoded each; a column named as ``into`` is replaced.
    """
    return _mapped(docs, text, into, T.BinaryType(), pa.binary(), lambda texts: WordBpe.of(vocabulary).encode([t or "" for t in texts]))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the ids stand for; null ids give an empty text."""
    return _mapped(encoded, ids, into, T.StringType(), pa.string(), lambda every: [WordBpe.of(vocabulary).decode(i or b"") for i in every])


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Operator 8 over ``documents``: encoded, then decoded from the ids."""
    from public_tokenizers import path

    file = path("word_bpe_49k.json")
    coded = encode(frames.table(spark, sf_dir, "documents").select("doc_id", "text"), file).drop("text")
    back = decode(coded, file)
    return back.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
