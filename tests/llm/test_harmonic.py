from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from martline.llm.harmonic import Bins, cuts, pack
from martline.llm.tokens import TextEncoder

FILE = path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", " a", "  a", "a  b", "a \n b", "\na b", "x's it's 's", "tab\tx y", "end ", "a\x1cb c \x1cd", "<|endoftext|> a", "12 34 5a6",
    "a 　b", "é́ x", "a\nb  c\n\n d", "…— –", "a\r\n b", "日本語 テスト 😀", "x\xa0y \xa0 z", "\x85 a", "ǅ ẞ ß",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_ids_are_the_library_s(library):
    encoder = TextEncoder(FILE)
    assert encoder.fast is not None
    rng = random.Random(1)
    texts = [*ODD, *("".join(rng.choices("ab cé'\n1.<|>", k=40)) for _ in range(200))]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [1, 2, 95, 96, 1024, 1500, 2047, 2048, 2049, 4096, 10_000])
def test_cuts(n):
    parts = cuts(n)
    assert sum(parts) == n and all(0 < p <= 2048 for p in parts)
    assert all(2048 - (2048 // p) * p < 2048 // p for p in parts if p >= 96)


def test_bins_hold_a_fixed_count():
    bins = Bins(100)
    assert bins.put(40, "a") is None and bins.put(26, "x") is None and bins.put(50, "b") == [(40, "a"), (50, "b")]
    assert bins.put(100, "c") == [(100, "c")]
    assert list(bins.rest()) == [[(26, "x")]] and bins.open == {}


def test_pack(spark, library):
    rng = random.Random(2)
    texts = [None, *ODD, "word " * 30_000, *(" ".join(rng.choices(["alpha", "beta", "Gamma,", "d\n"], k=rng.randrange(900))) for _ in range(300))]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(5, "same", "clash"), (5, "same", "clash"), (None, "no id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(3)
    done = pack(docs, FILE, carry=["doc_id", "offset"])
    assert done.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    got = done.collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    waste = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
        waste += 2048 - at
    assert waste / (2048 * len(sequences)) < 0.05  # three tasks of few documents
    for k, t in enumerate(texts):
        if k != 5:
            ids = [i for _, part, _ in sorted(pieces[k]) for i in part]
            assert ids == [*library.encode(t or "", add_special_tokens=False).ids, 1] and {n for *_, n in pieces[k]} == {len(ids)}
    assert len([p for p in pieces[5] if p[0] == 0]) == 3 and pieces[None]
    assert pack(docs.limit(0), FILE).collect() == []


@pytest.mark.parametrize("gap", [" ", "\n", "\t", " \n"])
def test_millions_of_blanks(library, gap):
    texts = ["x" + gap * (2_000_000 // len(gap)) + "y", "x" + gap * 2047 + "y"]
    for text, ids in zip(texts, TextEncoder.of(FILE).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
