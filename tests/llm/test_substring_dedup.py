from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import pytest

from martline.llm.substring_dedup import COVERS, cover, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, length):
    """(words, removed, kept text) of each text."""
    lists = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + length]) for w in lists for i in range(len(w) - length + 1))
    out = []
    for w in lists:
        gone = {j for i in range(len(w) - length + 1) if counts[tuple(w[i : i + length])] > 1 for j in range(i, i + length)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("period", COVERS)
def test_every_residue_is_a_difference(period):
    differences = {(a - b) % period for a, b in itertools.product(COVERS[period], repeat=2)}
    assert differences == set(range(period))


@pytest.mark.parametrize("length", [1, 2, 3, 5, 12, 20, 35, 50, 100])
def test_anchor_fits_into_the_passage(length):
    period, residues, size = cover(length)
    assert size >= 1 and period + size - 1 == length and max(residues) < period


def corpus():
    rng = random.Random(5)
    words = ["a", "bb", "ccc", "é", "日本"]
    passage = [" ".join(rng.choices(words, k=9)) for _ in range(3)]
    texts = [None, "", "   ", "a", "a " * 30, "\tx\x0by\x0cz\r\n", "x\x1cy é"]
    for k in range(40):
        own = " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(30)))
        texts.append(f"{own}  \n{passage[k % 3]}\t{own[::-1]}" if k % 2 else own)
    return [*texts, texts[-1], texts[-1]]


@pytest.mark.parametrize("length", [4, 9])
def test_against_brute_force(spark, length):
    texts = corpus()
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(docs, length=length).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, length)


def test_columns_nulls_repeats_and_empty_table(spark):
    rows = [(None, "b c d e", "s", "old", 1), (1, "b c d e f", None, "old", 2), (1, "z", None, "old", 2), (1, "z", None, "old", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string, kept_text string, row int")
    done = remove_repeats(docs, length=4)
    assert done.columns == ["doc_id", "text", "chunk", "row", "n_words", "n_removed", "kept_text"]
    got = sorted((r["text"], r["row"], r["n_removed"], r["kept_text"]) for r in done.collect())
    assert got == [("b c d e", 1, 4, ""), ("b c d e f", 2, 4, "f"), ("z", 2, 0, "z"), ("z", 2, 0, "z")]
    assert remove_repeats(docs.limit(0)).collect() == []
