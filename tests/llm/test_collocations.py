from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from martline.llm import collocations as c
from martline.llm.collocations import collocations

LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows, least, longest, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every piece."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(ws[i : i + k] for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            inside = (q for q, b in often.items() if len(q) > len(p) and b >= a)
            if any(q[i : i + len(p)] == p for q in inside for i in range(len(q) - len(p) + 1)):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(6)
    rows = [(None, "en"), ("", "en"), (" \t", None), (". , ;", "en"), ("A b A B a b A b", None), ("É é", "fr"), ("a\x0bb\x0ca\rb a\x1cb", "en")]
    for k in range(60):
        vocabulary = ["a", "B", "b", "ccc", "É", "日本", "x\x1cy"][: 3 + k % 5]
        text = "".join(w + rng.choice([" ", " ", "\t ", ". ", "\n"]) for w in rng.choices(vocabulary, k=rng.randrange(60)))
        rows += [(text, ["en", "fr", None][k % 3])] * (1 + k % 2)
    return rows


@pytest.mark.parametrize(("least", "longest", "top"), [(3, 5, 2000), (2, 3, 7), (10, 5, 5), (1, 4, 2000)])
def test_against_brute_force(spark, monkeypatch, least, longest, top):
    monkeypatch.setattr(c, "BLOCK", 200)  # many blocks
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = collocations(docs, least=least, longest=longest, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, longest, top)


def test_products_beyond_64_bits(spark):
    found = spark.createDataFrame([("en", 2, "a b", 10**12, [10**12 + 7, 10**12], [3 * 10**12, 10**12], None)], "lang string, words int, phrase string, a long, firsts array<long>, lasts array<long>, longer long")
    n = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    assert c.scored(found, n).first()["score"] == 1000 * 10**12 * 10**14 // ((10**12 + 7) * 3 * 10**12)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("a b a b", "x", 1, "p"), ("a b", "x", 2, "q")], "text string, lang string, n int, phrase string")
    assert [tuple(r) for r in collocations(docs, least=3).collect()] == [("x", 1, "a b", 3, 3, 3, 6, 2000)]
    assert collocations(docs.limit(0)).collect() == []
