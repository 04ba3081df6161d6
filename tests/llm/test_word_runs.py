from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from martline.llm import word_runs
from martline.llm.word_runs import find_runs, op12_periodic_runs, runs


def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if w[p:] == w[: len(w) - p])


def brute(ws, least=6, turns=4):
    """(start, length, period) of every stretch that no neighbour continues, by trying each period at each place."""
    out = []
    for p in range(1, len(ws) // turns + 1):
        i = 0
        while i + p < len(ws):
            j = i
            while j + p < len(ws) and ws[j] == ws[j + p]:
                j += 1
            s, length = i, j - i + p
            if j > i and length >= max(least, turns * p) and smallest_period(ws[s : s + length]) == p:
                out.append((s, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(ws, found):
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def periodic(doc_id, text):
    """The documents of the query, by its own words."""
    ws = (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    ws = [w for w in ws if w]
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and ws:
        g, n = h // 10, len(ws)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    return ws


@pytest.mark.parametrize(("least", "turns"), [(6, 4), (2, 2), (4, 3), (1, 2)])
def test_runs_of_many_texts_at_once(least, turns):
    rng = random.Random(7)
    texts = [[], [1], [1] * 40, [1, 2] * 20, [1, 1, 2] * 9 + [1, 1], [1, 1, 1, 1, 1, 1, 2] * 5]
    for k in range(400):
        part = rng.choices(range(1, 2 + k % 4), k=rng.randrange(1, 9))
        texts.append(rng.choices(range(1, 4), k=rng.randrange(20)) + part * rng.randrange(1, 8) + rng.choices(range(1, 4), k=rng.randrange(20)))
    codes, begin = [], []
    for k, t in enumerate(texts):
        begin.append(len(codes))
        codes += [x + len(texts) for x in t] + [k]
    found = runs(np.array(codes, np.int64), least, turns)
    owner = np.searchsorted(begin, found[:, 0], "right") - 1
    for k, t in enumerate(texts):
        got = [(s - begin[k], e - s, p) for s, e, p in found[owner == k].tolist()]
        assert got == brute(t, least, turns), t


def test_suffix_array_and_lcp():
    rng = random.Random(3)
    codes = np.array([*rng.choices(range(1, 4), k=300), 0], np.int64)
    sa, isa, ranks = word_runs.suffix_array(codes)
    assert sa.tolist() == sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
    assert (isa[sa] == np.arange(len(codes))).all()
    lcp = word_runs.lcp_table(sa, ranks)
    for k in range(1, len(codes)):
        a, b = codes[sa[k - 1] :].tolist(), codes[sa[k] :].tolist()
        assert lcp[k] == next(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y)


def test_one_word_a_hundred_thousand_times_and_a_long_period():
    n = 100_000
    assert runs(np.array([*[5] * n, 0], np.int64)).tolist() == [[0, n, 1]]
    codes = np.concatenate([np.tile(np.arange(1, 25_001), 4), [0]])
    assert runs(codes).tolist() == [[0, 100_000, 25_000]]


def test_texts_against_brute_force(spark):
    rng = random.Random(11)
    texts = [None, "", " \n", "a", "a " * 6, "a " * 5, "A a " * 4, "x\x1cy " * 7, "日 本\t" * 5 + "日", "ab a b " * 6]
    texts += [" ".join(rng.choices("ab", k=3)) + " " + " ".join(rng.choices("abc", k=rng.randrange(1, 5)) * rng.randrange(9)) for _ in range(60)]
    texts += [texts[-1]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in find_runs(docs).collect()}
    for k, t in enumerate(texts):
        ws = [w.decode() for w in (t or "").encode().split()]
        expected = brute(ws)
        assert [tuple(r) for r in got[k]["runs"]] == expected
        assert (got[k]["n_words"], got[k]["collapsed"]) == (len(ws), collapsed(ws, expected))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(13)
    rows = [(k, "\n".join(" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 30))) for _ in range(3)), "en") for k in range(150)]
    rows += [(None, "a " * 9, "en"), (200, None, "en"), (201, "", None), (202, "  ", "en"), (3, rows[3][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    done = op12_periodic_runs(spark, str(tmp_path))
    assert done.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def expected(doc_id, text):
        ws = periodic(doc_id, text) if doc_id is not None else text.split()
        found = brute(ws)
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
        milli = 1000 * top[1] // top[2] if found else None
        return (doc_id, len(found), *top, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(ws, found))))

    assert sorted(map(str, map(tuple, done.collect()))) == sorted(str(expected(r[0], r[1])) for r in rows)
    assert any(r["n_runs"] for r in done.collect())


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("a a a a a a b", "x", 1)], "text string, runs string, row int")
    done = find_runs(docs)
    assert done.columns == ["text", "row", "n_words", "runs", "collapsed"]
    assert done.first()["collapsed"] == "a b"
    assert find_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="two turns"):
        find_runs(docs, min_turns=1)
