from __future__ import annotations

import random
import re

import pytest

from martline.llm import license_scan
from martline.llm.license_scan import PHRASES, TEXTS, Scanner, found_in, op11_license_scan, scan, word_list

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def listed(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_base(text):
    ws = listed(text)
    at = [(i, label) for phrase, label in PHRASES for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return len(ws), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in at}))


def brute_matches(ws, lists):
    """Maximal matches of four words or more by trying every template place: (end, length, places)."""
    out = []
    longest = []
    for i in range(len(ws)):
        best, places = 0, []
        for k, t in enumerate(lists):
            for e in range(len(t)):
                n = 0
                while n <= min(i, e) and ws[i - n] == t[e - n]:
                    n += 1
                if n > best:
                    best, places = n, []
                if n == best and n:
                    places.append((k, e + 1))
        longest.append((best, places))
    for i, (n, places) in enumerate(longest):
        if n >= 4 and (i + 1 == len(ws) or longest[i + 1][0] != n + 1):
            out.append((i + 1, n, sorted(places)))
    return out


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    texts = [("x", f"t{k}", " ".join(rng.choices("abc", k=rng.randrange(1, 40)))) for k in range(6)]
    scanner = Scanner(texts, [("a b", "x"), ("b a c a", "y"), ("b", "z")])
    lists = [t.split() for _, _, t in texts]
    for _ in range(60):
        ws = rng.choices("abcd", k=rng.randrange(60), weights=[5, 5, 5, 1])
        n, places, long = scanner.matches(" ".join(ws).encode())
        assert n == len(ws)
        # phrases may lengthen a match that no template holds further
        got = [(end, size, scanner.placed[v]) for end, size, v in long if scanner.placed[v]]
        every = brute_matches(ws, [*lists, ["a", "b"], ["b", "a", "c", "a"], ["b"]])
        in_texts = [(end, size, [p for p in places if p[0] < len(lists)]) for end, size, places in every]
        assert got == [m for m in in_texts if m[2]]
        for k, phrase in enumerate(("a b", "b a c a", "b")):
            p = phrase.split()
            assert sorted(s for j, s in places if j == k) == [i for i in range(len(ws)) if ws[i : i + len(p)] == p]


def test_every_template_is_found_whole_and_alone():
    scanner = Scanner(TEXTS, PHRASES)
    for label, name, text in TEXTS:
        ws = word_list(text)
        padded = "Foo bar, " * 5 + text + " baz qux." * 5
        spans = found_in(padded.encode(), scanner)[5]
        assert [(s["label"], s["start"], s["end"], s["coverage"]) for s in spans] == [(label, 10, 10 + len(ws), 1.0)], name


def test_changed_text_keeps_its_label():
    scanner = Scanner(TEXTS, PHRASES)
    rng = random.Random(2)
    for label, name, text in TEXTS:
        ws = [w.decode() for w in word_list(text)]
        if len(ws) < 60:
            continue
        for k in range(12, len(ws) - 12, 25):
            ws[k] = rng.choice(["alpha", "beta gamma", ""])
        spans = found_in(" ".join(ws).encode(), scanner)[5]
        assert [s["label"] for s in spans] == [label], name
        assert 0.75 < spans[0]["coverage"] < 1


def test_two_copies_and_two_licences():
    scanner = Scanner(TEXTS, PHRASES)
    mit = next(t for _, n, t in TEXTS if n == "mit-text")
    bsd = next(t for _, n, t in TEXTS if n == "bsd-3-text")
    spans = found_in(f"{mit} one two three {mit} {bsd}".encode(), scanner)[5]
    assert [s["label"] for s in spans] == ["mit", "mit", "bsd-3-clause"]
    assert all(s["coverage"] == 1.0 for s in spans)


def corpus():
    rng = random.Random(4)
    own = [w.decode() for _, _, t in TEXTS for w in word_list(t)] + ["mit", "license", "apache", "general", "public"] * 60 + ["é", "日本", "x1"]
    texts = [None, "", " \n", "MIT License", "mit\x00LICENSE, Mit-license", "Mit licenseé", "ſ MIT LİCENSE", "general public license apache license mit license"]
    return texts + ["".join(w + rng.choice([" ", "\n", ". ", "-"]) for w in rng.choices(own, k=rng.randrange(80))) for _ in range(60)]


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(license_scan, "_BLOCK", 16)
    rows = list(enumerate(corpus())) + [(None, "MIT License"), (3, "MIT License")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    done = op11_license_scan(spark, str(tmp_path))
    got = done.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((k, *brute_base(t))) for k, t in rows)
    for r in done.collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["score"] or not r["labels"]


@pytest.mark.parametrize(("line", "base", "every", "least"), [
    ("Released under the MIT License.", "mit", "mit", 0.5),
    ("Licensed under the Apache License, Version 2.0.", "apache", "apache", 0.6),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl", 0.6),
    ("Licensed under CC BY-NC 4.0.", "", "cc-by-nc", 0.6),
    ("Permission is given to use the software and to copy it.", "", "", 0),
])
def test_notices(spark, tmp_path, line, base, every, least):
    docs = [(1, f"Some text of its own.\n{line}")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    r = op11_license_scan(spark, str(tmp_path)).first()
    assert (r["base_labels"], r["labels"]) == (base, every)
    assert r["score"] > least or r["score"] == least == 0


def test_long_text_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("mit license " * 300_000, "x", 1)], "text string, spans string, row int")
    done = scan(docs)
    assert done.columns == ["text", "row", *license_scan.MADE]
    r = done.first()
    assert (r["n_words"], r["n_base"], r["last_word"]) == (600_000, 300_000, 599_998)
    assert scan(docs.limit(0)).collect() == []
