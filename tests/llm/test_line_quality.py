from __future__ import annotations

import re
from collections import Counter

import pytest

from martline.llm.line_quality import cleared, judged, line_hash, normalised

LETTERS = str.maketrans("0123456789", "abcdefghij")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    triples = Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    inside = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if triples[t] > 1 for j in (i, i + 1, i + 2)}  # noqa: B905
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_normalised_lines():
    assert normalised(b"  Page 12 of\t300 ") == normalised(b"page 7 OF 41") == b"page 0 of 0"
    assert line_hash(b"A b") == line_hash(b"a  B\r") != line_hash(b"a c")


@pytest.fixture(scope="module")
def done(spark):
    def body(k, n=60):
        return " ".join(f"w{k}x{i}" for i in range(n))

    mostly = "Sign up for our letter today and never miss any of the news again\n" * 9
    rows = [(k, f"{body(k)}\nAll rights reserved {k}", "h", 0) for k in range(40)]
    rows += [(100 + k, mostly + body(k, 12), "h", 0) for k in range(30)]  # depleted
    rows += [(200 + k, f"{body(1000)}\n{body(1001)}", "h", 0) for k in range(50)]  # copies of a good text
    rows += [(300 + k, f"{body(1002)} e{k}\n{body(1003)}", "h", 0) for k in range(50)]  # near copies
    rows += [(400 + k, mostly + body(k, 12), f"other{k}", 0) for k in range(3)]  # hosts where the line is rare
    rows += [(500, None, "h", 0), (501, "", None, 0), (502, "ab " * 100, None, 0), (503, "é* | <b>\n\n x \n x \nx", "h", 0), (504, body(77), None, 0), (None, body(78), "h", 0), (504, body(77), None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")
    return rows, docs, judged(docs).collect()


def test_base_counts(done):
    rows, _, got = done
    assert len(got) == len(rows)
    expected = sorted((str(i), *base(t)) for i, t, _, _ in rows)
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == expected
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_verdicts(done):
    _, docs, got = done
    assert Counter(got[0].asDict().keys())["kept"] == 1
    kept = {}
    for r in got:
        kept.setdefault(r["doc_id"], set()).add(r["kept"])
    for low, high, verdict in ((0, 40, True), (100, 130, False), (200, 250, True), (300, 350, True)):
        assert all(kept[k] == {verdict} for k in range(low, high)), (low, verdict)
    assert kept[504] == kept[None] == {True} and kept[500] == kept[501] == kept[502] == {False}
    lost = {r["doc_id"]: r["n_removed_words"] for r in got}
    assert lost[0] == 4 and lost[200] == lost[300] == lost[400] == 0


def test_rare_lines_stay(spark):
    docs = spark.createDataFrame([(k, "the same line everywhere\n" + " ".join(f"d{k}w{i}" for i in range(55)), "h") for k in range(10)], "doc_id long, text string, source string")
    assert all(r["kept"] and r["n_removed_words"] == 0 for r in judged(docs).collect())
    assert judged(docs.limit(0)).collect() == []


def test_pages_that_are_mostly_boilerplate(spark):
    """Their least hash lies in what they share; 300 changed copies of one of them beside them alter nothing."""
    def drawn(k, n):
        return [f"{k}{i}".translate(LETTERS) for i in range(n)]  # digits would count as one

    shared = "\n".join(" ".join(drawn(f"s{i}x", 12)) for i in range(10))
    pages = [(k, f"{shared}\n{' '.join(drawn(f"p{k}x", 30))}", "h") for k in range(200)]
    text = [drawn(f"t{i}x", 15) for i in range(12)]
    changed = []
    for k in range(400):  # a good text, one to three words of which are others in each copy
        own = [list(x) for x in text]
        for j in range(1 + k % 3):
            own[(k * 7 + j * 5) % 12][(k + j) % 15] = f"c{k}x{j}".translate(LETTERS)
        changed.append((1000 + k, "\n".join(map(" ".join, own)), "h"))
    schema = "doc_id long, text string, source string"
    for rows in (pages, pages + changed, pages + [(2000 + k, f"{shared}\n{' '.join([*drawn('p0x', 30), f'z{k}'.translate(LETTERS)])}", "h") for k in range(300)]):
        got = judged(spark.createDataFrame(rows, schema)).collect()
        assert len(got) == len(rows)
        assert all(r["kept"] == (1000 <= r["doc_id"] < 2000) and r["n_removed_words"] == (0 if r["kept"] else 120) for r in got)


def test_verdict_does_not_depend_on_the_size_of_the_host(spark):
    common = "the line of some pages " * 4
    rows = [(k, f"{common}\n{' '.join(f'd{k}w{i}' for i in range(55))}", "h") for k in range(25)]
    rows += [(100 + k, " ".join(f"e{k}w{i}" for i in range(55)), "h") for k in range(2600)]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("doc_id < 100").collect()
    assert len(got) == 25 and all(r["n_removed_words"] == 20 for r in got)


@pytest.mark.parametrize("own", [(30,), (8,), (2,), (30, 8, 2, 0)])
def test_pages_of_one_template_are_judged_alike(spark, own):
    def drawn(k, n):
        return [f"{k}{i}".translate(LETTERS) for i in range(n)]

    shared = "\n".join(" ".join(drawn(f"s{i}x", 12)) for i in range(10))
    rows = [(1000 * n + k, f"{shared}\n{' '.join(drawn(f'p{k}x{n}y', n))}", "h") for n in own for k in range(200)]
    good = "\n".join(" ".join(drawn(f"g{i}x", 15)) for i in range(12))
    rows += [(-1 - k, good, "h") for k in range(300)]  # copies of a good text
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] < 0) and r["n_removed_words"] == (0 if r["doc_id"] < 0 else 120) for r in got)


def test_long_documents_of_frequent_and_own_lines(spark):
    rng = "abcdefghij"

    def lines(name):
        return "\n".join(f"{name} {name}{str(k).translate(LETTERS)} {name}{str(k * 7).translate(LETTERS)}x" for k in range(4000))

    shared = lines("common")
    rows = [(d, f"{shared}\n{lines('own' + rng[d % 10] + rng[d // 10])}", "h") for d in range(25)]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, source string"), carry=["doc_id"]).collect()
    common = len(shared.split())
    assert len(got) == 25 and all(r["n_removed_words"] >= common for r in got)


def test_cleared_texts(spark):
    line = "A line of the template 7"
    rows = [(k, f"{line}\n\n {' '.join(f'd{k}w{i}' for i in range(55))}\n{line.lower()} ", "h", "x") for k in range(25)] + [(100, None, "h", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, removed_lines string")
    done = cleared(judged(docs, carry=["doc_id", "text", "source"]).select("doc_id", "text", "source", "removed_lines"))
    assert done.columns == ["doc_id", "text", "source", "removed_lines"]
    got = {r["doc_id"]: r["text"] for r in done.collect()}
    assert got == {100: None} | {k: f"\n {' '.join(f'd{k}w{i}' for i in range(55))}" for k in range(25)}
