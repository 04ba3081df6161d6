from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import toxicity as t


def test_newton_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 6)) < 0.3).astype(float)
    y = (x[:, 0] + rng.random(400) > 0.9).astype(float)
    w = t.fit_linear(x, y, ridge=0.1)
    p = t.predict_linear(w, x)
    slope = np.column_stack([x, np.ones(400)]).T @ (p - y) + np.append(0.1 * w[:-1], 0)
    assert np.abs(slope).max() < 1e-3
    assert np.isfinite(t.fit_linear(x, x[:, 0])).all() and np.isfinite(t.fit_linear(x, np.zeros(400))).all()


def test_later_model_is_fitted_on_out_of_fold_probabilities(monkeypatch):
    rng = np.random.default_rng(1)
    x = (rng.random((200, 3)) < 0.5).astype(float)
    y = np.column_stack([x[:, 0], (x[:, 0] * x[:, 1])])
    seen, fit = [], t.fit_linear
    monkeypatch.setattr(t, "fit_linear", lambda a, b, *k: seen.append((a, b)) or fit(a, b, *k))
    fold = np.arange(200) % 4
    chain = t.fit_chain(x, y, fold, ["a", "b"], np.zeros(3, np.uint64))
    assert [len(w) for w in chain.weights] == [4, 5]
    last = seen[-1][0]
    for f in range(4):
        w = fit(x[fold != f], y[fold != f, 0])
        np.testing.assert_allclose(last[fold == f, 3], t.predict_linear(w, x[fold == f]))
    assert chain.predict(x).shape == (200, 2)


def corpus(n, seed):
    rng = random.Random(seed)
    bad, rows = ["vile", "scum", "grimoth", "grimander", "grimule"], []
    for k in range(n):
        own = [f"{rng.choice('bcdf')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(60)]
        toxic = k % 5 == 0
        if toxic:
            own[rng.randrange(60)] = rng.choice(bad) + rng.choice([".", "!", ""])
            own[rng.randrange(60)] = rng.choice(bad).upper()
        rows.append((k, " ".join(own), int(toxic), int(toxic and k % 10 == 0)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(1200, 3)
    more = [(5000, None), (5001, ""), (5002, "word " * 50_000 + "scum"), (None, rows[0][1]), (5003, rows[5][1]), (5003, rows[5][1])]
    docs = spark.createDataFrame([(i, x, "old") for i, x, *_ in rows] + [(i, x, "old") for i, x in more], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, a, b) for i, _, a, b in rows[:600]] + [(None, 1, 1), (7, None, 0), (9999, 1, 1), (3, 0, 0)], "doc_id long, toxic int, severe int")
    chain = t.fit(docs, labels, ["toxic", "severe"])
    done = t.scored(docs, chain)
    assert done.columns == ["doc_id", "text", "p_toxic", "p_severe", "toxic"]
    got = {r["doc_id"]: r for r in done.collect()}
    wrong = [i for i, _, toxic, _ in rows[600:] if got[i]["toxic"] != bool(toxic)]
    assert len(wrong) < 20
    assert not got[5000]["toxic"] and not got[5001]["toxic"] and got[5002]["toxic"] and got[None]["toxic"] and got[5003]["toxic"]
    assert sum(r["doc_id"] == 5003 for r in done.collect()) == 2
    assert t.scored(docs.limit(0), chain).collect() == []
    assert t.scored(docs, chain).orderBy("doc_id").collect() == done.orderBy("doc_id").collect()


@pytest.mark.parametrize("rows", [[], [(0, 0, 0)], [(0, 1, None)]])
def test_few_labels(spark, rows):
    docs = spark.createDataFrame([(0, "a b c"), (1, "d")], "doc_id long, text string")
    chain = t.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int, severe int"), ["toxic", "severe"])
    assert t.scored(docs, chain).filter(F.col("toxic")).count() == 0


def test_sample_is_bounded(spark):
    rows = corpus(300, 4)
    docs = spark.createDataFrame([(i, x) for i, x, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, a) for i, _, a, _ in rows], "doc_id long, toxic int")
    assert t._sampled(docs, labels, ["toxic"], "doc_id", "text", 50).count() == 50
