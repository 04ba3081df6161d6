from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import ball_tree as b

SCHEMA = "vec_id long, embedding array<float>, score string"


def expected(rows, scale=1024, k=10, every=5):
    sound = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            w = [int(np.floor(scale * float(np.float32(x)))) for x in v]
            sound[i] = min(sound.get(i, w), w)
    out = []
    for q, x in sound.items():
        if q % every == 0:
            best = sorted((-sum(a * c for a, c in zip(x, y, strict=True)), i) for i, y in sound.items() if i != q and len(y) == len(x))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_rows": 7, "leaf": 4}])
def test_against_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)], "c") for i in range(150)]
    rows += [(200 + i, rows[0][1], "c") for i in range(60)]  # ties
    rows += [(300, None, "n"), (None, rows[1][1], "n"), (305, [1.0, None, 0.0, 0.0, 0.0, 0.0], "n"), (310, [float("nan")] * 6, "n"), (315, [float("inf")] + [0.0] * 5, "n")]
    rows += [(320, [0.0] * 6, "z"), (325, [1.0, 2.0], "short"), (326, [1.0, 2.0], "short"), rows[3], (3, [9.0] * 6, "again")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in b.top_k(df, F.col("vec_id") % 5 == 0, **sizes).collect())
    assert got == expected(rows)


def test_large_components_and_small_tables(spark):
    rows = [(0, [2.0**20, 1.0], "a"), (5, [2.0**20, -1.0], "a"), (6, [-(2.0**20), 3.0], "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in b.top_k(df, F.col("vec_id") % 5 == 0).collect()) == expected(rows)
    assert b.top_k(df.limit(0), F.col("vec_id") % 5 == 0).collect() == []
    assert b.top_k(df.filter("vec_id = 6"), F.col("vec_id") % 5 == 0).collect() == []


def test_bounds_skip_most_leaves():
    """Far clusters are not opened once the k-th score is known."""
    rng = np.random.default_rng(1)
    near = rng.integers(900, 1000, (200, 4))
    x = np.concatenate([near, -near, -near - 7])
    tree = b.Tree(x.astype(float), 16)
    opened = []

    class Rows(list):
        def __getitem__(self, k):
            opened.append(k)
            return list.__getitem__(self, k)

    original = b.Tree.__init__

    def watched(self, *a):
        original(self, *a)
        self.rows = Rows(self.rows)

    b.Tree.__init__ = watched
    try:
        b.search(x, np.arange(len(x)), near[:3], np.array([0, 1, 2]), np.full(3, -np.inf), leaf=16)
    finally:
        b.Tree.__init__ = original
    assert len(set(opened)) < len(tree.rows) / 2
