"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound (operator 3).

The inner product of a query ``q`` with any vector in a ball of center ``c`` and radius ``r`` is at most ``q.c + |q| r``. A
block of queries walks the tree of a shard together: nodes come in the order of their largest bound, a query leaves a node
as soon as the bound falls below its current k-th score, and a node without queries is skipped with all below it.

Candidates are dealt into shards and queries into blocks of bounded size; every block meets every shard once, as exact
search asks. The k-th scores are shared across shards too: each block first searches one shard, and its k-th scores there
are where the search in all other shards starts. Each pair of shard and block returns at most k rows a query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm import frames

K, LEAF, SHARD_ROWS, BLOCK_ROWS = 10, 128, 20_000, 1_000
#: Whole numbers up to here are exact as doubles.
_EXACT = 1 << 53


class Tree:
    """Balls over the rows of ``x``: children, or the rows of a leaf."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF) -> None:
        self.x, self.center, self.radius, self.children, self.rows = x, [], [], [], []
        waiting = [(np.arange(len(x)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            at = len(self.center)
            if parent >= 0:
                self.children[parent][side] = at
            points = x[rows]
            center = points.mean(0)
            far = np.sqrt(((points - center) ** 2).sum(1))
            self.center.append(center)
            self.radius.append(far.max())
            self.children.append([-1, -1])
            a = points[far.argmax()]
            from_a = ((points - a) ** 2).sum(1)
            near_b = ((points - points[from_a.argmax()]) ** 2).sum(1) < from_a
            if len(rows) <= leaf or not near_b.any():  # small, or all alike
                self.rows.append(rows)
                continue
            self.rows.append(None)
            waiting += [(rows[near_b], at, 1), (rows[~near_b], at, 0)]


class Best:
    """The k best of each query so far, equal scores by smaller id."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.k = k
        self.score = np.full((len(floor), k), -np.inf)
        self.id = np.full((len(floor), k), np.iinfo(np.int64).max)
        self.floor = floor

    def kth(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: of the queries with the candidates ``ids``."""
        hit = scores >= self.kth()[queries][:, None]
        some = hit.any(1)
        queries, every = queries[some], hit[some].any(0)
        score = np.concatenate([self.score[queries], scores[some][:, every]], 1)
        at = np.concatenate([self.id[queries], np.broadcast_to(ids[every], (len(queries), int(every.sum())))], 1)
        order = np.argsort(at, 1, kind="stable")
        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(score, order, 1), 1, kind="stable"), 1)[:, : self.k]
        self.score[queries] = np.take_along_axis(score, order, 1)
        self.id[queries] = np.take_along_axis(at, order, 1)


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int = K, leaf: int = LEAF) -> Best:
    """The ``k`` best rows of ``x`` for each of ``q`` but those with its ``own`` id; scores below ``floor`` may be left out."""
    tree, best = Tree(x.astype(float), leaf), Best(floor, k)
    q = q.astype(float)
    norm = np.sqrt((q**2).sum(1))
    center, radius = np.array(tree.center), np.array(tree.radius)
    # A bound is rounded, so it gets a little room.
    bound = (q @ center.T + norm[:, None] * radius) * (1 + 1e-12) + 1e-9 * (1 + norm[:, None] * (radius + np.sqrt((center**2).sum(1))))
    waiting = [(-np.inf, 0, np.arange(len(q)))]
    while waiting:
        _, node, active = heapq.heappop(waiting)
        active = active[bound[active, node] >= best.kth()[active]]
        if not len(active):
            continue
        rows = tree.rows[node]
        if rows is None:
            for child in tree.children[node]:
                heapq.heappush(waiting, (-bound[active, child].max(), child, active))
            continue
        scores = q[active] @ tree.x[rows].T
        scores[own[active][:, None] == ids[rows]] = -np.inf
        keep = np.isfinite(scores).any(0)
        best.add(active, scores[:, keep], ids[rows][keep])
    return best


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.int64())
    return flat.to_numpy().reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def vectors(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``vec_id``, ``v`` (floor of ``scale`` times each component) and ``dim`` of the rows that take part."""
    source = F.col(f"`{embedding}`")
    sound = F.forall(source, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    v = F.transform(source, lambda x: F.floor(x.cast("double") * scale))
    return df.filter(F.col(f"`{vec_id}`").isNotNull() & source.isNotNull() & sound).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def top_k(df: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: int = 1024, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows that ``is_query`` (a condition on ``vec_id``) their ``k`` best others.

    Scores are inner products of whole numbers; equal ones are ranked by smaller id. Rows with a null id, a null vector
    or a null or non-finite component take no part. An id that repeats counts once, with its smallest vector. Vectors
    of different lengths have no inner product with each other. Scores that leave 64 bits are an error.
    """
    spark = df.sparkSession
    frames.ready(spark)
    every = frames.written(vectors(df, vec_id, embedding, scale))
    n = every.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard_rows)), max(1, -(-n["q"] // block_rows))
    dealt = every.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = every.filter(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    pairs = [F.col("dim"), F.col("shard"), F.col("block")]
    shard_of = F.pmod(F.col("block"), F.lit(shards))
    candidates = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    result = "query_id long, vec_id long, score long"

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        dim = left["dim"][0].as_py()
        x, q = _matrix(left["v"], dim), _matrix(right["v"], dim)
        ids, own = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        floor = np.array([-np.inf if f is None else f for f in right["floor"].to_pylist()], float)
        order = np.argsort(ids)
        if dim * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < _EXACT:
            best = search(x[order], ids[order], q, own, floor, k, leaf)
            at, rank = np.nonzero(np.isfinite(best.score))
            out = own[at], best.id[at, rank], best.score[at, rank].astype(np.int64)
        else:  # whole numbers of any size, one query at a time
            out = ([], [], [])
            for query, mine in zip(q.astype(object), own, strict=True):
                scores = x.astype(object) @ query
                for s, i in sorted(((-s, i) for s, i in zip(scores, ids.tolist(), strict=True) if i != mine))[:k]:
                    for column, value in zip(out, (int(mine), i, -s), strict=True):
                        column.append(value)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in out), strict=True)))

    def met(some: DataFrame, asked: DataFrame) -> DataFrame:
        # Aliases: both sides come from one table, and a cogroup tells columns by where they come from.
        some = some.select(*[F.col(c).alias(c) for c in ("dim", "shard", "block", "vec_id", "v")])
        asked = asked.select(*[F.col(c).alias(c) for c in ("dim", "shard", "block", "vec_id", "v", "floor")])
        return some.groupBy(*pairs).cogroup(asked.groupBy(*pairs)).applyInArrow(searched, result)

    first = met(candidates.filter(F.col("shard") == shard_of), queries.filter(F.col("shard") == shard_of).withColumn("floor", F.lit(None).cast("long")))
    if shards > 1:
        first = frames.written(first)
        floors = first.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
        rest = queries.filter(F.col("shard") != shard_of).join(floors, F.col("vec_id") == F.col("query_id"), "left")
        first = first.union(met(candidates.filter(F.col("shard") != shard_of), rest))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_ball_tree_top_k(spark, sf_dir: str) -> DataFrame:
    """Operator 3 over ``embeddings``: ids divisible by 100 against all others."""
    return top_k(frames.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
