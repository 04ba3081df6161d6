"""Toxicity categories by a classifier chain of linear models (operator 10).

The models read which words of a small vocabulary a document holds, and which beginnings of words, so that inflected forms
of a stem count together. Categories are predicted one after the other: the
model of a category sees the vocabulary and the probabilities of all categories before it. In training these are
out-of-fold predictions, made by models that did not see the document, so a later model does not learn to trust an
earlier one more than it deserves. Copies of a text are used once and so are in one fold.

Fitting reads at most ``max_rows`` labelled documents, those with the smallest hashes of their ids; what reaches the driver
is the vocabulary (at most ``words_per_category`` for each category) and, per sampled document, which of these words it
holds. Scoring reads every word of every document, in the scan, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames, words

MAX_ROWS, WORDS_PER_CATEGORY, FOLDS, RIDGE = 8000, 200, 5, 0.1
#: Least share of a category's documents that a word of the vocabulary occurs in.
LEAST_SHARE = 0.015
#: Least surplus of its documents in the category over the number expected, in standard deviations.
LEAST_SCORE = 4.0
THRESHOLD = 0.5
#: Bytes of the beginnings of words.
STEMS = (4, 5, 6, 7, 8)

#: Letters: of ASCII those, and all bytes of other characters. Digits and signs separate words.
_LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.fill_null(""))


def _held(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of each word of each text and of its beginnings."""
    found = words.scan(_lower(texts), _LETTERS)
    owner = np.repeat(np.arange(len(texts)), found.counts())
    parts = found.stems(STEMS)
    return np.concatenate([owner[at] for at, _ in parts]), np.concatenate([h for _, h in parts])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept, which carries no penalty.

    Newton steps, halved until the loss falls: with words that settle a category alone a full step may overshoot.
    """
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (penalty * w * w).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9), slope)
        part = 1.0
        while part > 1e-6 and loss(w - part * step) > now - 1e-4 * part * float(slope @ step):
            part /= 2
        if part <= 1e-6:
            break
        w = w - part * step
        last, now = now, loss(w)
        if last - now < 1e-9 * (1 + abs(now)):
            break
    return w


def predict_linear(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    """``vocabulary``: sorted word hashes; ``weights``: for each category, of the words, the earlier probabilities and the intercept."""

    categories: list[str]
    vocabulary: np.ndarray
    weights: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.column_stack([out, predict_linear(w, np.column_stack([x, out]))])
        return out


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, categories: Sequence[str], vocabulary: np.ndarray) -> Chain:
    """A model per category in turn, the later ones on out-of-fold probabilities of the earlier ones."""
    earlier, weights = np.zeros((len(x), 0)), []
    for k in range(len(categories)):
        seen = np.column_stack([x, earlier])
        unseen = np.zeros(len(x))
        for f in np.unique(fold):
            unseen[fold == f] = predict_linear(fit_linear(seen[fold != f], y[fold != f, k]), seen[fold == f])
        weights.append(fit_linear(seen, y[:, k]))
        earlier = np.column_stack([earlier, unseen])
    return Chain(list(categories), vocabulary, weights)


def _sampled(docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc_id: str, text: str, max_rows: int) -> DataFrame:
    """``at``, ``fold``, ``y`` and the distinct ``words`` of the sampled documents, one for each text."""
    labels = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), *[F.col(f"`{c}`").cast("int").alias(f"y{k}") for k, c in enumerate(categories)]).dropna()
    one = labels.groupBy("doc_id").agg(F.array(*[F.max(f"y{k}") for k in range(len(categories))]).alias("y"))
    ids = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, hashes = _held(b.column("text"))
            order = np.argsort(owner, kind="stable")
            parts = np.split(hashes[order], np.searchsorted(owner[order], np.arange(1, b.num_rows)))
            own = [np.unique(part).view(np.int64) for part in parts]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("y"), pa.array(own, pa.list_(pa.int64()))], ["at", "y", "words"])

    chosen = texts.join(ids, "doc_id").select(F.xxhash64("text").alias("at"), "text", "y").groupBy("at").agg(F.min(F.struct("text", "y")).alias("x")).select("at", "x.text", "x.y")
    return chosen.mapInArrow(frames.per_task(listed), "at long, y array<int>, words array<long>")


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS, words_per_category: int = WORDS_PER_CATEGORY, folds: int = FOLDS) -> Chain:
    """The chain for ``categories``, columns of 0 and 1 in ``labels``, on at most ``max_rows`` labelled documents.

    Rows with a null label or text are left out; a document labelled twice has the higher labels. Without any labelled
    document, or without one of a category, the probability of that category is 0 or next to it everywhere.
    """
    frames.ready(docs.sparkSession)
    sample = frames.written(_sampled(docs, labels, categories, doc_id, text, max_rows))
    n = len(categories)
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(F.col("y")[k]).alias(f"p{k}") for k in range(n)]).first()
    positive = [totals[f"p{k}"] or 0 for k in range(n)]
    counts = sample.select(F.explode("words").alias("word"), "y").groupBy("word").agg(F.count("*").alias("held"), *[F.sum(F.col("y")[k]).alias(f"h{k}") for k in range(n)])
    picked: set[int] = set()
    for k in range(n):
        expected = F.col("held") * (positive[k] / max(1, totals["n"]))
        score = (F.col(f"h{k}") - expected) / F.sqrt(expected)
        best = counts.filter((F.col(f"h{k}") >= max(3, LEAST_SHARE * positive[k])) & (score > LEAST_SCORE)).select("word", score.alias("score"))
        picked |= {r["word"] for r in best.orderBy(F.desc("score"), "word").limit(words_per_category).collect()}
    vocabulary = np.sort(np.array(sorted(picked), np.int64).view(np.uint64))
    listed = [int(v) for v in vocabulary.view(np.int64)]
    hits = F.array_intersect("words", F.array(*[F.lit(v) for v in listed])) if listed else F.expr("array()").cast("array<bigint>")
    rows = sample.select("at", "y", hits.alias("hits")).collect()
    rows.sort(key=lambda r: r["at"])
    x = np.zeros((len(rows), len(vocabulary)))
    for i, r in enumerate(rows):
        x[i, np.searchsorted(vocabulary, np.array(r["hits"], np.int64).view(np.uint64))] = 1
    y = np.array([r["y"] for r in rows], float).reshape(-1, n)
    fold = np.array([r["at"] % folds for r in rows])
    if not len(rows):
        return Chain(list(categories), vocabulary, [np.concatenate([np.zeros(k), [-30.0]]) for k in range(n)])
    return fit_chain(x, y, fold, categories, vocabulary)


def scored(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (of it the columns ``carry``, if given) with ``p_<category>`` for each category and ``toxic``: one reaches ``threshold``.

    Null and empty texts hold no word and get the base probabilities. Columns of these names in ``docs`` are replaced.
    """
    frames.ready(docs.sparkSession)
    columns = list(docs.columns if carry is None else carry)
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    names = [f"p_{c}" for c in chain.categories]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(chain.vocabulary)
        for b in batches:
            for low, high in words.slices(b.column("text")):
                part = b.slice(low, high - low)
                x = np.zeros((part.num_rows, size))
                if size:
                    owner, hashes = _held(part.column("text"))
                    at = np.minimum(np.searchsorted(chain.vocabulary, hashes), size - 1)
                    hit = chain.vocabulary[at] == hashes
                    x[owner[hit], at[hit]] = 1
                p = chain.predict(x).round(6)
                yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(p[:, k]) for k in range(len(names))], pa.array((p >= threshold).any(axis=1))], ["row", *names, "toxic"])

    schema = T.StructType([dealt.schema["row"], *[T.StructField(c, T.DoubleType()) for c in names], T.StructField("toxic", T.BooleanType())])
    return frames.unpacked(dealt.mapInArrow(frames.per_task(each), schema), columns, *names, "toxic")


CATEGORIES = ("toxic", "toxic_low_quality")


def with_categories(labels: DataFrame) -> DataFrame:
    """``labels`` with the chain's categories: toxic, and toxic in a document of low quality."""
    toxic = F.col("toxic").cast("int")
    return labels.select("doc_id", toxic.alias("toxic"), (toxic * (1 - F.col("quality").cast("int"))).alias("toxic_low_quality"))


def op10_toxicity_chain(spark, sf_dir: str) -> DataFrame:
    """Operator 10 over ``documents``, fitted on a bounded sample of ``labels``."""
    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit(docs, with_categories(frames.table(spark, sf_dir, "labels")), CATEGORIES)
    return scored(docs, chain, carry=["doc_id"])
