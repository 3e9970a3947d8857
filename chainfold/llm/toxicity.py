"""Toxicity by a chain of linear models: each category's model sees the probabilities of the categories before it."""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.common import arrow_pass, query, table, text_bytes

CATEGORIES = ("low_quality", "toxic")
MAX_ROWS = 12_000       # labelled rows used for fitting, chosen by a hash of the id
FEATURES = 1_500        # words that the models look at
LEAST = 5               # labelled texts that hold such a word
FOLDS = 5
PENALTY = 1.0
STEPS = 60
THRESHOLD = 0.5

_PUNCTUATION = bytes.maketrans(b".,;:!?\"'()[]{}<>", b" " * 16)


def words(text: bytes) -> set[bytes]:
    return set(text.lower().translate(_PUNCTUATION).split())


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Rows:
    """A matrix of zeros and ones with some dense columns; row i has ones at index[start[i]:start[i + 1]]."""

    def __init__(self, ones: list[np.ndarray], width: int, dense: np.ndarray):
        self.row = np.repeat(np.arange(len(ones)), [len(o) for o in ones])
        self.index = np.concatenate(ones).astype(np.int64) if ones else np.empty(0, np.int64)
        self.n, self.width, self.dense = len(ones), width, dense

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], self.n) + self.dense @ w[self.width:]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(self.index, r[self.row], self.width), self.dense.T @ r]


def fit_logistic(x: Rows, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """L2-penalised logistic regression by limited-memory quasi-Newton steps; the last dense column is the free constant."""
    size = x.width + x.dense.shape[1]
    penalty = np.full(size, PENALTY)
    penalty[-1] = 0.0

    def loss(w):
        z = x.times(w)
        p = sigmoid(z)
        value = (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * w * w).sum()
        return value, x.back(weight * (p - y)) + penalty * w
    w = np.zeros(size)
    value, slope = loss(w)
    memory: list[tuple] = []
    for _ in range(STEPS):
        way, alphas = -slope, []
        for s, g, rho in reversed(memory):
            alphas.append(rho * (s @ way))
            way = way - alphas[-1] * g
        if memory:
            s, g, _ = memory[-1]
            way = way * (s @ g) / (g @ g)
        else:
            way = way / max(1.0, np.abs(slope).max())
        for (s, g, rho), a in zip(memory, reversed(alphas), strict=True):
            way = way + (a - rho * (g @ way)) * s
        step, drop = 1.0, slope @ way
        while step > 1e-6:
            nxt, new = loss(w + step * way)
            if nxt <= value + 1e-4 * step * drop:
                break
            step /= 2
        else:
            break
        s, g = step * way, new - slope
        if s @ g > 1e-12:
            memory = [*memory[-7:], (s, g, 1.0 / (s @ g))]
        done = value - nxt < 1e-7 * max(1.0, abs(value))
        w, value, slope = w + s, nxt, new
        if done:
            break
    return w


@dataclasses.dataclass
class Chain:
    """Per category: the weights of the words, then of the earlier probabilities, then the constant.

    A chain that no labelled row trained is not ``trained``: its probabilities of one half say nothing, so it rejects nothing.
    """
    categories: tuple[str, ...]
    index: dict[bytes, int]
    weights: list[np.ndarray]
    trained: bool = True

    def predict(self, text: bytes) -> list[float]:
        ones = [self.index[w] for w in words(text) & self.index.keys()]
        out: list[float] = []
        for w in self.weights:
            z = w[ones].sum() + w[len(self.index):-1] @ np.array(out) + w[-1]
            out.append(float(sigmoid(z)))
        return out


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, id: str = "doc_id",
        text: str = "text", max_rows: int = MAX_ROWS, features: int = FEATURES) -> Chain:
    """Fit the chain on at most ``max_rows`` labelled documents, chosen by a hash of the id whatever the corpus.

    ``labels`` holds id and one 0/1 column per category; of repeated ids the highest value counts, and a row with a null id
    or category is left out. Each category gets out-of-fold probabilities for the training rows, which the later models are
    trained on; a full fit serves new texts. Without labelled rows (no labels, null ones only, or ids that do not
    meet) every probability is one half, and the chain is marked as not trained: ``score`` and ``keep_harmless`` reject nothing.
    """
    known = labels.groupBy(F.col(id).alias("id")).agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories]).dropna()
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    rows = docs.select(F.col(id).alias("doc"), text_bytes(text).alias("text")).join(F.broadcast(known), F.col("doc") == F.col("id")).select(
        "id", "text", *categories).persist()

    def seen(batch: pa.RecordBatch) -> dict:
        by: dict[bytes, np.ndarray] = {}
        labels_ = np.array([[1, *v] for v in zip(*(batch.column(2 + i).to_pylist() for i in range(len(categories))), strict=True)])
        for t, v in zip(batch.column(1).to_pylist(), labels_, strict=True):
            for w in words(t):
                by[w] = by[w] + v if w in by else v
        return {"word": list(by), **{f"n{i}": [int(v[i]) for v in by.values()] for i in range(1 + len(categories))}}
    counts = [f"n{i}" for i in range(1 + len(categories))]
    word_counts = arrow_pass(rows, "word binary, " + ", ".join(f"{c} bigint" for c in counts), seen).groupBy("word").agg(
        *[F.sum(c).alias(c) for c in counts])
    total = rows.agg(F.count("*"), *[F.sum(c) for c in categories]).first()
    index: dict[bytes, int] = {}
    if total[0]:
        n, found = float(total[0]), F.col("n0").cast("double")
        scores = []
        for i in range(len(categories)):
            have = float(total[1 + i] or 0)
            off = F.col(f"n{i + 1}") - found * have / n      # a chi-squared statistic of word against category
            scores.append(F.when(F.lit(0.0 < have < n) & (found < n), off * off * n / (found * (1 - found / n) * max(1e-9, have * (1 - have / n)))).otherwise(0.0))
        best = word_counts.where(F.col("n0") >= LEAST).select("word", F.greatest(*scores, F.lit(0.0)).alias("score")).orderBy(
            F.col("score").desc(), "word").limit(features).collect()
        index = {bytes(r.word): i for i, r in enumerate(sorted(best, key=lambda r: bytes(r.word)))}

    def indexed(batch: pa.RecordBatch) -> dict:
        ones = [sorted(index[w] for w in words(t) & index.keys()) for t in batch.column(1).to_pylist()]
        return {"id": batch.column(0).cast("string").to_pylist(), "ones": ones, "y": list(map(list, zip(
            *(batch.column(2 + i).to_pylist() for i in range(len(categories))), strict=True)))}
    sample = arrow_pass(rows, "id string, ones array<int>, y array<int>", indexed).toPandas().sort_values("id", kind="stable")
    rows.unpersist()
    if sample.empty:
        return Chain(categories, {}, [np.zeros(i + 1) for i in range(len(categories))], trained=False)
    ones, y = [np.asarray(o) for o in sample["ones"]], np.stack(sample["y"].to_numpy())
    fold = np.arange(len(ones)) % FOLDS
    earlier, weights = np.empty((len(ones), 0)), []
    for c in range(len(categories)):
        x = Rows(ones, len(index), np.c_[earlier, np.ones(len(ones))])
        weights.append(fit_logistic(x, y[:, c], np.ones(len(ones))))
        if c + 1 < len(categories):
            out = np.zeros(len(ones))
            for f in range(FOLDS):
                out[fold == f] = sigmoid(x.times(fit_logistic(x, y[:, c], (fold != f).astype(float))))[fold == f]
            earlier = np.c_[earlier, out]
    return Chain(categories, index, weights)


def score(docs: DataFrame, chain: Chain, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability p_<category> for each category, and toxic (the last category reaches ``threshold``; false for all if the chain
    is not trained).

    One row per document from its whole text; null counts as empty, repeated rows stay repeated, an empty table gives no
    row, other columns are not looked at.
    """
    return docs.select(F.col(id).alias("doc_id"), probabilities(docs, chain, text).alias("p")).select(
        "doc_id", *[F.get("p", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(chain.categories)],
        (F.lit(chain.trained) & (F.get("p", F.lit(len(chain.categories) - 1)) >= threshold)).alias("toxic"))


def probabilities(docs: DataFrame, chain: Chain, text: str):
    held = docs.sparkSession.sparkContext.broadcast(chain)

    def predict(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.predict(t) for t in texts], dtype=object)
    return F.pandas_udf(predict, "array<double>")(text_bytes(text))


def given_labels(spark, d) -> DataFrame:
    return table(spark, d, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


@query("op10_toxicity_chain")
def op10_toxicity_chain(spark, d):
    docs = table(spark, d, "documents")
    return score(docs, fit(docs, given_labels(spark, d)))


def keep_harmless(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic, all columns kept; no shuffle. A chain that is not trained keeps all of them."""
    if not chain.trained:
        return docs
    last = F.get(probabilities(docs, chain, text), F.lit(len(chain.categories) - 1))
    return docs.withColumn("__p", last).where(F.col("__p") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
