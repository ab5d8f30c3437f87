"""Toxicity by classifier chains.

Categories are predicted in a fixed order; the linear model of a category sees the
text's features and the probabilities of the categories before it.  For training these
come out of fold: the rows are split into folds, and a row's earlier probability is that
of a model fitted without its fold, so that later models learn from predictions as
uncertain as those they meet when the chain is applied.

Features of a text: its distinct lower-case words and, of longer words, the stem of
``STEM`` letters.  A model keeps the ``KEEP`` features that tell its category apart best
(chi-square on its training rows) and fits their weights by regularised logistic
regression.  The chain is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of
their id, and scores every row of the input, whole texts.

Defined results: null text is empty; a text without known features gets the chain's
intercept; without labelled rows every probability is 0; a category of which the sample
holds one value only gets 0.999 or 0.001; a category's model learns from the rows that hold
its label, also if those of other categories are null; of repeated labels of one id the
largest of each category counts; repeated rows are scored alike.  A row is toxic from a probability of
``TOXIC`` on: held-out clean rows stay below a fifth of it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, unused

MISSING = -2**31      # a row's label of a category that it does not hold
SAMPLE = 12_000       # labelled rows the chain is fitted on, at most
FOLDS = 3
KEEP = 3_000
STEM = 5
TOXIC = 0.1
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[int]:
    """Checksums of the distinct words and stems of a text."""
    words = set(_WORD.findall(text.lower()))
    stems = {"^" + w[:STEM] for w in words if len(w) > STEM}
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words | stems}


class Linear:
    """A logistic model over selected checksums and the logits of earlier categories."""

    def __init__(self, weights: dict[int, float], earlier: np.ndarray, bias: float):
        self.weights, self.earlier, self.bias = weights, earlier, bias

    def logit(self, found: set[int], before: list[float]) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in found) + float(np.dot(self.earlier, before) if before else 0.0)


def _select(ptr: np.ndarray, idx: np.ndarray, y: np.ndarray, rows: np.ndarray, n_features: int) -> np.ndarray:
    """Features with the largest chi-square on ``rows``."""
    on = np.repeat(rows, np.diff(ptr))
    pos = np.bincount(idx[on & np.repeat(y > 0, np.diff(ptr))], minlength=n_features).astype(float)
    all_ = np.bincount(idx[on], minlength=n_features).astype(float)
    n, n1 = float(rows.sum()), float(y[rows].sum())
    expected = all_ * n1 / n
    chi = (pos - expected) ** 2 / np.maximum(expected * (1 - n1 / n) * (1 - all_ / n), 1e-9)
    chi[(all_ < 3)] = 0
    return np.sort(np.argsort(-chi, kind="stable")[:min(KEEP, int((chi > 0).sum()))])


def fit_linear(ptr: np.ndarray, idx: np.ndarray, n_features: int, earlier: np.ndarray, y: np.ndarray,
               rows: np.ndarray, l2: float = 0.1, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Logistic regression on ``rows``: (features, weights, weights of earlier logits, bias)."""
    n, n1 = int(rows.sum()), float(y[rows].sum())
    if n == 0 or n1 in (0, n):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), -30.0 if n == 0 else 7.0 if n1 else -7.0
    kept = _select(ptr, idx, y, rows, n_features)
    place = np.full(n_features, -1)
    place[kept] = np.arange(len(kept))
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    col = place[idx]
    use = (col >= 0) & rows[doc]
    doc, col = doc[use], col[use]
    target, past, k = y * 1.0, earlier * rows[:, None], len(kept)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(doc, theta[:k][col], minlength=len(y)) + past @ theta[k:-1] + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = (p - target) * rows
        grad = np.concatenate([np.bincount(col, g[doc], minlength=k) + l2 * theta[:k], past.T @ g + l2 * theta[k:-1], [g.sum()]])
        value = (np.logaddexp(0, z) - target * z)[rows].sum() + 0.5 * l2 * float(theta[:-1] @ theta[:-1])
        return float(value), grad

    start = np.zeros(k + earlier.shape[1] + 1)
    start[-1] = np.log(n1 / (n - n1))
    theta = _lbfgs(loss, start, steps)
    return kept, theta[:k], theta[k:-1], float(theta[-1])


def _lbfgs(loss, theta: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Minimum of a convex function by limited-memory BFGS with step halving."""
    value, grad = loss(theta)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, alphas = grad.copy(), []
        for s, d in reversed(past):
            a = (s @ way) / (s @ d)
            alphas.append(a)
            way -= a * d
        if past:
            s, d = past[-1]
            way *= (s @ d) / (d @ d)
        else:
            way /= max(1.0, float(np.abs(way).max()))
        for (s, d), a in zip(past, reversed(alphas)):
            way += (a - (d @ way) / (s @ d)) * s
        step, slope = 1.0, float(grad @ way)
        while True:
            new, new_grad = loss(theta - step * way)
            if new <= value - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, d = -step * way, new_grad - grad
        if s @ d > 1e-12:
            past = [*past, (s, d)][-memory:]
        done = value - new < 1e-6 * max(1.0, abs(value))
        theta, value, grad = theta + s, new, new_grad
        if done:
            break
    return theta


def fit_chain(found: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """Models of the columns of ``labels`` in order; ``found``: checksums of each row."""
    lengths = np.array([len(f) for f in found], np.int64)
    names, idx = np.unique(np.concatenate(found) if len(found) else np.zeros(0, np.int64), return_inverse=True)
    ptr = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.repeat(np.arange(len(found)), lengths)
    earlier = np.zeros((len(found), 0))
    chain = []
    for c in range(labels.shape[1]):
        y = labels[:, c]
        has = y != MISSING
        out = np.zeros(len(found))
        for f in range(FOLDS):
            rows, held = (folds != f) & has, folds == f
            kept, w, v, b = fit_linear(ptr, idx, len(names), earlier, y, rows)
            full = np.zeros(len(names))
            full[kept] = w
            z = np.bincount(doc, full[idx], minlength=len(found)) + earlier @ v + b
            out[held] = np.clip(z[held], -12, 12)
        kept, w, v, b = fit_linear(ptr, idx, len(names), earlier, y, has)
        chain.append(Linear(dict(zip(names[kept].tolist(), w.tolist())), v, b))
        earlier = np.column_stack([earlier, out])
    return chain


def apply_chain(chain: list[Linear], text: str) -> list[float]:
    """Probabilities of the categories in order."""
    found, logits = features(text), []
    for model in chain:
        logits.append(float(np.clip(model.logit(found, logits), -12, 12)))
    return [1 / (1 + float(np.exp(-z))) for z in logits]


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int = SAMPLE,
          key: str = "doc_id", text: str = "text") -> list[Linear]:
    """The chain for ``categories`` (name -> 0/1 column of ``labels``), fitted in one task on a
    bounded sample: the ``sample`` labelled rows with the smallest hash of their id."""
    known = labels.select(F.col(key).alias("doc_id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
    known = (known.filter("doc_id is not null").dropna("all", subset=[f"y{i}" for i in range(len(categories))]).groupBy("doc_id")
             .agg(*[F.coalesce(F.max(f"y{i}"), F.lit(MISSING)).alias(f"y{i}") for i in range(len(categories))]))
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    # ids alone decide which rows are in the sample; their number bounds the broadcast
    chosen = (rows.select("doc_id").join(known, "doc_id").dropDuplicates(["doc_id"])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    ys = [f"y{i}" for i in range(len(categories))]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["found"] = [np.array(sorted(features(t)), "<i8").tobytes() for t in pdf.pop("text")]
            yield pdf
    schema = ", ".join(["doc_id long", *[f"{y} int" for y in ys], "found binary"])
    sampled = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", *ys, "text").mapInPandas(extract, schema)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        import pickle
        pdf = pdf.drop_duplicates("doc_id").sort_values("doc_id")
        found = [np.frombuffer(x, "<i8") for x in pdf["found"]]
        folds = (pdf["doc_id"].to_numpy(np.int64) * 2654435761 >> 7) % FOLDS
        chain = fit_chain(found, pdf[ys].to_numpy(), folds)
        return pd.DataFrame({"model": [pickle.dumps([(m.weights, m.earlier, m.bias) for m in chain])]})

    got = sampled.groupBy(F.lit(1).alias("one")).applyInPandas(fit, "model binary").collect()
    if not got:
        return [Linear({}, np.zeros(i), -30.0) for i in range(len(categories))]
    import pickle
    return [Linear(*m) for m in pickle.loads(bytes(got[0].model))]


def with_probabilities(docs: DataFrame, chain: list[Linear], names: list[str], out: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``out`` of the categories' probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)     # at most KEEP weights a category

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(np.array([apply_chain(shared.value, t) for t in texts]).reshape(len(texts), len(names)),
                               columns=names)
    return docs.withColumn(out, run(text_or_empty(text)))


def label_categories() -> dict[str, Column]:
    """The chain's categories over the columns of ``labels``: low quality first, then toxicity."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def classify(docs: DataFrame, labels: DataFrame, threshold: float = TOXIC) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, toxic) for every row of ``docs``."""
    categories = label_categories()
    chain = train(docs, labels, categories)
    return (with_probabilities(docs.select("doc_id", "text"), chain, list(categories), "p")
            .select("doc_id", *[F.col(f"p.{n}").alias(f"p_{n}") for n in categories], (F.col("p.toxic") >= threshold).alias("toxic")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = TOXIC) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns."""
    categories = label_categories()
    held = unused(docs, "toxicity")
    return (with_probabilities(docs, train(docs, labels, categories), list(categories), held)
            .filter(F.col(f"{held}.toxic") < threshold).drop(held))
