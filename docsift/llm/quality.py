"""A quality classifier learned from trusted positives and unlabelled text.

Labels only say which documents are good. A small network is trained to minimise the non-negative unbiased risk of
positive-unlabelled learning: the risk on positives, weighted by the class prior, plus the risk of calling unlabelled text
negative less the part of it that positives cause, never below zero. The prior is estimated from the two samples by best
bin estimation: above any threshold, unlabelled text holds at least the prior times the share that positives have there,
so the least ratio over thresholds of a classifier of positives against unlabelled text bounds it.

Fitting uses bounded samples of rows, ``MAX_POSITIVES`` and ``MAX_UNLABELLED``; scoring reads every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.llm.common import extended, fresh, utf8
from docsift.llm.sampling import hash_sample

MAX_POSITIVES = 10_000
MAX_UNLABELLED = 10_000
THRESHOLD = 0.3
HIDDEN = 24
EPOCHS = 40
FEATURES = 256 + 14

_CLASSES = np.zeros((256, 5), dtype=np.float32)
for _i, _members in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), range(128, 256))):
    _CLASSES[list(_members), _i] = 1


def features(texts: list[bytes]) -> np.ndarray:
    """Statistics of each text's bytes, words and lines; all zero for an empty text."""
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        shares = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256).astype(np.float32) / len(text)
        counts = Counter(words)
        lines = text.split(b"\n")
        n = len(words)
        out[i, :256] = np.log1p(1000 * shares)
        out[i, 256:261] = shares @ _CLASSES
        out[i, 261] = 1 - out[i, 256:261].sum()
        out[i, 262:] = (
            np.log(n),
            np.log(len(text) / n),
            len(counts) / n,
            np.log(len(counts)) / np.log(n + 1),
            max(counts.values()) / n,
            sum(map(eq, words, islice(words, 1, None))) / n,
            sum(c > 1 for c in counts.values()) / len(counts),
            len(set(lines)) / len(lines),
        )
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Network:
    """One hidden layer over standardised features; ``score`` is the probability of a positive."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x)).astype(np.float64)


Slopes = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _train(positive: np.ndarray, unlabelled: np.ndarray, slopes: Slopes, epochs: int, seed: int, batch: int = 512) -> Network:
    """Adam on the logits' slopes that ``slopes(logits of positives, logits of unlabelled)`` gives."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    net = Network(mean, scale, [])
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float32) for x in (positive, unlabelled))
    d = p.shape[1]
    net.weights = [w.astype(np.float32) for w in (rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1))]
    first, second, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    steps = max(1, max(len(p), len(u)) // batch)
    for _ in range(epochs):
        ps, us = np.array_split(rng.permutation(len(p)), min(steps, len(p))), np.array_split(rng.permutation(len(u)), min(steps, len(u)))
        for i in range(steps):
            x = np.concatenate([p[ps[i % len(ps)]], u[us[i % len(us)]]])
            n = len(ps[i % len(ps)])
            w1, b1, w2, b2 = net.weights
            hidden = np.tanh(x @ w1 + b1)
            z = hidden @ w2 + b2[0]
            dz = np.concatenate(slopes(z[:n], z[n:])).astype(np.float32)
            dh = np.outer(dz, w2) * (1 - hidden**2)
            grads = [x.T @ dh + 1e-4 * w1, dh.sum(axis=0), hidden.T @ dz, dz.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(net.weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _positives_against_unlabelled(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)


def non_negative_risk(prior: float) -> Slopes:
    """Slopes of the non-negative risk with the logistic loss.

    Where the unlabelled risk falls below what positives explain, the step goes against it instead.
    """

    def slopes(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = _sigmoid(zp), _sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= 0:
            return (prior * (sp - 1) - prior * sp) / len(zp), su / len(zu)
        return prior * sp / len(zp), -su / len(zu)

    return slopes


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 5) -> float:
    """Best bin estimation on a half of each sample that the classifier was not trained on."""
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    if min(half_p, half_u) < 1:
        return 0.5
    net = _train(positive[:half_p], unlabelled[:half_u], _positives_against_unlabelled, max(4, EPOCHS // 4), seed)
    sp, su = np.sort(net.logit(positive[half_p:])), np.sort(net.logit(unlabelled[half_u:]))
    above_p = 1 - np.arange(len(sp)) / len(sp)
    above_u = 1 - np.searchsorted(su, sp, side="left") / len(su)
    slack = np.sqrt(np.log(4 / 0.1) / 2)
    bound = (above_u + slack / np.sqrt(len(su)) + slack / np.sqrt(len(sp))) / above_p
    best = int(np.argmin(bound))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 3) -> Network | None:
    """The network for the two samples of features; none if either is empty."""
    if not len(positive) or not len(unlabelled):
        return None
    return _train(positive, unlabelled, non_negative_risk(estimate_prior(positive, unlabelled)), EPOCHS, seed)


def sampled_features(docs: DataFrame, text_col: str) -> np.ndarray:
    """The features of a bounded sample of documents, at the driver, in the order of a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(utf8(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], names=["x"])

    rows = docs.select(text_col).mapInArrow(run, "x binary").toArrow().column("x").to_pylist()
    return np.array([np.frombuffer(x, dtype=np.float32) for x in sorted(rows)], dtype=np.float32).reshape(-1, FEATURES)


def learn(docs: DataFrame, positives: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """Fit on ``positives``, a table of ids, and on unlabelled documents; of both only where ``usable`` holds for the id."""
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    key = F.col("_id")
    trusted = hash_sample(positives.select(F.col(positives.columns[0]).cast("long").alias("_id")).where(usable).distinct(), key, MAX_POSITIVES, "positive")
    # At most MAX_POSITIVES and a tenth ids.
    positive = sampled_features(rows.join(F.broadcast(trusted), "_id", "left_semi"), "_text")
    unlabelled = sampled_features(hash_sample(rows.where(usable), key, MAX_UNLABELLED, "unlabelled"), "_text")
    rng = np.random.default_rng(11)
    return fit(positive[rng.permutation(len(positive))], unlabelled[rng.permutation(len(unlabelled))])


def with_scores(docs: DataFrame, model: Network | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents with all their columns and their scores; without a model every score is one half."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(at))
            scores = np.full(len(texts), 0.5) if model is None else model.score(features(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, extended(docs.schema, **{name: T.DoubleType()}))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``held_out`` is a condition on a column ``_id``; what it holds for is not learned from. Only labels of 1 are read. A
    null text counts as empty; empty texts all have one score. Null ids are not held out and match no label. Repeated
    rows are scored each; repeated labels count once. Without usable positives, or in an empty table, scores are one
    half. Other columns are ignored.
    """
    positives = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_id"))
    model = learn(docs, positives, ~held_out, id_col, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"))
    return with_scores(rows, model, "_text").select(
        F.col("_id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    positives = labels.where(F.col("quality") == 1).select(F.col(id_col).alias("_id"))
    model = learn(docs, positives, ~held_out, id_col, text_col)
    (name,) = fresh(docs, "_score")
    return with_scores(docs, model, text_col, name).where(F.col(name) >= threshold).select(*docs.columns)
