"""Operator 6: toxicity grades by cumulative-link ordinal regression.

Features of a text are its distinct words (lower case, letters and digits) and
the beginnings of words of 3 to 7 bytes, hashed; a feature counts the distinct
words that have it. Features are scaled by their log-odds on the labelled sample.

Labels only tell toxic from other texts. The grade of a toxic text in training
comes from models that never saw it: the sample is halved in several ways, a
binary model is fitted to each half, and a text that all models of the other
halves find toxic is of grade 2, other toxic texts are of grade 1.

One weight vector is shared by the ordered thresholds:
``P(grade > k) = sigmoid(w.x - theta_k)``; the expected severity is the sum of
these probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import fsum
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, texts
from .models import Sparse, adam, fit, labelled_sample, sigmoid

SIZE = 1 << 18
BEGINNINGS = (3, 4, 5, 6, 7)
MOST_LABELLED = 12_000  # labelled rows used for the fit
LEAST_SEEN, LEAST_ODDS = 5, 1.0
STEPS, RATE, RIDGE = 300, 0.1, 1e-6
HALVINGS, VOTE_STEPS = 4, 100
REJECT = 0.5  # a text is toxic from this probability of a grade over 0

_FIND = re.compile(r"[^\W_]+").findall


def word_features(word: str) -> set[int]:
    b = word.encode("utf-8", "replace")
    return {crc32(b"=" + b) & (SIZE - 1), *[crc32(b"^" + b[:n]) & (SIZE - 1) for n in BEGINNINGS if len(b) > n]}


def distinct_words(text: bytes) -> set[str]:
    return set(_FIND(text.decode("utf-8", "replace").lower()))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(np.array([f for w in distinct_words(text) for f in word_features(w)], np.int64), return_counts=True)
    return at.astype(np.int32), n.astype(np.float32)


def log_odds(y: np.ndarray, x: Sparse) -> np.ndarray:
    """Smoothed log-odds of each feature between toxic and other texts; 0 where it is rare or no sign of toxicity, so that much other text hides nothing."""
    both = np.bincount(x.at, minlength=SIZE).astype(float)
    toxic = np.bincount(x.at[np.repeat(y == 1, np.diff(x.ends))], minlength=SIZE).astype(float)
    clean = both - toxic
    pos, neg = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    r = np.log((toxic + 0.5) / (pos + 1)) - np.log((clean + 0.5) / (neg + 1))
    return np.where((toxic + clean >= LEAST_SEEN) & (r >= LEAST_ODDS), r, 0.0)


def votes(y: np.ndarray, x: Sparse) -> np.ndarray:
    """How many of HALVINGS models that did not see a text find it toxic."""
    found = np.zeros(len(y), np.int64)
    for k in range(HALVINGS):
        side = (np.arange(len(y)) >> k) & 1 == 1  # rows are in the order of their texts' hashes
        for half in (side, ~side):
            own, odds = y[half] == 1, log_odds(y[half], x.rows(half))
            if own.all() or not own.any():
                continue
            z, columns = x.scaled(odds)
            seen = z.rows(half)
            weight = np.where(own, 0.5 / own.mean(), 0.5 / (1 - own.mean()))

            def grad(p, z=seen, own=own, weight=weight):
                r = weight * (sigmoid(z.dot(p[:-1]) + p[-1]) - own) / len(own)
                return np.concatenate([z.back(r, len(p) - 1) + RIDGE * p[:-1], [r.sum()]])

            p = adam(grad, np.zeros(len(columns) + 1), VOTE_STEPS, RATE)
            found[~half] += z.rows(~half).dot(p[:-1]) + p[-1] > 0
    return found


def grades(y: np.ndarray, x: Sparse) -> np.ndarray:
    """0 for other texts; toxic ones 2 where all models that did not see them agree, else 1."""
    return np.where(y == 1, 1 + (votes(y, x) == HALVINGS), 0)


def likelihoods(grade: np.ndarray, score: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The probability of each row's grade under the cumulative link."""
    over = np.concatenate([np.ones((len(score), 1)), sigmoid(score[:, None] - theta), np.zeros((len(score), 1))], axis=1)
    rows = np.arange(len(score))
    return over[rows, grade] - over[rows, grade + 1]


def loss(p: np.ndarray, grade: np.ndarray, z: Sparse) -> tuple[float, np.ndarray]:
    """(mean negative log-likelihood with ridge, its gradient) at p: weights, the first threshold, the log of the gap to the second."""
    w, gap = p[:-2], np.exp(p[-1])
    theta = np.array([p[-2], p[-2] + gap])
    score = z.dot(w)
    like = np.maximum(likelihoods(grade, score, theta), 1e-12)
    s = sigmoid(score[:, None] - theta)
    d = s * (1 - s)
    # by (score - theta_k): a grade's probability grows with the threshold below it and falls with the one above
    below = [np.where(grade == k + 1, d[:, k], 0) for k in range(2)]
    above = [np.where(grade == k, d[:, k], 0) for k in range(2)]
    g = [(b - a) / like for b, a in zip(below, above, strict=True)]
    n = max(1, len(grade))
    slope = np.concatenate([-z.back(g[0] + g[1], len(w)) / n + RIDGE * w, [(g[0] + g[1]).sum() / n, g[1].sum() * gap / n]])
    return float(-np.log(like).mean() + RIDGE * (w @ w) / 2), slope


def train(y: np.ndarray, x: Sparse) -> dict:
    """Weights and ordered thresholds; without both classes a model that finds nothing toxic."""
    if not ((y == 1).any() and (y == 0).any()):
        return {"w": np.zeros(SIZE, np.float32), "theta": np.array([20.0, 21.0])}
    odds, grade = log_odds(y, x), grades(y, x)
    z, columns = x.scaled(odds)
    p = adam(lambda p: loss(p, grade, z)[1], np.concatenate([np.zeros(len(columns)), [2.0, 0.0]]), STEPS, RATE)
    w = np.zeros(SIZE, np.float32)
    w[columns] = p[:-2] * odds[columns]
    return {"w": w, "theta": np.array([p[-2], p[-2] + np.exp(p[-1])])}


class Scorer:
    """Scores of texts; a word's score is remembered, bounded."""

    MOST = 250_000
    _shared: dict[int, Scorer] = {}

    def __init__(self, model: dict):
        self.w, self.theta, self.known = model["w"].tolist(), model["theta"], {}

    @classmethod
    def of(cls, model: dict) -> Scorer:
        """The scorer of a model that a worker's tasks share; only the latest model's is kept."""
        key = crc32(model["w"].tobytes())
        if key not in cls._shared:
            cls._shared.clear()
            cls._shared[key] = cls(model)
        return cls._shared[key]

    def word(self, w: str) -> float:
        if len(self.known) >= self.MOST:
            self.known.clear()
        s = self.known[w] = fsum(self.w[f] for f in word_features(w))
        return s

    def __call__(self, text: bytes) -> tuple[float, float]:
        """(probability of a grade over 0, expected severity)"""
        known = self.known
        total = fsum([known[w] if w in known else self.word(w) for w in distinct_words(text)])  # exact in any order
        p = sigmoid(total - self.theta)
        return float(p[0]), float(p.sum())


def fit_toxicity(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> dict:
    """The model, from at most ``most`` labelled rows (label column ``toxic``, 0 or 1)."""
    prepare(documents.sparkSession)
    return fit(labelled_sample(documents, labels, "toxic", most), features, train)


def score_toxicity(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_toxic, severity (expected grade, 0 to 2), grade, toxic for every row; whole texts.

    A null text has no words, like an empty one. Repeated and null ids, empty
    tables and other columns are no matter.
    """
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # 1 MB

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer.of(shared.value)
        for batch in rows:
            got = [score(t or b"") for t in texts(batch.column(1))]
            p, s = np.array([g[0] for g in got], float), np.array([g[1] for g in got], float)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(p), pa.array(s), pa.array(np.rint(s).astype(np.int32)), pa.array(p >= REJECT)], names=["doc_id", "p_toxic", "severity", "grade", "toxic"])

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, "doc_id long, p_toxic double, severity double, grade int, toxic boolean")


def drop_toxic(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of df that are not toxic, all columns as they are."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer.of(shared.value)
        for batch in rows:
            yield batch.filter(pa.array([score(t or b"")[0] < REJECT for t in texts(batch.column(at))], pa.bool_()))

    return df.mapInArrow(run, df.schema)
