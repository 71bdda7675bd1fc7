"""Operator 9: quality rules and a calibrated n-gram classifier.

Base rules count words, symbols and repetition. Texts that pass are judged by a
logistic regression over hashed n-grams (words, word pairs, characters in
threes), each n-gram weighing its share of the text, trained on labelled rows
and calibrated on a part of them that the fit does not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from .common import prepare
from .models import Sparse, adam, fit, labelled_sample, platt, sigmoid

SIZE = 1 << 18
MOST_LABELLED = 6_000  # labelled rows used for fit and calibration
STEPS, RATE, RIDGE = 150, 0.5, 1e-7
KEEP = 0.4  # a text is kept from this calibrated probability of good quality
LEAST_WORDS, MOST_REPEATED = 50, 50

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _fold(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * _P1 >> np.uint64(46)).astype(np.int32)  # 18 bits


def word_hashes(data: bytes) -> np.ndarray:
    w = data.split()
    return np.fromiter(map(xxh64_intdigest, w, repeat(7)), np.uint64, len(w))


def base_rules(text: str, h: np.ndarray) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed); h: the words' hashes."""
    n = len(h)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = 0
    if n >= 3:
        w = h[:-2] * _P1 + h[1:-1] * _P2 + h[2:] * _P3
        _, inverse, count = np.unique(w, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        if twice.any():
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k : n - 2 + k] |= twice
            repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n


def ngrams(text: str, h: np.ndarray) -> list[np.ndarray]:
    """Feature numbers of words, word pairs and triples of characters (code points), in three lists."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    triples = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:] if len(c) > 2 else np.empty(0, np.uint64)
    return [_fold(h), _fold(h[:-1] * _P2 + h[1:] * _P3) if len(h) > 1 else np.empty(0, np.int32), _fold(triples * _P3 + _P2)]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    at, share = [], []
    for x in ngrams(data.decode("utf-8", "replace"), word_hashes(data)):
        k, n = np.unique(x, return_counts=True)
        at.append(k)
        share.append((n / max(1, len(x))).astype(np.float32))
    return np.concatenate(at).astype(np.int32), np.concatenate(share)


def train(y: np.ndarray, x: Sparse) -> dict:
    """Weights, bias and calibration; without both classes a model that keeps all."""
    if min((y == 1).sum(), (y == 0).sum()) < 4:
        return {"w": np.zeros(SIZE, np.float32), "b": 0.0, "platt": (0.0, 20.0)}
    aside = np.arange(len(y)) % 4 == 3
    own, target = x.rows(~aside), y[~aside].astype(float)
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))

    def grad(p):
        r = weight * (sigmoid(own.dot(p[:SIZE]) + p[SIZE]) - target) / len(target)
        return np.concatenate([own.back(r, SIZE) + RIDGE * p[:SIZE], [r.sum()]])

    p = adam(grad, np.zeros(SIZE + 1), STEPS, RATE)
    score = x.rows(aside).dot(p[:SIZE]) + p[SIZE]
    return {"w": p[:SIZE].astype(np.float32), "b": float(p[SIZE]), "platt": platt(score, y[aside])}


def probability(text: str, h: np.ndarray, model: dict) -> float:
    """The calibrated probability of good quality."""
    w = model["w"]
    score = model["b"] + sum(float(w[x].mean(dtype=np.float64)) for x in ngrams(text, h) if len(x))
    a, b = model["platt"]
    return float(sigmoid(a * score + b))


def fit_quality(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> dict:
    """The model, from at most ``most`` labelled rows (label column ``quality``, 0 or 1)."""
    prepare(documents.sparkSession)
    return fit(labelled_sample(documents, labels, "quality", most), features, train)


def judge(text: str | None, model: dict) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability or None, kept)"""
    text = text or ""
    data = text.encode("utf-8", "replace")
    h = word_hashes(data)
    base = base_rules(text, h)
    if base[-1]:
        return *base, None, False
    p = probability(text, h, model)
    return *base, p, p >= KEEP


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "p_good", "kept"]


def quality_scores(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, base_failed, p_good (null if failed) and kept for every row; whole texts.

    A null text has no words and fails. Repeated and null ids, empty tables and
    other columns are no matter.
    """
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # 1 MB
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            got = [judge(t, shared.value) for t in batch.column(1).to_pylist()]
            columns = [pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], names=_NAMES)

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean")


def keep_good(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of df that are kept, all columns as they are."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.filter(pa.array([judge(t, shared.value)[-1] for t in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
