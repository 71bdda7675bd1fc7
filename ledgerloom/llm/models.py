"""What the trained operators share: bounded labelled samples, fits in one task, sparse features."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import texts


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(y, text) of at most ``most`` labelled rows, those whose ids have the least digests.

    ``most`` bounds what is sent to all executors and fitted in one task: of an
    id with several texts the one of the least digest is taken. Where equal ids or
    texts carry different labels their mean decides, a half counts as 1. Rows with
    a null id, label or text are left out; equal texts count once.
    """
    decided = F.floor(F.avg("y") + F.lit(0.5)).cast("int").alias("y")
    least = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y")).dropna().groupBy("_id").agg(decided)
    least = least.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(most)
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).filter("text is not null").join(F.broadcast(least), "_id")
    rows = rows.groupBy("_id").agg(F.min(F.struct(F.md5("text"), "text")).alias("t"), F.first("y").alias("y"))
    return rows.groupBy(F.col("t.text").alias("text")).agg(decided).select("y", "text")


def fit(sample: DataFrame, extract: Callable, train: Callable):
    """train(ys, features) in a single task over the bounded sample; gives what train returns.

    extract(text bytes) -> (indices int32, values float32) runs in parallel.
    """

    def features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            got = [extract(t or b"") for t in texts(batch.column(1))]
            arrays = [batch.column(0), pa.array([g[0].tobytes() for g in got], pa.binary()), pa.array([g[1].tobytes() for g in got], pa.binary()), pa.array([xxh64_intdigest(t or b"") >> 1 for t in texts(batch.column(1))], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["y", "at", "value", "h"])

    def one(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ys, at, values, h = [], [], [], []
        for b in rows:
            ys += b.column(0).to_pylist()
            at += [np.frombuffer(x, np.int32) for x in b.column(1).to_pylist()]
            values += [np.frombuffer(x, np.float32) for x in b.column(2).to_pylist()]
            h += b.column(3).to_pylist()
        order = np.argsort(np.array(h, np.int64), kind="stable").tolist()  # rows may arrive in any order
        rows = Sparse([at[k] for k in order], [values[k] for k in order])
        at.clear(), values.clear()
        model = train(np.array([ys[k] for k in order], np.int64), rows)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = sample.mapInArrow(features, "y int, at binary, value binary, h long").repartition(1).mapInArrow(one, "model binary").collect()
    return pickle.loads(bytes(rows[0]["model"])) if rows else train(np.empty(0, np.int64), Sparse([], []))


class Sparse:
    """Sparse rows with products in both directions, taken in blocks so that temporaries stay small."""

    BLOCK = 1 << 20

    def __init__(self, at: list[np.ndarray], values: list[np.ndarray]):
        self.ends = np.cumsum([0, *map(len, at)], dtype=np.int64)
        self.at = np.concatenate(at) if at else np.empty(0, np.int32)
        self.value = np.concatenate(values) if values else np.empty(0, np.float32)
        self._turned: tuple[Sparse, np.ndarray] | None = None

    @property
    def n(self) -> int:
        return len(self.ends) - 1

    @property
    def row(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.ends))

    def blocks(self):
        """(first row, last row, first entry, last entry) of runs of rows."""
        a = 0
        while a < self.n:
            b = max(a + 1, int(np.searchsorted(self.ends, self.ends[a] + self.BLOCK, side="right")) - 1)
            yield a, b, int(self.ends[a]), int(self.ends[b])
            a = b

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for a, b, s, e in self.blocks():
            full = np.flatnonzero(np.diff(self.ends[a : b + 1])) + a
            if len(full):
                out[full] = np.add.reduceat(self.value[s:e] * w[self.at[s:e]], self.ends[full] - s)
        return out

    def turned(self) -> tuple[Sparse, np.ndarray]:
        """(rows and columns exchanged, columns without entries left out; the columns that are left), made once."""
        if self._turned is None:
            order = np.argsort(self.at, kind="stable")
            out, columns = Sparse([], []), self.at[order]
            cuts = np.flatnonzero(np.diff(columns, prepend=-1))
            out.ends, out.at, out.value = np.append(cuts, len(columns)), self.row[order], self.value[order]
            self._turned = out, columns[cuts]
        return self._turned

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        turned, columns = self.turned()
        out[columns] = turned.dot(r)
        return out

    def rows(self, keep: np.ndarray) -> Sparse:
        out, hit = Sparse([], []), np.repeat(keep, np.diff(self.ends))
        out.ends = np.cumsum(np.concatenate(([0], np.diff(self.ends)[keep])))
        out.at, out.value = self.at[hit], self.value[hit]
        return out

    def scaled(self, by: np.ndarray) -> tuple[Sparse, np.ndarray]:
        """(the columns whose factor is not 0, times that factor and numbered anew; their old numbers)"""
        out, hit = Sparse([], []), by[self.at] != 0
        columns = np.flatnonzero(by)
        number = np.zeros(len(by), np.int32)
        number[columns] = np.arange(len(columns))
        out.ends = np.concatenate(([0], np.cumsum(hit)))[self.ends]
        out.at = number[self.at[hit]]
        out.value = (self.value[hit] * by[self.at[hit]]).astype(np.float32)
        return out, columns


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def adam(grad: Callable, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    w, m, v = start.astype(np.float64), np.zeros_like(start, np.float64), np.zeros_like(start, np.float64)
    for t in range(1, steps + 1):
        g = grad(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the calibrated probability sigmoid(a * score + b), by Newton steps on softened targets."""
    pos, neg = int(y.sum()), int(len(y) - y.sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([score, np.ones_like(score)], axis=1)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ ab)
        g = x.T @ (p - target) + 1e-3 * (ab - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        ab = ab - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(ab[0]), float(ab[1])
