"""Operator 8: language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of three letters in a
row binds (multiplies) the first letter's vector permuted twice, the second's
permuted once and the third's; a text's vector bundles (adds) those of all its
letter triples, runs of other characters counting as one blank. A language's
prototype bundles the unit vectors of its learned texts; the prediction is the
prototype of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

DIMS = 512
MOST_LEARNED = 4_000  # texts learned from for each language, about; the rest of its texts are not needed
MOST_LANGUAGES = 10_000  # prototypes that the driver holds; more distinct languages are an error
MOST_TRIPLES = 30_000  # triple vectors remembered
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


class Space:
    """Vectors of letters and triples, the same everywhere; triples are remembered, bounded."""

    def __init__(self):
        self.letter: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.codes, self.table = np.empty(0, np.uint64), np.empty((0, DIMS), np.float32)

    def of_letter(self, c: int) -> np.ndarray:
        if c not in self.letter:
            bits = np.random.default_rng([c, 20111]).integers(0, 2, DIMS, dtype=np.int8)
            self.letter[c] = (bits * 2 - 1).astype(np.float32)
        return self.letter[c]

    def of_triple(self, code: int) -> np.ndarray:
        a, b, c = code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF
        return np.roll(self.of_letter(a), 2) * np.roll(self.of_letter(b), 1) * self.of_letter(c)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Table rows of sorted distinct codes, learning those not there yet."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            if len(self.codes) + int((~known).sum()) > MOST_TRIPLES:
                self.forget()
                known[:] = False
            new = codes[~known]
            every = np.concatenate([self.codes, new])
            order = np.argsort(every)
            made = np.stack([self.of_triple(int(c)) for c in new])
            self.codes, self.table = every[order], np.concatenate([self.table, made])[order]
            at = np.searchsorted(self.codes, codes)
        return self.table[at]

    def __call__(self, text: str) -> np.ndarray | None:
        """The text's unit vector, None without a letter."""
        raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        x = np.where(_letters()[raw], raw, 0).astype(np.uint64)
        if not x.any():
            return None
        x = np.concatenate([[0], x, [0]]).astype(np.uint64)
        x = x[np.append(True, (x[1:] != 0) | (x[:-1] != 0))]
        codes, n = np.unique((x[:-2] << np.uint64(42)) | (x[1:-1] << np.uint64(21)) | x[2:], return_counts=True)
        total = np.zeros(DIMS, np.float32)
        for at in range(0, len(codes), 8192):
            total += n[at : at + 8192].astype(np.float32) @ self.rows(codes[at : at + 8192])
        return total / max(float(np.linalg.norm(total)), 1e-12)


_SPACE: list[Space] = []


def space() -> Space:
    if not _SPACE:
        _SPACE.append(Space())
    return _SPACE[0]


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def learn_prototypes(df: DataFrame, most: int = MOST_LEARNED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """A unit prototype for each language, from rows that are not held out.

    Of a language with more than ``most`` texts those are learned whose id's
    hash is below the matching bound, so about ``most``. Rows with a null
    language, id or text are left out. The prototypes are one vector a language;
    over MOST_LANGUAGES distinct languages raise a ValueError.
    """
    prepare(df.sparkSession)
    usable = df.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and _id is not null").filter(~held_out(F.col("_id")))
    rates = usable.groupBy("lang").count().select("lang", (F.lit(most) / F.col("count")).alias("rate"))
    chosen = usable.join(F.broadcast(rates), "lang").filter((F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))) < F.col("rate"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in rows:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = space()(text) if text else None
                if v is not None:
                    # fixed-point sums do not depend on the order of rows
                    sums[lang] = sums.get(lang, 0) + np.rint(v * 1e6).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = chosen.select("lang", "text").mapInArrow(run, "lang string, v array<long>")
    got = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} distinct values of {lang_col}")
    out = {}
    for r in sorted(got, key=lambda r: r["lang"]):
        v = np.array([x["x"] for x in r["v"]], float)
        out[r["lang"]] = (v / max(np.linalg.norm(v), 1e-12)).astype(np.float32)
    return out


def predict_languages(df: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (largest cosine, 0 to 1) for every row; whole texts.

    ``und`` with score 0 for a null text, one without a letter, or without
    prototypes. Equal cosines take the first language by name. Repeated and
    null ids, empty tables and other columns are no matter.
    """
    prepare(df.sparkSession)
    names, matrix = list(prototypes), np.stack([*prototypes.values()]) if prototypes else np.empty((0, DIMS), np.float32)
    shared = df.sparkSession.sparkContext.broadcast((names, matrix))  # a vector a language

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for batch in rows:
            pred, score = [], []
            for text in batch.column(2).to_pylist():
                v = space()(text) if text and names else None
                if v is None:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                else:
                    cos = matrix @ v
                    k = int(cos.argmax())
                    pred.append(names[k])
                    score.append(float(min(1.0, max(0.0, round(float(cos[k]), 6)))))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return df.select(df[id_col].cast("long"), held_out(df[id_col]).alias("held_out"), df[text_col]).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
