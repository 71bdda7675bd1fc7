"""Operator 2: texts as WAV media columns with spectral fingerprints.

A payload is stored losslessly as 8-bit mono PCM in a WAV container (written
and read by the :mod:`wave` module). Over the samples read back a short-time
Fourier transform is taken; the strongest bins of each frame are its peaks, and
pairs of a peak with peaks of the next frames form codes (anchor bin, target
bin, frame distance) stored as an array with the anchor's time beside each.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, texts

UNIT = 192
RATE = 8000
HOP = 96
PEAKS = 2
FAN_OUT = 2
BLOCK = 4096  # frames transformed at once; bounds memory, never changes results

_WINDOW = np.hanning(UNIT + 1)[:UNIT].astype(np.float32)


def to_payload(text: bytes | None) -> bytes:
    """UTF-8 bytes (null: none) padded by blanks up to a positive multiple of 192."""
    data = text or b""
    return data + b" " * (max(1, -(-len(data) // UNIT)) * UNIT - len(data))


def store(payload: bytes) -> bytes:
    """The payload as a WAV file: 8-bit unsigned mono samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def load(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("expected 8-bit mono samples")
        return w.readframes(w.getnframes())


def peaks(samples: np.ndarray) -> np.ndarray:
    """The PEAKS strongest bins (without the constant one) of each frame, strongest first.

    Magnitudes are rounded before ranking and ties take the lower bin, so
    results do not hang on the last bits of a transform.
    """
    frames = np.lib.stride_tricks.sliding_window_view(samples, UNIT)[::HOP]
    found = []
    for at in range(0, len(frames), BLOCK):
        block = (frames[at : at + BLOCK].astype(np.float32) - 128.0) * _WINDOW
        power = np.round(np.abs(np.fft.rfft(block, axis=1))[:, 1:], 2)
        best = []
        rows = np.arange(len(power))
        for _ in range(PEAKS):
            top = power.argmax(axis=1)
            best.append(top + 1)
            power[rows, top] = -1
        found.append(np.stack(best, axis=1))
    return np.concatenate(found).astype(np.int32)


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(times, codes) of all peak pairs, by time; a lone frame pairs its peaks with themselves at distance 0."""
    p = peaks(samples)
    times, codes = [], []
    for dist in range(1, FAN_OUT + 1) if len(p) > 1 else (0,):
        if dist >= len(p):
            break
        a, b = p[: len(p) - dist], p[dist:]
        pair = (a[:, :, None] << 16) | (b[:, None, :] << 8) | dist
        codes.append(pair.reshape(len(a), -1))
        times.append(np.repeat(np.arange(len(a), dtype=np.int32)[:, None], pair.shape[1] * pair.shape[2], axis=1))
    t, c = np.concatenate(times).ravel(), np.concatenate(codes).ravel()
    order = np.argsort(t, kind="stable")
    return t[order], c[order]


_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, feature string, peak_times array<int>, peak_codes array<int>"
_KEPT = ", media binary"


def media_columns(df: DataFrame, keep_media: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: sizes and digests of payload and media, and the fingerprint.

    All digests but ``n_bytes`` come from the stored media read back. ``feature``
    is ``<pairs>:<hash of times and codes>``; peak_times and peak_codes are the
    time-coded arrays. keep_media adds the WAV bytes. A null text counts as empty (one padded unit); equal
    texts give equal values; null and repeated ids, empty tables and other
    columns are no matter.
    """
    prepare(df.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out: list[list] = [[] for _ in range(10 + keep_media)]
            for text in texts(batch.column(1)):
                media = store(to_payload(text))
                payload = load(media)
                t, c = fingerprint(np.frombuffer(payload, dtype=np.uint8))
                digest = hashlib.blake2b(struct.pack("<q", len(t)) + t.astype("<i4").tobytes() + c.astype("<i4").tobytes(), digest_size=16).hexdigest()
                got = [len(text or b""), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), len(payload) // HOP - 1, f"{len(t)}:{digest}", t, c]
                for column, value in zip(out, [*got, *[media] * keep_media], strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * keep_media]
            names = "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 n_frames feature peak_times peak_codes".split() + ["media"] * keep_media
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names=names)

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, _SCHEMA + _KEPT * keep_media)
