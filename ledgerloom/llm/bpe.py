"""Operator 7: byte-level BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a block of a partition are laid out as one linked
sequence of symbols. An index maps each adjacent pair that has a merge rank to
all its positions; active ranks are applied in ascending order, all positions
of a rank at once, and the lists of the pairs that arise beside the merged
positions are updated. Finished pre-tokens are remembered (bounded) for later
blocks, so results never depend on how rows fall into blocks.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import prepare

#: The fixed split pattern of this vocabulary family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_WORDS = 150_000  # remembered pre-tokens; beyond, the memory starts anew


def _byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable ones stand for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class _Words(dict):
    """Numbers of pre-tokens; new ones are queued."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class BytePairs:
    """Encoder and decoder of one vocabulary file (JSON with model.vocab, model.merges, added_tokens)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        vocab, letters = j["model"]["vocab"], _byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in j["model"]["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        codes = (left << 32) | right
        self.sorted = np.argsort(codes, kind="stable")
        self.codes, self.left, self.right, self.made = codes[self.sorted], left, right, made
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        size = max(max(vocab.values()), *self.special.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, n in vocab.items():
            self.bytes[n] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, n in self.special.items():
            self.bytes[n] = token.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.first[b] = vocab[c]
        self.find = regex.compile(SPLIT).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.forget()

    def forget(self) -> None:
        self.words = _Words()
        self.flat, self.offsets = np.empty(0, np.int32), np.zeros(1, np.int64)
        for token in self.special:
            self.words[token]  # noqa: B018  numbers it
        self.learn()

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs, -1 where there is none."""
        code = (a << 32) | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.sorted[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of byte strings, each encoded on its own."""
        sizes = np.array([len(w) for w in words], np.int64)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        n = len(sym)
        ends = np.cumsum(sizes)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends[sizes > 0] - 1] = -1
        prv[(ends - sizes)[sizes > 0]] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.ranks(sym[at], sym[nxt[at]])
            known = rank >= 0
            if not known.any():
                return
            at, rank = at[known], rank[known]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, where in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(where)

        note(np.flatnonzero(nxt >= 0))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            a, b = self.left[r], self.right[r]
            at = at[(sym[at] == a) & (nxt[at] >= 0)]
            at = at[sym[nxt[at]] == b]
            if a == b and len(at) > 1:
                keep, taken = [], -1
                for p, q in zip(at.tolist(), nxt[at].tolist(), strict=True):
                    if p != taken:
                        keep.append(p)
                        taken = q
                at = np.array(keep, np.int64)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at], sym[gone], nxt[at] = self.made[r], -1, after
            more = after >= 0
            prv[after[more]] = at[more]
            before = prv[at]
            note(np.unique(np.concatenate([before[before >= 0], at[more]])))
        live = sym >= 0
        upto = np.concatenate(([0], np.cumsum(live)))
        return sym[live].astype(np.int32), np.concatenate(([0], upto[ends])) if len(words) else np.zeros(1, np.int64)

    def learn(self) -> None:
        """Encodes the pre-tokens queued by the last look-ups."""
        new, self.words.new = self.words.new, []
        if new:
            flat, offsets = self.merge([b"" if w in self.special else w.encode() for w in new])
            for k, w in enumerate(new):
                if w in self.special:  # an id of its own, never split
                    flat = np.insert(flat, offsets[k], self.special[w])
                    offsets[k + 1 :] += 1
            self.flat = np.concatenate([self.flat, flat])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(t in text for t in self.special):
            return self.find(text)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            out += [part] if k % 2 else self.find(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets), a stretch for each text."""
        if len(self.words) > MOST_WORDS:
            self.forget()
        numbers, counts = [], []
        for t in texts:
            p = self.pieces(t)
            counts.append(len(p))
            numbers.append(np.fromiter(map(self.words.__getitem__, p), np.int64, len(p)))
        self.learn()
        which = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        start, size = self.offsets[which], self.offsets[which + 1] - self.offsets[which]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_LOADED: dict[str, BytePairs] = {}


def tokenizer(path: str) -> BytePairs:
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


TEXT_BLOCK = 4 << 20  # characters encoded at once


def blocks(values: list, most: int = TEXT_BLOCK) -> Iterator[list]:
    """Runs of texts of about most characters; a longer text is a run of its own."""
    run, size = [], 0
    for v in values:
        if run and size + len(v) > most:
            yield run
            run, size = [], 0
        run.append(v)
        size += len(v)
    if run:
        yield run


def bpe_tokens(df: DataFrame, path: str, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of each row's whole text; decoded adds the text read back from the ids.

    path: the vocabulary file, present on each executor. Special tokens inside
    a text become their ids. Null text: empty, no ids. Ids may repeat or be
    null; empty tables give no rows; other columns are ignored.
    """
    prepare(df.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in rows:
            at = 0
            for texts in blocks([x or "" for x in batch.column(1).to_pylist()]):
                ids, offsets = t.encode(texts)
                out = [batch.column(0).slice(at, len(texts)).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))]
                if decoded:
                    out.append(pa.array([t.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", *["decoded"] * decoded])

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)
