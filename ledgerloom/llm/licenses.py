"""Operator 10: licence scans by Dice coefficients over word bigrams.

A text's segments (its lines, the sentences of lines that have several, its
paragraphs of several lines, and the whole text) and the windows of each
template's number of words, wherever they begin, are normalised to lower-case
words and compared with licence templates by the Dice coefficient over word
bigrams, repeats included. A template is a candidate only if the numbers of
bigrams allow the threshold: with ``n <= m`` bigrams the coefficient is at most
``2n / (n + m)``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare

THRESHOLD = 0.8

#: Public licence notices and short licence texts by SPDX id.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Distributed under the terms of the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Licensed under the Mozilla Public License, version 2.0."),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Licensed under the 3-Clause BSD License."),
    "BSD-2-Clause": ("Licensed under the 2-Clause BSD License.", "This project is licensed under the BSD 2-Clause \"Simplified\" License."),
    "EPL-2.0": ("Licensed under the Eclipse Public License, version 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    "Zlib": ("Licensed under the zlib License.", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Licensed under the ISC License."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Licensed under CC0 1.0 Universal."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
}

_WORDS = re.compile(r"[^\W_]+").findall
_SENTENCE = re.compile(r"(?<=[.!?:;])[ \t]+")


def normal_words(text: str) -> list[str]:
    return _WORDS(text.lower())


def bigrams(words: list[str]) -> Counter:
    """Counts of word pairs; a lone word pairs with nothing but counts as itself."""
    return Counter(zip(words, words[1:], strict=False)) if len(words) > 1 else Counter((w,) for w in words)


def dice(a: Counter, b: Counter) -> float:
    n = a.total() + b.total()
    return 2 * (a & b).total() / n if n else 0.0


class Scanner:
    """Compares segments with all templates whose size allows the threshold."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.templates = [(name, k, bigrams(normal_words(t))) for name, texts in sorted(templates.items()) for k, t in enumerate(texts)]
        self.sizes = [b.total() for *_, b in self.templates]
        self.lengths = [m + (len(next(iter(b), ())) > 1) for (*_, b), m in zip(self.templates, self.sizes, strict=True)]
        ratio = threshold / (2 - threshold)  # of the smaller size to the larger one, at least
        self.fitting: dict[int, list[int]] = {}
        for n in range(1, int(max(self.sizes, default=0) / ratio) + 2):
            if fit := [k for k, m in enumerate(self.sizes) if 2 * min(n, m) >= threshold * (n + m)]:
                self.fitting[n] = fit
        self.least = [max(1, math.ceil(ratio * m - 1e-9)) for m in self.sizes]  # bigrams that a window shares, at least
        self.holders: dict[tuple, list[int]] = {}
        for k, (*_, b) in enumerate(self.templates):
            for pair in b:
                self.holders.setdefault(pair, []).append(k)
        self.lone = any(len(pair) == 1 for pair in self.holders)

    def segment(self, words: list[str]) -> tuple[float, int] | None:
        """(coefficient, template) of the best template at the threshold; ties take the first."""
        fit = self.fitting.get(max(1, len(words) - 1)) if words else None
        if not fit:
            return None
        pairs = zip(words, words[1:], strict=False) if len(words) > 1 else ((w,) for w in words)
        if not any(p in self.holders for p in pairs):
            return None
        mine = bigrams(words)
        best = max(((dice(mine, self.templates[k][2]), -k) for k in fit), default=(0.0, 0))
        return (best[0], -best[1]) if best[0] >= self.threshold else None

    def segments(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """(first line, words) of each segment; those longer than any template allows are left out."""
        for n, _, w in self.placed(text):
            yield n, w

    def placed(self, text: str) -> Iterator[tuple[int, int, list[str]]]:
        """The segments with the place of their first word in the text."""
        most = max(self.fitting, default=0) + 1
        lines = [normal_words(x) for x in text.split("\n")]
        begin = [0, *accumulate(map(len, lines))]
        for n, (w, raw) in enumerate(zip(lines, text.split("\n"), strict=True)):
            if 0 < len(w) <= most:
                yield n, begin[n], w
            if len(w) > 1 and len(parts := _SENTENCE.split(raw)) > 1:
                at = begin[n]
                for part in parts:
                    if 0 < len(p := normal_words(part)) <= most:
                        yield n, at, p
                    at += len(p)
        start = 0
        blocks = []
        for n, w in enumerate([*lines, []]):
            if not w:
                if n - start > 1:
                    blocks.append((start, n))
                start = n + 1
        if len(lines) > 1 and (0, len(lines)) not in blocks:
            blocks.append((0, len(lines)))
        for a, b in blocks:
            if sum(map(len, lines[a:b])) <= most:
                yield a, begin[a], [x for w in lines[a:b] for x in w]

    def windows(self, words: list[str]) -> Iterator[tuple[float, int, int, int]]:
        """(coefficient, template, start, end) of the windows of a template's length at the threshold.

        Only windows that begin with a bigram of the template are compared: one
        that does not shares no less when it is moved on to the next such bigram.
        """
        held: dict[int, list[int]] = {}
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for k in self.holders.get(pair, ()):
                held.setdefault(k, []).append(i)
        if self.lone:
            for i, w in enumerate(words):
                for k in self.holders.get((w,), ()):
                    held.setdefault(k, []).append(i)
        for k, at in held.items():
            least, m = self.least[k], self.sizes[k]
            for i, last in zip(at, at[least - 1 :], strict=False):
                if last - i < m and (d := dice(bigrams(words[i : i + self.lengths[k]]), self.templates[k][2])) >= self.threshold:
                    yield d, k, i, min(len(words), i + self.lengths[k])

    def __call__(self, text: str | None) -> list[tuple[int, str, float]]:
        """(line, licence, coefficient) of every matching segment, and of the best windows apart from these, by line.

        A window counts unless it overlaps a match that is no worse.
        """
        text = text or ""
        taken, found = [], []
        for n, at, w in self.placed(text):
            if hit := self.segment(w):
                taken.append((at, at + len(w), *hit))
                found.append((n, self.templates[hit[1]][0], round(hit[0], 6)))
        lines = [normal_words(x) for x in text.split("\n")]
        ends = list(accumulate(map(len, lines)))
        more = []
        for d, k, a, b in sorted(self.windows([x for w in lines for x in w]), key=lambda x: (-x[0], x[2] - x[3], x[2], x[1])):
            if not any(a < y and x < b and e >= d for x, y, e, _ in taken):
                n = bisect_right(ends, a)
                taken.append((a, b, d, k))
                more.append((n, self.templates[k][0], round(d, 6)))
        return sorted(found + more, key=lambda x: x[0]) if more else found


def scan_licenses(df: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license (of the best match, null without one), dice, matches for every row; whole texts.

    matches: array of (line, license, dice), by line; see Scanner. Best: the largest
    coefficient, ties by name. Null and empty texts match nothing; repeated and
    null ids, empty tables and other columns are no matter.
    """
    prepare(df.sparkSession)
    match = pa.struct([("line", pa.int32()), ("license", pa.string()), ("dice", pa.float64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(templates, threshold)
        for batch in rows:
            found = [scan(t) for t in batch.column(1).to_pylist()]
            best = [min(((-d, name) for _, name, d in f), default=None) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([b and b[1] for b in best], pa.string()),
                    pa.array([-b[0] if b else 0.0 for b in best], pa.float64()),
                    pa.array([[dict(zip(("line", "license", "dice"), m, strict=True)) for m in f] for f in found], pa.list_(match)),
                ],
                names=["doc_id", "license", "dice", "matches"],
            )

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, "doc_id long, license string, dice double, matches array<struct<line:int,license:string,dice:double>>")
