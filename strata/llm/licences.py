"""Licence scan with a trained paragraph classifier.

A paragraph is a line of the text. A line of more than 12 words is also read by
sentences and in overlapping windows of 12, 24 and 48 words, so that prose
around a statement doesn't dilute it. Sparse word uni- and bigrams go to a multinomial logistic regression over the
licence families and a class ``unknown``. It is trained on the templates below,
on statements made from the families' names, alone and amid prose, and on
lines of the corpus (at most ``sample_lines`` in expectation, chosen by hash); a held-out fold
calibrates the probabilities by temperature. A prediction counts only if its
calibrated probability reaches ``THRESHOLD`` and the comparison with the
family's templates confirms it.

Defined results
* Null and empty texts, and texts without a licence, have empty lists.
* Windows of one family that overlap or touch become one span, and so do
  neighbouring paragraphs; spans give code point offsets, the highest
  probability and similarity. Where windows of two families overlap, one that
  its templates confirm clearly less (a statement cut off) doesn't count, nor
  does one with words that families share where the other's are its own.
* Names joined by ``and`` or ``or`` are read one by one; a short line under a
  heading ``License`` is read with it. Paragraphs are lines otherwise: a
  statement wrapped inside its name is read in parts.
* A statement whose verb follows a denial (``not licensed under``) and names of
  other licences don't count.
* Equal probabilities go to the family that sorts first.
* Repeated rows are separate rows; an empty table gives no rows. Other columns
  are carried along, and ``licences`` and ``spans`` replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate, zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices, with_fields

UNKNOWN = "unknown"
THRESHOLD = 0.6
SIMILAR = 0.7
WINDOW, STRIDE = 48, 24
SCALES = (12, 24, WINDOW)
UNDER = 5  # words of a line that are read with the heading above it
CUT_OFF = 0.1  # less similar by this than an overlapping window of another family
LINE_CHARS = 2000  # of a line of the corpus that is trained on, from a random place of it

# fixed values: names of licence families, and parts of their public texts
NAMES = {
    "agpl": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL", "AGPL-3.0", "AGPL-3.0-or-later"],
    "apache": ["Apache License", "Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache Software License"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "New BSD License"],
    "cc-by": ["CC BY", "CC BY 4.0", "CC BY 3.0", "CC-BY-4.0", "Creative Commons Attribution License", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC", "CC BY-NC 4.0", "CC BY-NC 3.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["CC BY-SA", "CC BY-SA 4.0", "CC BY-SA 3.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["CC0", "CC0 1.0", "CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"],
    "gpl": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL", "GPL", "GPL v3", "GPL v2", "GPLv3", "GPL-3.0", "GPL-2.0-or-later"],
    "isc": ["ISC License", "ISC"],
    "lgpl": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3", "LGPL", "LGPL-2.1", "LGPL-3.0"],
    "mit": ["MIT License", "MIT license", "MIT", "Expat License"],
    "mpl": ["Mozilla Public License", "Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"],
    "unlicense": ["Unlicense"],
}
TEMPLATES = {
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "apache": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "cc-by": ["This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
    "cc-by-nc": ["This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"],
    "cc-by-sa": ["This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal Public Domain Dedication."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
STATEMENTS = ["Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "Released under {}.", "This work is licensed under the {}.", "This work is licensed under {}.",
              "Distributed under the terms of the {}.", "This software is available under the {}.", "This project is made available under {}.", "SPDX-License-Identifier: {}",
              "License: {}", "Licence: {}", "It is {} licensed.", "The code is covered by the {}; see the file LICENSE for details.", "You may use it under the {}."]
OTHER = ["All rights reserved.", "A driving license is required for this job.", "The license plate was covered with mud.", "Terms and conditions apply.", "See the general terms of the public offer.",
         "He was released under the care of his mother.", "The work is released every year in May.", "The restaurant lost its license to sell wine.", "Version 3 of the work is out now.",
         "This work is about the general public and its rights.", "Copyright notices are found on the last page.", "The public licensed the new version of the plan.", "Commons and common land in the north.",
         "This program is on the air at nine.", "Permission to enter is hereby denied.", "She studied at the institute and then moved on.", "The software is sold with a warranty of two years."]

# fixed values: names of licences outside the families, and words that deny or state
STRANGERS = ["Eclipse Public License, version 2.0", "EPL-2.0", "GNU Free Documentation License", "GFDL", "Artistic License 2.0", "European Union Public Licence",
             "Common Development and Distribution License", "CDDL-1.0", "Microsoft Public License", "Zlib License", "Boost Software License 1.0", "Python Software Foundation License",
             "PostgreSQL License", "SIL Open Font License 1.1", "Open Database License", "commercial license", "proprietary license"]
DENIALS = frozenset("not never no isn aren cannot neither nor".split())
JOINS = frozenset(("and", "or"))
HEADINGS = (["license"], ["licence"], ["licensing"])
VERBS = frozenset("licensed released distributed available covered under".split())

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_STOP = re.compile(r"[.!?;]")
_VERSION = re.compile(r"v?\d+(?:\.\d+)*")


def grams(words: list[str]) -> set:
    """Distinct words and pairs of neighbours: repeating a word adds nothing."""
    return {*words, *zip(words, words[1:])}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def denials(words: list[str]) -> set:
    """Pairs that begin with a denial, where a statement's verb follows within three words."""
    return {(w, words[k + 1]) for k, w in enumerate(words) if w in DENIALS and not VERBS.isdisjoint(words[k + 1:k + 4])}


def paragraphs(text: str):
    """``start, end, words`` of each paragraph."""
    at = 0
    for line in text.split("\n"):
        words = words_of(line)
        if len(words) <= WINDOW:
            yield at, at + len(line), words
        else:
            places = [m.span() for m in _WORD.finditer(line.lower())] if len(line.lower()) == len(line) else [m.span() for m in _WORD.finditer(line)]
            n = min(len(words), len(places))
            for i in range(0, max(1, n - STRIDE), STRIDE):
                j = min(n, i + WINDOW)
                yield at + places[i][0], at + places[j - 1][1], words[i:j]
        at += len(line) + 1


@dataclass
class Model:
    families: list[str]      # the last is unknown
    index: dict              # gram -> row of weights
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    margin: dict             # gram -> how much it can speak for a family, against unknown
    templates: dict          # family -> grams of each template, and those that confirm it

    def classify(self, words: list[str]) -> tuple[str, float]:
        """The family and its calibrated probability (or unknown)."""
        own, get = grams(words), self.margin.get
        n, hits = max(1, len(own)), own & self.index.keys()
        # a bound on the best family's lead: most paragraphs end here
        if sum([get(g, 0.0) for g in hits]) / n**0.5 + self.lead < 0:
            return UNKNOWN, 1.0
        hits = sorted(hits, key=self.index.__getitem__)
        z = (self.weights[[self.index[g] for g in hits]].sum(axis=0) / n**0.5 + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.families[k], float(p[k])

    def __post_init__(self) -> None:
        self.lead = float((self.bias[:-1] - self.bias[-1]).max()) if len(self.bias) else 0.0
        held = {f: {g for t, _ in known for g in t} for f, known in self.templates.items()}
        self.sole = {f: frozenset(own.difference(*(o for other, o in held.items() if other != f))) for f, own in held.items()}
        named = {f: {w for n in NAMES.get(f, ()) for w in words_of(n)} for f in self.sole}
        self.teller = {w: f for f, own in self.sole.items() for w in own & named[f] if not _VERSION.fullmatch(w)}
        self.pairs = {g for known in self.templates.values() for t, _ in known for g in t if isinstance(g, tuple)}

    def hopeless(self, total: float, words: list[str]) -> bool:
        """Whether margins of this sum can't beat unknown: w different words
        make w - 1 different pairs at least."""
        return total / max(1, 2 * len(set(words)) - 1) ** 0.5 + self.lead < 0

    def similarity(self, family: str, words: list[str], denied: set = frozenset()) -> float:
        """Share of words and pairs that the paragraph and the nearest
        template of the family have in common, of the shorter of the two (at
        least three, so that one common word confirms nothing). A template
        counts only with a gram that confirms it: for a statement, one that no
        other family's name holds. One that doesn't hold the denials itself
        doesn't count either."""
        own = grams(words)
        return max((len(own & t) / max(3, min(len(own), len(t))) for t, telling in self.templates[family] if denied <= t and not telling.isdisjoint(own)), default=0.0)

    def hits(self, line: str, words: list[str]) -> list[tuple[int, int, int, int, str, float, float, bool]]:
        """``first word, word after the last, start, end, family, probability,
        similarity, sure`` of the windows of a line that hold a licence; sure
        ones hold a gram of that family's templates alone."""
        n, whole = len(words), (0, len(words))
        places: list[tuple[int, int]] = []
        # without a pair of a template, similarity stays below SIMILAR: words alone are at most two thirds
        shared = [pair in self.pairs for pair in zip(words, words[1:])]
        if True not in shared:
            return []
        ends = [0]
        if n <= SCALES[0]:
            ranges = [whole]
        else:
            get = self.margin.get
            sums = [0.0, *accumulate([get(w, 0.0) + get(pair, 0.0) for w, pair in zip(words, zip_longest(words, words[1:]))])]
            pairs = [0, *accumulate(shared)]
            ranges = [whole] if n <= WINDOW else []
            places = [m.span() for m in _WORD.finditer(line.lower() if len(line.lower()) == len(line) else line)]
            n = min(n, len(places))
            ranges += [(i, min(n, i + size)) for size in SCALES if size < n for i in range(0, n - size // 2, size // 2)]
            ends = [0, *(i + 1 for i in range(n - 1) if _STOP.search(line, places[i][1], places[i + 1][0])), n]
            ranges += [(i, j) for i, j in zip(ends, ends[1:]) if j - i <= WINDOW]
            ranges = sorted({(i, j) for i, j in ranges if pairs[j - 1] > pairs[i] and not self.hopeless(sums[j] - sums[i], words[i:j])})
        out = []
        for i, j in ranges:
            read = [words[i:j]]
            named = {self.teller[w] for w in read[0] if w in self.teller}
            if len(named) > 1 and not JOINS.isdisjoint(read[0]) and not any(i < e < j for e in ends):
                # a list of names in one sentence: each read without the others
                read += [[w for w in read[0] if w not in JOINS and self.teller.get(w, f) == f] for f in sorted(named)]
            out += self._confirmed(line, words, read, i, j, places, max(ends[bisect_right(ends, i) - 1], i - SCALES[0]))
        return out

    def _confirmed(self, line: str, words: list[str], read: list[list[str]], i: int, j: int, places: list, first: int) -> list[tuple]:
        """The hits of one window in its readings; denials count from word ``first``."""
        out: list[tuple] = []
        no, whole = denials(words[first:j]), (0, len(words))
        for own in read:
            family, p = self.classify(own)
            if family != UNKNOWN and p >= THRESHOLD and family not in {h[4] for h in out} and (near := self.similarity(family, own, no)) >= SIMILAR:
                start, end = (0, len(line)) if (i, j) == whole else (places[i][0], places[j - 1][1])
                out.append((i, j, start, end, family, p, near, not self.sole[family].isdisjoint(grams(own))))
        return out

    def scan(self, text: str | None) -> list[dict]:
        found: list[dict] = []
        at, heading, open_before = 0, False, {}  # spans that end with the line before
        for line in (text or "").split("\n"):
            words = words_of(line)
            heading, under = (words in HEADINGS, heading) if words else (heading, False)
            if under and len(words) <= UNDER:
                words = ["license", *words]
            hits = self.hits(line, words)
            spans: dict[str, dict] = {}  # the last span of each family
            reach: dict[str, int] = {}
            for k, (i, j, start, end, family, p, near, _) in enumerate(hits):
                if _beaten(hits, k):
                    continue
                if family in spans and i <= reach[family]:
                    span = spans[family]
                elif i == 0 and family in open_before:
                    span = open_before[family]
                else:
                    span = {"family": family, "start": at + start, "end": at + end, "probability": p, "similarity": near}
                    found.append(span)
                span |= {"end": max(span["end"], at + end), "probability": max(p, span["probability"]), "similarity": max(near, span["similarity"])}
                spans[family], reach[family] = span, max(j, reach.get(family, 0))
            open_before = {f: s for f, s in spans.items() if reach[f] == len(words)}
            at += len(line) + 1
        return found


def _beaten(hits: list[tuple], k: int) -> bool:
    """Whether a window of another family overlaps and is clearly more similar,
    or is sure where this one isn't (a passage that two families' texts share)."""
    i, j, _, _, family, _, near, sure = hits[k]
    for step in (-1, 1):
        m = k + step
        while 0 <= m < len(hits) and i - WINDOW < hits[m][0] < j:
            if hits[m][1] > i and hits[m][4] != family and (hits[m][6] > near + CUT_OFF or hits[m][7] > sure):
                return True
            m += step
    return False


def examples() -> list[tuple[str, list[str]]]:
    """Labelled paragraphs made from the names, statements and templates."""
    out = []
    for family, names in NAMES.items():
        out += [(family, words_of(s.format(n))) for n in names for s in STATEMENTS]
        for text in TEMPLATES[family]:
            words = words_of(text)
            out += [(family, words)] * 4 + [(family, words[i:i + n]) for n in (10, 16, 24) for i in range(0, max(1, len(words) - n + 1), 5)]
    out += [(UNKNOWN, words_of(s.format(n))) for n in STRANGERS for s in STATEMENTS]
    return out + [(UNKNOWN, words_of(t)) for t in OTHER for _ in range(8)]


def templates() -> dict:
    """Per family, the grams of its templates and of the statements with each
    name, and the grams that confirm each.

    What statements share, versions, and what another family's or a stranger's
    name holds too confirm nothing: a version, ``gnu`` or ``public license``
    doesn't tell a name, ``gnu general`` does."""
    def pairs(text: str) -> frozenset:
        return frozenset(grams(words_of(text)))

    plain = frozenset().union(*(pairs(t) for t in (*STATEMENTS, *OTHER)))
    names = {f: frozenset().union(*map(pairs, ns)) for f, ns in NAMES.items()}
    strange = frozenset().union(*map(pairs, STRANGERS))

    def version(gram) -> bool:
        return any(_VERSION.fullmatch(w) for w in ([gram] if isinstance(gram, str) else gram))

    out = {}
    for family in NAMES:
        shared = plain.union(strange, *(grams_ for f, grams_ in names.items() if f != family))
        own = frozenset(g for g in names[family] - shared if not version(g))
        out[family] = [(pairs(t), pairs(t) - plain) for t in TEMPLATES[family]]
        out[family] += [(pairs(s.format(n)), pairs(n) & own) for n in NAMES[family] for s in STATEMENTS]
    return out


def amid_prose(prose: list[str], seed: int) -> list[tuple[str, list[str]]]:
    """Windows with a statement, or a sentence that only resembles one, at any
    place among words of the corpus."""
    rng, out = np.random.default_rng(seed), []
    said = [(f, words_of(s.format(n))) for f, names in NAMES.items() for n in names for s in STATEMENTS] + [(UNKNOWN, words_of(t)) for t in OTHER for _ in range(8)]
    for number, (family, words) in enumerate(said):
        room = SCALES[0 if len(words) < SCALES[0] and number % 3 else 1] - len(words)
        at, before = int(rng.integers(len(prose))), int(rng.integers(room + 1))
        around = [prose[(at + k) % len(prose)] for k in range(room)]
        out.append((family, around[:before] + words + around[before:]))
    return out


def train(lines: list[str], epochs: int = 250, seed: int = 11) -> Model:
    """``lines``: paragraphs of the corpus, for the class unknown; those that
    resemble a template are left out. They are also the prose around statements."""
    known = templates()
    bag = Model([*sorted(NAMES), UNKNOWN], {}, np.zeros((0, 0)), np.zeros(0), 1.0, {}, known)
    data = examples()
    for number, line in enumerate(lines):
        read = [words for _, _, words in paragraphs(line) if words]
        words = read[len(line) % len(read)] if read else []
        words = words[:SCALES[number % len(SCALES)]]
        if words and max(bag.similarity(f, words) for f in known) < 0.5:
            data.append((UNKNOWN, words))
    counts: dict = {}
    for _, words in data:
        for g in grams(words):
            counts[g] = counts.get(g, 0) + 1
    index = {g: i for i, g in enumerate(sorted((g for g, n in counts.items() if n >= 2), key=str))}
    data += amid_prose([w for f, words in data if f == UNKNOWN for w in words], seed)
    x = np.zeros((len(data), len(index)), np.float32)
    for r, (_, words) in enumerate(data):
        own = grams(words)
        x[r, [index[g] for g in own if g in index]] = max(1, len(own)) ** -0.5
    families = bag.families
    y = np.array([families.index(f) for f, _ in data])
    rng = np.random.default_rng(seed)
    test = rng.random(len(data)) < 0.2
    weight = (1 / np.bincount(y, minlength=len(families)))[y]
    weight[y == len(families) - 1] *= 3
    xt, yt, wt = x[~test], y[~test], weight[~test] / weight[~test].sum()
    w, b = np.zeros((len(index), len(families)), np.float32), np.zeros(len(families), np.float32)
    m = s = np.zeros_like(w)
    mb = sb = np.zeros_like(b)
    target = np.eye(len(families), dtype=np.float32)[yt]
    for step in range(1, epochs + 1):
        z = xt @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        e = ((p - target) * wt[:, None]).astype(np.float32)
        g, gb = xt.T @ e + 1e-5 * w, e.sum(axis=0)
        m, s, mb, sb = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        b = b - 0.05 * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.99**step)) + 1e-8)

    def loss(t: float) -> float:
        z = (x[test] @ w + b) / t
        z -= z.max(axis=1, keepdims=True)
        return float(((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y[test]]) * weight[test]).sum())

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    lead = np.maximum(0, (w[:, :-1] - w[:, -1:]).max(axis=1))
    keep = {g: i for g, i in index.items() if np.abs(w[i]).max() > 1e-3}
    return Model(families, keep, w, b, temperature, {g: float(lead[i]) for g, i in keep.items()}, known)


def fit(docs: DataFrame, sample_lines: int = 1500, text_col: str = "text") -> Model:
    """Train with one line each of about ``sample_lines`` different texts."""
    text = F.col(text_col)
    total = docs.where(text.isNotNull()).select(F.xxhash64(text)).distinct().count()  # copies count once, here as below
    if not total:
        return train([])
    line = F.split(text, "\n")
    one = F.element_at(line, (F.pmod(F.xxhash64(text, F.lit(1)), F.size(line)) + 1).cast("int"))
    start = F.pmod(F.xxhash64(text, F.lit(2)), F.greatest(F.char_length(one) - LINE_CHARS, F.lit(0)) + 1) + 1
    rows = (docs.where(text.isNotNull() & (F.pmod(F.xxhash64(text), F.lit(1 << 30)) < F.lit(float(1 << 30)) * sample_lines / total))
            .select(F.substring(one, start.cast("int"), F.lit(LINE_CHARS)).alias("line"))
            .distinct().toArrow())  # copies of a chosen text bring the same line, which counts once
    return train(sorted(rows.column("line").to_pylist()))


def scan(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``licences`` (families, sorted) and ``spans``."""
    src = docs.drop("licences", "spans")
    span = T.StructType().add("family", "string").add("start", "integer").add("end", "integer").add("probability", "double").add("similarity", "double")
    schema = with_fields(src, ("licences", T.ArrayType(T.StringType())), ("spans", T.ArrayType(span)))
    kind = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64()), ("similarity", pa.float64())]))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the templates and sample_lines

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                spans = [sent.value.scan(t) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([sorted({s["family"] for s in x}) for x in spans], pa.list_(pa.string())), pa.array(spans, kind)], names=schema.names)

    return src.mapInArrow(run, schema)
