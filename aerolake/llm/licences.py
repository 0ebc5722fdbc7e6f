"""Licence scans: a paragraph classifier whose finds a template must confirm.

A paragraph is a line of the text, or the neighbouring lines (none of them empty) over which
a wrapped notice runs; it is reported with its first line. Its words (lower case, cut at
signs, so that comment signs fall away) and word pairs and triples are the features of a
sparse logistic regression over licence families and an unknown class. It is trained on the
templates below, worn by dropped, changed and added words, and for the unknown class on
paragraphs of a bounded sample of documents, on shuffled template words, and on sentences
that talk of licences without granting one. A held-back part calibrates it: a temperature
for the probabilities, and a least probability that all but one in 200 unknown paragraphs
stay below. A paragraph is reported if a family wins with that probability and at least
``MIN_SIMILARITY`` of the word pairs of one of the family's templates stand in it. Other
paragraphs with the words of a grant (``CUES``) are reported as of the unknown class, with
its probability.

A paragraph without any of a template's keys, the rarest of its pairs and one more than may
be missing, can't confirm it, so only lines with a key and their neighbours are scored;
that they are few makes the scan one pass over the words of whole texts.

Defined cases: a null or empty text has no paragraphs; repeated rows are scanned row by row;
with no documents nothing is found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Families: their usual notices, headers and the paragraphs of their texts (fixed values).
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0", "This file is made available under the Apache License 2.0",
               "You may not use this file except in compliance with the Apache License", "Apache License Version 2.0, January 2004",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
               "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
               "See the License for the specific language governing permissions and limitations under the License.",
               "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
               "royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
               "distribute the Work and such Derivative Works in Source or Object form."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License",
            "This program is free software and may be redistributed under the terms of the GNU General Public License", "SPDX License Identifier GPL"),
    "lgpl": ("Licensed under the GNU Lesser General Public License", "This library is free software under the terms of the GNU Lesser General Public License"),
    "agpl": ("Licensed under the GNU Affero General Public License",),
    "mit": ("Released under the MIT License", "Licensed under the MIT License", "This project is distributed under the terms of the MIT License", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "bsd": ("Licensed under the BSD License", "Released under the 3 clause BSD License", "Use of this source code is governed by a BSD style license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
            "and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
            "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    "mpl": ("This source code is subject to the terms of the Mozilla Public License", "Licensed under the Mozilla Public License, version 2.0",
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0",
            "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "cc-by": (), "cc-by-sa": ("This work is licensed under a Creative Commons Attribution ShareAlike License",),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution NonCommercial License",),
    "cc-by-nd": (), "cc-by-nc-sa": (), "cc-by-nc-nd": (),
    "public-domain": ("This work is dedicated to the public domain", "Released into the public domain under CC0", "CC0 1.0 Universal Public Domain Dedication",
                      "This is free and unencumbered software released into the public domain.",
                      "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                      "for any purpose, commercial or non-commercial, and by any means.",
                      "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
}
_SPDX = {"apache": ("Apache-2.0",), "mit": ("MIT",), "bsd": ("BSD-2-Clause", "BSD-3-Clause"), "mpl": ("MPL-1.1", "MPL-2.0"), "public-domain": ("CC0-1.0", "Unlicense")}
_PARTS = {"sa": "ShareAlike", "nc": "NonCommercial", "nd": "NoDerivatives"}
for _family, _name, _thing, _versions in (("gpl", "", "program", ("2.0", "3.0")), ("lgpl", "Lesser ", "library", ("2.0", "2.1", "3.0")), ("agpl", "Affero ", "program", ("3.0",))):
    TEMPLATES[_family] += (
        f"This {_thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {_name}General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        f"under the terms of the GNU {_name}General Public License as published by the Free Software Foundation",
        f"This {_thing} is distributed under the terms of the GNU {_name}General Public License", f"GNU {_name}General Public License Version 3",
        f"You should have received a copy of the GNU {_name}General Public License along with this {_thing}.")
    _SPDX[_family] = tuple(f"{_family.upper()}-{v}{end}" for v in _versions for end in ("", "-only", "-or-later"))
for _family in [f for f in TEMPLATES if f.startswith("cc-")]:
    _short, _versions = _family[3:].upper(), (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"))
    _long = "-".join(["Attribution", *[_PARTS[x] for x in _family.split("-")[2:]]])
    TEMPLATES[_family] += (f"Licensed under CC {_short} 4.0", f"Licensed under the Creative Commons {_long} License",
                           *[f"This work is licensed under a Creative Commons {_long} {v} {kind} License" for v, kind in _versions])
    _SPDX[_family] = tuple(f"CC-{_short}-{v}" for v, _ in _versions)
for _family, _ids in _SPDX.items():
    TEMPLATES[_family] += tuple(f"SPDX-License-Identifier: {x}" for x in _ids)
UNKNOWN = "unknown"
#: What grants something under a licence of no family here, if one of LICENCE_WORDS is near.
CUES = ("SPDX License Identifier", "licensed under the", "licensed under a", "released under the", "released under a", "distributed under the", "distributed under a",
        "made available under the", "under the terms of the", "is hereby granted")
LICENCE_WORDS = {b"license", b"licence", b"licenses", b"licences", b"permission"}
#: Sentences with the same words that grant nothing.
OTHER = ("the driver showed his license to the officer", "the license of the shop was renewed last year", "this work is a version of the public play",
         "the album was released under pressure", "the general public is free to visit the work", "copyright law is a subject of this course",
         "the terms of the contract were subject to change", "the software license costs too much", "version 2.0 of the file was released",
         "the source of the river is in the public park", "use of this road is governed by law", "the library is free to the public")
SAMPLE_ROWS = 200
SAMPLE_CHARS = 2000
MIN_SIMILARITY = 0.8
#: Worn copies of a family's templates.
WORN = 240
ROUNDS = 250

_PLAIN = bytes(0x20 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256)).lower()


def plain_words(line: bytes) -> list[bytes]:
    return line.translate(_PLAIN).split()


def grams(words: list[bytes]) -> set[tuple]:
    return {tuple(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def pairs(words: list[bytes]) -> set[tuple]:
    return set(zip(words, words[1:]))


@dataclass
class Model:
    classes: list[str]
    weights: dict  # n-gram -> a weight for each class
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        score = self.bias.copy()
        for g in grams(words):
            w = self.weights.get(g)
            if w is not None:
                score += w
        score = np.exp((score - score.max()) / self.temperature)
        return score / score.sum()

    def judge(self, words: list[bytes]) -> tuple[str, float, int, float] | None:
        """(family, probability, template, share of the template's pairs) of a confirmed find."""
        p = self.probabilities(words)
        best = int(np.argmax(p))
        own, family = pairs(words), self.classes[best]
        if family != UNKNOWN and p[best] >= self.threshold:
            at, share = _nearest(own, family)
            if share >= MIN_SIMILARITY:
                return family, float(p[best]), at, share
        if not LICENCE_WORDS.isdisjoint(words):
            at, share = _nearest(own, UNKNOWN)
            if share >= MIN_SIMILARITY:
                return UNKNOWN, float(p[-1]), at, share
        return None


_TEXTS = {**TEMPLATES, UNKNOWN: CUES}
_PAIRS = {family: [pairs(plain_words(t.encode())) for t in texts] for family, texts in _TEXTS.items()}


def _nearest(own: set, family: str) -> tuple[int, float]:
    shares = [len(t & own) / len(t) for t in _PAIRS[family]]
    at = int(np.argmax(shares))
    return at, shares[at]


def _worn(words: list[bytes], filler: list[bytes], rng) -> list[bytes]:
    out = [w for w in words if rng.random() > 0.08]
    out = [filler[rng.integers(len(filler))] if rng.random() < 0.06 else w for w in out]
    lead, tail = ([filler[rng.integers(len(filler))] for _ in range(int(rng.integers(0, 8)))] for _ in range(2))
    return (lead if rng.random() < 0.3 else []) + out + (tail if rng.random() < 0.4 else [])


def fit(texts: list[str], seed: int = 5) -> Model:
    """Train on the templates and on paragraphs of these texts as the unknown class."""
    rng = np.random.default_rng(seed)
    plain = [w for t in texts for line in t.encode().split(b"\n") if (w := plain_words(line))]
    # A paragraph with a key of a template may hold a notice: not a sure unknown.
    plain = [w for w in plain if pairs(w).isdisjoint(_KEYED)]
    filler = sorted({w for own in plain for w in own[:40]})[:2000] or [b"a", b"some", b"more", b"words"]
    classes = [*TEMPLATES, UNKNOWN]
    rows, labels = [], []
    for k, own in enumerate(TEMPLATES.values()):
        for t in own:
            words, n = plain_words(t.encode()), -(-WORN // len(own))
            rows += [words] * 4 + [_worn(words, filler, rng) for _ in range(n)]
            labels += [k] * (n + 4)
    unknown = [plain_words(t.encode()) for t in OTHER for _ in range(20)]
    unknown += [[w for w in plain_words(t.encode())] for t in OTHER]
    vocabulary = sorted({w for own in TEMPLATES.values() for t in own for w in plain_words(t.encode())})
    unknown += [[vocabulary[i] if rng.random() < 0.5 else filler[rng.integers(len(filler))] for i in rng.integers(len(vocabulary), size=int(rng.integers(2, 14)))] for _ in range(800)]
    unknown += [plain_words(t.encode()) + [filler[i] for i in rng.integers(len(filler), size=int(rng.integers(1, 6)))] + [b"license"] * int(rng.integers(2)) for t in CUES for _ in range(20)]
    unknown += [plain[i][:200] for i in rng.permutation(len(plain))[:1500]]
    rows += unknown
    labels += [len(classes) - 1] * len(unknown)
    labels = np.array(labels)
    # n-grams of the templates are the features: others say nothing about a family.
    known = set().union(*[grams(plain_words(t.encode())) for own in TEMPLATES.values() for t in own], *[grams(plain_words(t.encode())) for t in OTHER])
    number = {g: i for i, g in enumerate(sorted(known))}
    held = rng.random(len(rows)) < 0.25
    at = [[number[g] for g in grams(w) if g in number] for w in rows]
    weights, bias = np.zeros((len(number), len(classes))), np.zeros(len(classes))
    train = np.flatnonzero(~held)
    row = np.repeat(np.arange(len(train)), [len(at[i]) for i in train])
    feature = np.array([f for i in train for f in at[i]], np.int64)
    truth = np.eye(len(classes))[labels[train]]
    sums = np.full(weights.shape, 1e-6)
    # Sums over a row's features and over a feature's rows, both as runs in a row.
    row_at, rows_with = np.unique(row, return_index=True)[::-1]
    order = np.argsort(feature, kind="stable")
    feature_at, features_with = np.unique(feature[order], return_index=True)[::-1]
    for _ in range(ROUNDS):
        score = np.tile(bias, (len(train), 1))
        score[rows_with] += np.add.reduceat(weights[feature], row_at)
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (truth - p) / len(train)
        grad = np.zeros_like(weights)
        grad[features_with] = np.add.reduceat(error[row[order]], feature_at)
        grad -= 1e-5 * weights
        sums += grad * grad
        weights += 0.3 * grad / np.sqrt(sums)
        bias += 5.0 * error.sum(0)
    model = Model(classes, {g: weights[i] for g, i in number.items()}, bias)
    check = np.flatnonzero(held)

    def loss(t: float) -> float:
        model.temperature = t
        return -sum(float(np.log(max(model.probabilities(rows[i])[labels[i]], 1e-12))) for i in check)

    model.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    wrong = [float(model.probabilities(rows[i])[:-1].max()) for i in check if labels[i] == len(classes) - 1]
    model.threshold = max(0.5, float(np.quantile(wrong, 0.995)) if wrong else 0.5)
    return model


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit with about ``sample_rows`` rows as background: each row's hash decides, by a
    threshold that the number of rows sets, so that what the driver gets doesn't grow."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    share = min(1.0, sample_rows / max(1, rows.count()))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) <= int(share * (1 << 30))
    return fit(sorted(r["text"] for r in rows.filter(drawn).select(F.substring("text", 1, chars).alias("text")).collect()))


_COMMON = set(b"a an and any are as at be by for from if in is it may must not of on or provided shall that the this to was with you".split())


def _keys(own: set) -> list[tuple]:
    """So many of a template's pairs that a text without any of them can't confirm it: those of the rarest words."""
    missing = max(m for m in range(len(own)) if (len(own) - m) / len(own) >= MIN_SIMILARITY)
    return sorted(own, key=lambda p: (sum(w in _COMMON or w.isdigit() for w in p), -len(p[0]) - len(p[1]), p))[:missing + 1]


#: Templates (family, number) by key.
_KEYED: dict[tuple, list[tuple]] = {}
for _family, _own in _PAIRS.items():
    for _at, _template in enumerate(_own):
        for _key in _keys(_template):
            _KEYED.setdefault(_key, []).append((_family, _at))
_SIZES = {family: [len(plain_words(t.encode())) for t in texts] for family, texts in _TEXTS.items()}
#: Words within which a template's pairs must stand: twice the template's and these.
SLACK = 8
_REACH = 2 * max(n for own in _SIZES.values() for n in own) + SLACK
_WORDS = {w: i for i, w in enumerate(sorted({w for p in _KEYED for w in p}))}
_PAIR_KEYS = np.array(sorted({_WORDS[a] * len(_WORDS) + _WORDS[b] for a, b in _KEYED}), np.int64)


def _suspects(texts: list[bytes]) -> list[tuple[int, int]]:
    """(text, line) of the lines in which a key of a template stands, or begins at their end."""
    lines = [(i, k, x) for i, t in enumerate(texts) for k, x in enumerate(t.translate(_PLAIN).split(b"\n"))]
    codes, counts, words = common.word_codes([x for _, _, x in lines])
    known = np.array([_WORDS.get(w, -1) for w in words], np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(lines)), counts)
    pair = known[:-1] * len(_WORDS) + known[1:]
    hit = (known[:-1] >= 0) & (known[1:] >= 0) & (np.diff(line) <= 1) & np.isin(pair, _PAIR_KEYS)
    return [lines[j][:2] for j in np.unique(line[:-1][hit]).tolist()]


def _stretches(lines: dict, hits: list[int], last: int) -> list[tuple[int, int]]:
    """(first, last) line of the surroundings of ``hits``, up to a line without words or
    so far that no template reaches farther."""
    out = []
    for h in hits:
        ends = []
        for step in (-1, 1):
            at, n = h, 0
            while 0 <= at + step <= last and n < _REACH and lines[at + step]:
                at += step
                n += len(lines[at])
            ends.append(at)
        if out and ends[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(ends[1], out[-1][1]))
        else:
            out.append(tuple(ends))
    return out


def _windows(words: list[bytes], template: set, span: int):
    """(first, last) word of the places, not overlapping, where enough of the template's pairs stand within ``span`` words."""
    spots = [i for i, p in enumerate(zip(words, words[1:])) if p in template]
    counts, low, high = {}, 0, 0
    while high < len(spots):
        p = words[spots[high]], words[spots[high] + 1]
        counts[p] = counts.get(p, 0) + 1
        while True:  # drop what is too far back or comes again
            q = words[spots[low]], words[spots[low] + 1]
            if low == high or (spots[high] - spots[low] <= span and counts[q] == 1):
                break
            counts[q] -= 1
            if not counts[q]:
                del counts[q]
            low += 1
        if len(counts) / len(template) >= MIN_SIMILARITY:
            while high + 1 < len(spots) and spots[high + 1] - spots[high] <= 4 and spots[high + 1] - spots[low] <= span:
                high += 1
            yield spots[low], spots[high] + 1
            counts, low = {}, high + 1
        high += 1


class _Lines(dict):
    """Words of a text's lines, by number."""

    def __init__(self, text: bytes):
        super().__init__()
        self.raw = text.split(b"\n")

    def __missing__(self, k):
        self[k] = plain_words(self.raw[k])
        return self[k]


def _finds(model: Model, text: bytes, hits: list[int]) -> list[tuple]:
    """(line, what ``judge`` says) of a text's notices; ``hits`` are its lines with a key.

    A line is judged by itself, then the neighbouring lines over which the pairs of one
    template are spread: where they are found as its family, that stands in place of what
    their lines say by themselves, unless one of these says the same family.
    """
    lines = _Lines(text)
    alone = {k: found for k in hits if (found := model.judge(lines[k]))}
    spread = []
    for a, b in _stretches(lines, hits, len(lines.raw) - 1):
        if a == b:
            continue
        words, at = [w for k in range(a, b + 1) for w in lines[k]], [k for k in range(a, b + 1) for _ in lines[k]]
        for family, number in sorted({t for p in pairs(words) & _KEYED.keys() for t in _KEYED[p]}):
            size = _SIZES[family][number]
            found = [(at[x], at[y]) for x, y in _windows(words, _PAIRS[family][number], 2 * size + SLACK)]
            if family == UNKNOWN:  # what is granted may stand in the line before or after
                found = [(max(a, x - 1), min(b, y + 1)) for x, y in found]
            spread += [(family == UNKNOWN, -size, x, y, family) for x, y in found if x < y]
    joined, used = [], set()
    for unknown, _, a, b, family in sorted(spread):
        own = [alone[k][0] for k in range(a, b + 1) if k in alone]
        if not used.isdisjoint(range(a, b + 1)) or family in own or (unknown and own):
            continue
        found = model.judge([w for k in range(a, b + 1) for w in lines[k]])
        if found and found[0] == family:
            joined.append((a, *found))
            used.update(range(a, b + 1))
    return sorted(joined + [(k, *found) for k, found in alone.items() if k not in used])


def scan_texts(model: Model, texts: list[bytes]) -> list[tuple]:
    """(text, line number, family, probability, template, similarity) of all finds."""
    hits: dict[int, list[int]] = {}
    for i, k in _suspects(texts):
        hits.setdefault(i, []).append(k)
    return [(i, *found) for i, own in hits.items() for found in _finds(model, texts[i], own)]


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, paragraph, family, probability, template, similarity of every notice found."""
    shipped = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches):
        own = shipped.value
        for batch in batches:
            for part, texts in common.slices(batch):
                found = scan_texts(own, texts)
                ids = common.column(part, "doc_id").to_pylist()
                columns = [[ids[r[0]] for r in found], *[[r[c] for r in found] for c in range(1, 4)], [_TEXTS[r[2]][r[4]] for r in found], [r[5] for r in found]]
                kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["doc_id", "paragraph", "family", "probability", "template", "similarity"])

    return common.id_text(docs).mapInArrow(run, "doc_id long, paragraph int, family string, probability double, template string, similarity double")
