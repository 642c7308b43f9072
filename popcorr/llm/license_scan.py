"""Licence scans: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a line, or a wrapped notice: lines one after the other, without an
empty one between, that mostly hold word pairs of the templates (``LIKE``) and are
no notice each alone; they are joined, and numbered as their first line.  Marks of
comments are no words and so fall away.  A paragraph's features are the word 1- to 3-grams that occur in
the training paragraphs (a sparse vector, scaled by the root of its words), and
a multinomial logistic regression gives a probability per licence family and
for the unknown class.  Training paragraphs are the templates with words left
out, cut short and surrounded by other words; unknown ones are paragraphs of at
most ``SAMPLE_DOCS`` documents (a documented bound on the labelled sample).

Calibration: a quarter of the training paragraphs is kept back; a temperature
is fitted to it, and a paragraph counts as a family only if the family's
probability exceeds that of ``UNKNOWN_QUANTILE`` of the unknown ones there.
Confirmation: the share of a template line's word pairs that the paragraph has
(``CONFIRM``), and the words that name the licence in that line (``NAMES``) stand in
the paragraph one after the other, so "CC BY-SA 4.0" is not "CC BY 4.0"; a predicted family without it is reported, not confirmed.

The model (some thousand n-grams x families) is broadcast; all paragraphs of
all documents are scanned in a narrow pass.  Null and empty texts have no
licence.  Repeated rows have equal results; equal probabilities go to the
family that is first by name.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T

# Short public notices and lines of well-known licences, by family.
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "This document is confidential and proprietary and may not be reproduced or distributed without prior written permission.",
    ],
}
#: Words that name a family; a template's own ones must all stand in a paragraph that it confirms.
NAMES = {
    "AGPL-3.0": ["gnu affero general public license", "version 3", "agpl 3 0"],
    "Apache-2.0": ["apache license", "version 2 0", "license 2 0", "apache 2 0"],
    "BSD": ["bsd license", "bsd 3 clause"],
    "CC-BY": ["cc by 4 0", "attribution 4 0"],
    "CC-BY-NC": ["cc by nc 4 0", "attribution noncommercial 4 0"],
    "CC-BY-NC-ND": ["cc by nc nd 4 0", "attribution noncommercial noderivatives 4 0"],
    "CC-BY-NC-SA": ["cc by nc sa 4 0", "attribution noncommercial sharealike 4 0"],
    "CC-BY-ND": ["cc by nd 4 0", "attribution noderivatives 4 0"],
    "CC-BY-SA": ["cc by sa 4 0", "attribution sharealike 4 0"],
    "GPL-2.0": ["gnu general public license", "version 2", "gpl 2 0"],
    "GPL-3.0": ["gnu general public license", "version 3", "gpl 3 0"],
    "LGPL": ["gnu lesser general public license"],
    "MIT": ["mit license", "identifier mit"],
    "MPL-2.0": ["mozilla public license", "v 2 0", "mpl 2 0"],
}
UNKNOWN = "unknown"
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]
SAMPLE_DOCS, SAMPLE_PARAGRAPHS, VARIANTS = 400, 6000, 40
UNKNOWN_QUANTILE, CONFIRM = 0.999, 0.6
#: Share of a wrapped notice's line that is word pairs of templates.
LIKE = 0.3
GRAMS, EPOCHS, RATE, DECAY = 3, 150, 0.5, 1e-4


def paragraph_grams(data: np.ndarray, offsets: np.ndarray):
    """(document of each paragraph, its first byte, end byte, words; then for each gram its hash, size and paragraph).

    ``offsets`` are the documents' bounds; a paragraph ends at a line feed or a document's end.
    """
    cuts = np.flatnonzero(data == 10) + 1
    bounds = np.unique(np.concatenate((offsets, cuts)))
    begin, end = bounds[:-1], bounds[1:]
    doc = np.searchsorted(offsets, begin, "right") - 1
    starts, ends, _ = T.word_spans(data, offsets, T.NOT_WORD)
    hashes = T.span_hashes(T.LOWER[data], starts, ends)
    para = np.searchsorted(bounds, starts, "right") - 1
    n = np.bincount(para, minlength=len(begin))
    grams = []
    for k in range(1, GRAMS + 1):
        g = T.run_hashes(hashes, k)
        same = np.flatnonzero(para[:len(g)] == para[k - 1:k - 1 + len(g)])
        grams.append((g[same], para[same], k))
    return doc, begin, end, n, grams


class Model:
    """Known n-grams (sorted hashes), a weight per family for each, biases, temperature and threshold."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0, threshold: float = 0.5):
        self.grams, self.weights, self.bias = grams, weights, bias
        self.temperature, self.threshold = temperature, threshold
        self.templates = _templates()
        self.pairs = np.array(sorted(set().union(*(t for _, t, _ in self.templates))), T.U64)

    def lookup(self, g: np.ndarray) -> np.ndarray:
        """Number of each gram, -1 if not known."""
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        return np.where(self.grams[at] == g, at, -1)

    def logits(self, n: np.ndarray, grams) -> np.ndarray:
        out = np.zeros((len(n), len(self.bias)))
        for g, para, _ in grams:
            at = self.lookup(g)
            hit = at >= 0
            for k in range(len(self.bias)):
                out[:, k] += np.bincount(para[hit], weights=self.weights[at[hit], k], minlength=len(n))
        return out / np.sqrt(np.maximum(n, 1))[:, None] + self.bias

    def confirm(self, line: str, family: int) -> float:
        """Greatest share of a template line's word pairs, over the family's lines whose naming words the paragraph has, that the paragraph has."""
        return max((near for f, near in comparisons(line, self.templates) if f == family), default=0.0)

    def wrapped(self, lines: list[str]) -> list[tuple[int, int, int, float, float, str]]:
        """(first line, last line + 1, family, probability, similarity, text) of the notices wrapped over ``lines``."""
        out, taken = [], set()
        for near, lo, hi, family in notices(lines, self.templates):
            if taken & set(range(lo, hi)):
                continue
            text = " ".join(lines[lo:hi])
            raw = np.frombuffer(text.encode(), np.uint8)
            _, _, _, n, grams = paragraph_grams(raw, np.array([0, len(raw)]))
            p = softmax(self.logits(n, grams) / self.temperature)[0]
            if p[:-1].argmax() == family and p[family] > self.threshold:
                out.append((lo, hi, family, float(p[family]), near, text))
                taken |= set(range(lo, hi))
        return out


def _plain(line: str) -> str:
    return " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", line.lower())) + " "


def _templates() -> list[tuple[int, set[int], list[str]]]:
    """(family, word pairs, naming words) of every template line."""
    return [(FAMILIES.index(f), _pairs(line), [f" {x} " for x in NAMES.get(f, []) if f" {x} " in _plain(line)])
            for f in sorted(TEMPLATES) for line in TEMPLATES[f]]


def comparisons(line: str, templates) -> list[tuple[int, float]]:
    """(family, share of its word pairs) of every template whose naming words ``line`` has."""
    have, plain = _pairs(line), _plain(line)
    return [(f, len(have & t) / len(t)) for f, t, names in templates if all(x in plain for x in names)]


def notices(lines: list[str], templates) -> list[tuple[float, int, int, int]]:
    """(similarity, first line, last line + 1, family) of runs of ``lines`` that, joined, a template confirms; the most alike first."""
    own = [_pairs(line) for line in lines]
    found = []

    def share(lo: int, hi: int, family: int) -> float:
        return max((x for k, x in comparisons(" ".join(lines[lo:hi]), templates) if k == family), default=0.0)

    for f, t, _ in templates:
        has = [bool(x & t) for x in own]
        at = 0
        while at < len(lines):                           # runs of lines that the template has a part in; a line of one word is in between
            stop = at
            while stop < len(lines) and (has[stop] or (stop > at and len(lines[stop].split()) < 2)):
                stop += 1
            lo, hi = at, stop
            near = share(lo, hi, f) if hi - lo > 1 else 0.0
            if near >= CONFIRM:                          # without lines at the ends that add nothing
                while hi - lo > 1 and share(lo + 1, hi, f) >= near:
                    lo += 1
                while hi - lo > 1 and share(lo, hi - 1, f) >= near:
                    hi -= 1
                found.append((near, lo, hi, f))
            at = stop + 1
    return sorted(found, key=lambda x: (-x[0], x[2] - x[1], x[1:]))


def like_lines(n: np.ndarray, grams, pairs: np.ndarray) -> np.ndarray:
    """Lines whose word pairs are the templates' for a good part, and lines of one word."""
    g, para, _ = grams[1]
    all_pairs = np.bincount(para, minlength=len(n))
    known = np.bincount(para[np.isin(g, pairs)], minlength=len(n))
    return (known > 0) & (known >= LIKE * all_pairs) | (n == 1)


def runs_of(mark: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """(first, last + 1) of the runs of two or more marked lines of one document."""
    at = np.flatnonzero(mark)
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc[at]) != 0)) + 1
    return [(int(r[0]), int(r[-1]) + 1) for r in np.split(at, cut) if len(r) > 1]


def _pairs(line: str) -> set[int]:
    raw = np.frombuffer(line.encode(), np.uint8)
    w, _ = T.words(raw, np.array([0, len(raw)]), T.NOT_WORD)
    return {int(x) for x in T.run_hashes(w, min(2, max(1, len(w))))}


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _wrapped_lines(text: str, templates) -> list[str]:
    """The lines of ``text`` that are part of a wrapped notice."""
    raw = np.frombuffer(text.encode(), np.uint8)
    doc, begin, end, n, grams = paragraph_grams(raw, np.array([0, len(raw)]))
    pairs = np.array(sorted(set().union(*(t for _, t, _ in templates))), T.U64)
    out, mark = [], like_lines(n, grams, pairs)
    every = [raw[a:b].tobytes().decode().rstrip("\n") for a, b in zip(begin, end)]
    for i in np.flatnonzero(mark):
        mark[i] = not any(near >= CONFIRM for _, near in comparisons(every[i], templates))
    for a, b in runs_of(mark, doc):
        lines = every[a:b]
        out += [x for _, lo, hi, _ in notices(lines, templates) for x in lines[lo:hi]]
    return out


def training_paragraphs(texts: list[str | None], seed: int = 11) -> tuple[list[str], np.ndarray]:
    """Paragraphs and their classes: variants of the templates, and unknown ones from ``texts``."""
    rng = np.random.default_rng(seed)
    templates = _templates()
    wrapped = {p for t in texts if t for p in _wrapped_lines(t, templates)}
    other = sorted({p for t in texts if t for p in t.split("\n") if p.strip()} - wrapped)
    other = [other[i] for i in rng.permutation(len(other))[:SAMPLE_PARAGRAPHS]]
    other = [p for p in other if not any(near >= CONFIRM for _, near in comparisons(p, templates))]
    filler = [w for p in other[:500] for w in p.split()] or ["text"]
    lines, label = list(other), [len(FAMILIES) - 1] * len(other)
    for k, family in enumerate(FAMILIES[:-1]):
        for line in TEMPLATES[family]:
            words = line.split()
            for v in range(VARIANTS):
                own = list(words)
                if v % 4 == 1:                                             # a word lost
                    own.pop(int(rng.integers(len(own)))) if len(own) > 3 else None
                if v % 4 == 2:                                             # prose around it
                    a = [filler[i] for i in rng.integers(0, len(filler), int(rng.integers(1, 12)))]
                    own = a + own if v % 8 == 2 else own + a
                if v % 4 == 3 and len(own) > 12:                           # cut short
                    own = own[:int(rng.integers(10, len(own)))]
                lines.append(" ".join(own))
                label.append(k)
            if len(words) > 3:                                             # single words of it, among others, are unknown
                for _ in range(VARIANTS // 4):
                    own = [filler[i] for i in rng.integers(0, len(filler), 9)]
                    own.insert(int(rng.integers(len(own))), words[int(rng.integers(len(words)))])
                    lines.append(" ".join(own))
                    label.append(len(FAMILIES) - 1)
    return lines, np.array(label)


def fit(texts: list[str | None], seed: int = 11) -> Model:
    """Fit, calibrate and set the threshold on the paragraphs of a bounded sample of texts."""
    lines, label = training_paragraphs(texts, seed)
    joined = [line.replace("\n", " ") for line in lines]
    raw = "".join(joined).encode()
    offsets = np.concatenate(([0], np.cumsum([len(x.encode()) for x in joined])))
    _, _, _, n, grams = paragraph_grams(np.frombuffer(raw, np.uint8), offsets)
    rng = np.random.default_rng(seed + 1)
    held = rng.random(len(lines)) < 0.25
    marked = [g[label[para] < len(FAMILIES) - 1] for g, para, _ in grams]
    common = np.unique(grams[0][0], return_counts=True)
    known = np.unique(np.concatenate([*marked, common[0][common[1] >= 5]]))
    model = Model(known, np.zeros((len(known), len(FAMILIES))), np.zeros(len(FAMILIES)))
    rows = np.concatenate([p for _, p, _ in grams])
    cols = model.lookup(np.concatenate([g for g, _, _ in grams]))
    keep = (cols >= 0) & ~held[rows]
    rows, cols = rows[keep], cols[keep]
    scale = 1 / np.sqrt(np.maximum(n, 1))
    want = np.eye(len(FAMILIES))[label]
    balance = (~held) / np.maximum(np.bincount(label[~held], minlength=len(FAMILIES)), 1)[label]
    balance[label == len(FAMILIES) - 1] *= 4
    balance /= balance.sum()
    speed = [np.zeros_like(model.weights), np.zeros_like(model.bias)]
    for _ in range(EPOCHS):
        z = model.bias + np.stack([np.bincount(rows, model.weights[cols, k] * scale[rows], len(lines)) for k in range(len(FAMILIES))], 1)
        d = (softmax(z) - want) * balance[:, None]
        grad = np.stack([np.bincount(cols, d[rows, k] * scale[rows], len(known)) for k in range(len(FAMILIES))], 1)
        for s, a, g in ((speed[0], model.weights, grad + DECAY * model.weights), (speed[1], model.bias, d.sum(0))):
            s *= 0.9
            s -= RATE * 10 * g
            a += s
    z = model.logits(n, grams)[held]
    truth = label[held]
    heats = np.geomspace(0.2, 5, 25)
    loss = [-np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean() for t in heats]
    model.temperature = float(heats[int(np.argmin(loss))])
    p = softmax(z / model.temperature)
    unknown = p[truth == len(FAMILIES) - 1][:, :-1].max(axis=1)
    model.threshold = float(max(0.5, np.quantile(unknown, UNKNOWN_QUANTILE))) if len(unknown) else 0.5
    return model


def sample_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SAMPLE_DOCS) -> list[str | None]:
    """At most ``n`` texts, chosen by a hash of id and text, for the unknown class.

    The rows are counted first and a share of them that gives about 1.5 x ``n`` is
    filtered out by the hash in the scan, so the tasks together hand on that many
    texts, however many tasks there are; of these the least by hash are taken.
    """
    rows = docs.select(F.col(text_col).alias("t"), F.xxhash64(id_col, text_col).alias("h")).where("t is not null")
    share = min(1.0, 1.5 * n / max(1, rows.count()))
    place = F.shiftrightunsigned("h", 11).cast("double") / F.lit(float(1 << 53))
    return [r[0] for r in rows.where(place < share).orderBy("h", "t").limit(n).collect()]


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_paragraphs and ``found``, an array of its licence paragraphs in order
    (paragraph from 0, family, probability, similarity, confirmed, text)."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((model.grams, model.weights, model.bias, model.temperature, model.threshold))
    item = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
                      ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in batches:
            paragraphs, found = np.zeros(b.num_rows, np.int32), [[] for _ in range(b.num_rows)]
            for start, stop, data, offsets in T.slices(b.column(1)):
                if not len(data):
                    continue
                doc, begin, end, n, grams = paragraph_grams(data, offsets)
                paragraphs[start:stop] += np.bincount(doc, minlength=stop - start).astype(np.int32)
                first = np.searchsorted(doc, np.arange(stop - start))
                p = softmax(m.logits(n, grams) / m.temperature)
                best = p[:, :-1].argmax(axis=1)
                top = p[np.arange(len(best)), best]
                alone = np.zeros(len(n), bool)

                def text_of(i, data=data, begin=begin, end=end):
                    return data[begin[i]:end[i]].tobytes().decode().rstrip("\n")

                for i in np.flatnonzero((top > m.threshold) & (n > 0)):
                    line = text_of(i)
                    near = m.confirm(line, int(best[i]))
                    alone[i] = near >= CONFIRM
                    found[start + doc[i]].append((int(i - first[doc[i]]), FAMILIES[best[i]], float(top[i]), near, near >= CONFIRM, line))
                for a, z in runs_of(like_lines(n, grams, m.pairs) & ~alone, doc):
                    row, zero = start + doc[a], a - int(first[doc[a]])
                    for lo, hi, family, prob, near, text in m.wrapped([text_of(i) for i in range(a, z)]):
                        found[row] = sorted([x for x in found[row] if not zero + lo <= x[0] < zero + hi]
                                            + [(zero + lo, FAMILIES[family], prob, near, True, text)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(paragraphs),
                 pa.array([[dict(zip(("paragraph", "family", "probability", "similarity", "confirmed", "text"), f)) for f in x] for x in found],
                          pa.list_(item))], ["id", "n_paragraphs", "found"])

    kind = thin.schema["id"].dataType.simpleString()
    out = thin.mapInArrow(run, f"id {kind}, n_paragraphs int, found array<struct<paragraph:int,family:string,probability:double,"
                               "similarity:double,confirmed:boolean,text:string>>")
    return out.withColumnRenamed("id", id_col)
