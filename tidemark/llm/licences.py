"""Licence scan: a paragraph classifier over word n-grams, confirmed by comparison with templates.

A text is cut into paragraphs, long ones into overlapping windows. Sparse presence features (word
n-grams of the templates) go into a multinomial logistic regression over the licence families and an
unknown class. Its probabilities are scaled on held-out examples, and a family counts only above a
limit that the held-out unknown paragraphs set. A found family is confirmed when enough word pairs of
one of its templates occur in the paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    STEP, chunks, column, mix, require, spans, text_bytes, text_hashes, widened,
)

# Wording of well-known public licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "This project is released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "This project is licensed under the MIT License",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "You should have received a copy of the GNU General Public License along with this program",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Released under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "Public-Domain": [
        "This is free and unencumbered software released into the public domain",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
        "Released into the public domain under CC0 1.0 Universal",
    ],
    "All-Rights-Reserved": [
        "All rights reserved",
        "All rights reserved. No part of this publication may be reproduced, distributed or transmitted in any "
        "form without the prior written permission of the publisher",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
    ],
}
FAMILIES = list(TEMPLATES)
UNKNOWN = len(FAMILIES)

GRAMS = 3
# Words of a window and its step, in a paragraph that is longer.
WINDOW, WINDOW_STEP = 100, 50
# Share of a template's word pairs that confirms its family.
CONFIRMED = 0.6
# Training: documents that give unknown paragraphs and the most of each; made-up examples a family.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 600, 12
EXAMPLES, MIXED = 120, 400
STEPS, RATE, PENALTY = 150, 0.1, 1e-4
# Least probability, and the share of held-out unknown paragraphs that may exceed the limit.
LEAST, FALSE_RATE = 0.5, 0.002

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;")] = True


@dataclass
class Paragraphs:
    """Words of all texts (letters and digits, A-Z as a-z): hash, paragraph, place in it; and the
    text of each paragraph."""

    words: np.ndarray
    paragraph: np.ndarray
    place: np.ndarray
    doc: np.ndarray


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> Paragraphs:
    """A paragraph ends at a blank line, or at a line that ends in one of .!?:; and at the text's end."""
    s = spans(data, offsets, _WORD[data])
    words = text_hashes(data, s, True)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(s.first))
    feeds = np.concatenate(([0], np.cumsum(data == 10)))
    line = feeds[s.starts]
    new = np.ones(len(words), bool)
    if len(words) > 1:
        step = line[1:] - line[:-1]
        # the byte before the line feed that ends the earlier word's line
        feed_at = np.flatnonzero(data == 10)
        ends = np.zeros(len(words) - 1, bool)
        broken = np.flatnonzero(step > 0)
        last = feed_at[line[:-1][broken]] - 1
        for _ in range(2):  # a carriage return or blank before the line feed
            last = np.where((data[last] == 13) | (data[last] == 32), last - 1, last)
        ends[broken] = _END[data[last]]
        new[1:] = (doc[1:] != doc[:-1]) | (step > 1) | ends
    paragraph = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    place = np.arange(len(words)) - begin[paragraph] if len(words) else paragraph
    return Paragraphs(words, paragraph, place, doc[begin])


def grams(p: Paragraphs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the first word, hash) of all n-grams of 1 to GRAMS words inside a paragraph."""
    for n in range(1, GRAMS + 1):
        count = max(0, len(p.words) - n + 1)
        inside = p.paragraph[:count] == p.paragraph[n - 1 : n - 1 + count]
        at = np.flatnonzero(inside)
        value = np.full(len(at), np.uint64(n))
        for k in range(n):
            value = value * STEP[4] + p.words[at + k]
        yield at, mix(value)


def windows(p: Paragraphs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of windows of each paragraph, of the first window of each, and the text of each window."""
    length = np.bincount(p.paragraph, minlength=len(p.doc))
    count = np.where(length > WINDOW, -(-(length - WINDOW) // WINDOW_STEP) + 1, 1)
    return count, np.cumsum(count) - count, np.repeat(p.doc, count)


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted hashes of n-grams
    weights: np.ndarray  # n-gram x class
    bias: np.ndarray
    scale: float
    limit: float
    templates: list[tuple[int, np.ndarray]]  # family and its word pairs' places in the vocabulary
    owned: list[np.ndarray]  # of each family, the places of all n-grams of its templates

    def hits(self, p: Paragraphs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different (window, n-gram) pairs, and the text of every window."""
        count, first, doc = windows(p)
        found_w, found_f = [], []
        for at, value in grams(p):
            if not len(self.vocabulary):
                break
            near = np.minimum(np.searchsorted(self.vocabulary, value), len(self.vocabulary) - 1)
            hit = self.vocabulary[near] == value
            at, feature = at[hit], near[hit]
            own = p.paragraph[at]
            k = p.place[at] // WINDOW_STEP
            for back in (0, 1):  # a word lies in at most two windows
                w = k - back
                ok = (w >= 0) & (w < count[own])
                ok &= (p.place[at] < w * WINDOW_STEP + WINDOW)
                found_w.append((first[own] + w)[ok])
                found_f.append(feature[ok])
        w, f = np.concatenate(found_w or [np.zeros(0, int)]), np.concatenate(found_f or [np.zeros(0, int)])
        pairs = np.unique(w.astype(np.int64) * (len(self.vocabulary) + 1) + f)
        return pairs // (len(self.vocabulary) + 1), pairs % (len(self.vocabulary) + 1), doc

    def probabilities(self, w: np.ndarray, f: np.ndarray, n: int) -> np.ndarray:
        logits = np.tile(self.bias, (n, 1))
        np.add.at(logits, w, self.weights[f])
        return _softmax(logits * self.scale)

    def similarity(self, features: np.ndarray, family: int) -> float:
        """Largest share of a template's word pairs among the features."""
        return max((np.isin(t, features).mean() for k, t in self.templates if k == family and len(t)), default=0.0)

    def further(self, features: np.ndarray, family: int) -> Iterator[tuple[int, float]]:
        """More families of a window where `family` is confirmed, and their similarities: the window is
        classified again without the n-grams of the families found so far."""
        left = features
        for _ in range(UNKNOWN):
            left = left[~np.isin(left, self.owned[family])]
            if not len(left):
                return
            p = self.probabilities(np.zeros(len(left), int), left, 1)[0]
            family = int(p.argmax())
            share = self.similarity(features, family) if family != UNKNOWN and p[family] >= self.limit else 0.0
            if share < CONFIRMED:
                return
            yield family, share


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _read(texts: list[str]) -> Paragraphs:
    """Each text as one paragraph."""
    flat = pa.array([" ".join(t.split()) for t in texts], pa.large_string())
    p = paragraphs(*text_bytes(flat))
    doc = p.doc[p.paragraph] if len(p.doc) else p.paragraph
    begin = np.searchsorted(doc, np.arange(len(texts)))
    return Paragraphs(p.words, doc, np.arange(len(doc)) - begin[doc], np.arange(len(texts)))


def examples(rng: np.random.Generator, noise: list[str]) -> tuple[list[str], list[int]]:
    """Made-up paragraphs: stretches of templates with words lost and prose around, and, for the
    unknown class, words of all templates in random order."""
    texts, labels = [], []
    every = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    prose = noise or ["text"]
    for k, family in enumerate(FAMILIES):
        for i in range(EXAMPLES):
            words = TEMPLATES[family][i % len(TEMPLATES[family])].split()
            if i >= 2 * len(TEMPLATES[family]):
                size = max(min(4, len(words)), int(len(words) * rng.uniform(0.6, 1)))
                at = int(rng.integers(0, len(words) - size + 1))
                words = [w for w in words[at : at + size] if len(words) < 6 or rng.random() > 0.08]
            around = [str(rng.choice(prose)) for _ in range(int(rng.integers(0, 12)))]
            cut = int(rng.integers(0, len(around) + 1))
            texts.append(" ".join([*around[:cut], *words, *around[cut:]]))
            labels.append(k)
    for _ in range(MIXED):
        size = int(rng.integers(3, 12))
        words = [str(rng.choice(every)) if rng.random() < 0.5 else str(rng.choice(prose)) for _ in range(size)]
        texts.append(" ".join(words))
        labels.append(UNKNOWN)
    return texts, labels


def train(unknown: list[str], seed: int = 5) -> Model:
    """Fit on made-up examples and sampled paragraphs; the same sample gives the same model.

    Sampled paragraphs that would confirm a family by their word pairs are not used as unknown.
    Single words that occur in the sample are no features.
    """
    rng = np.random.default_rng(seed)
    flat = [(k, t) for k, family in enumerate(FAMILIES) for t in TEMPLATES[family]]
    p = _read([t for _, t in flat])
    by_n = list(grams(p))
    common = np.unique(_read(unknown).words) if unknown else np.zeros(0, np.uint64)
    single = by_n[0][1][~np.isin(p.words, common)]
    vocabulary = np.unique(np.concatenate([single, *(v for _, v in by_n[1:])]))
    pairs_at, pairs = by_n[1]
    templates = []
    for i, (k, _) in enumerate(flat):
        mine = np.unique(pairs[p.paragraph[pairs_at] == i])
        templates.append((k, np.searchsorted(vocabulary, mine)))
    family_of = np.array([k for k, _ in flat])
    owned = []
    for k in range(len(FAMILIES)):
        mine = np.unique(np.concatenate([v[family_of[p.paragraph[at]] == k] for at, v in by_n]))
        owned.append(np.flatnonzero(np.isin(vocabulary, mine)))
    classes = len(FAMILIES) + 1
    model = Model(vocabulary, np.zeros((len(vocabulary), classes)), np.zeros(classes), 1.0, LEAST, templates, owned)

    clean = []
    if unknown:
        w, f, doc = model.hits(_read(unknown))
        edges = np.searchsorted(w, np.arange(len(doc) + 1))
        suspect = {
            doc[i] for i in range(len(doc)) if edges[i + 1] - edges[i] > 1
            and any(model.similarity(f[edges[i] : edges[i + 1]], k) >= CONFIRMED for k in range(UNKNOWN))
        }
        clean = [t for i, t in enumerate(unknown) if i not in suspect]
    noise = [x for t in clean[:200] for x in t.split()[:20]]
    texts, labels = examples(rng, noise)
    texts, labels = texts + clean, np.array(labels + [UNKNOWN] * len(clean))
    w, f, doc = model.hits(_read(texts))
    x = np.zeros((len(texts), len(vocabulary)), np.float32)
    x[doc[w], f] = 1
    y = np.eye(classes, dtype=np.float32)[labels]
    held = rng.random(len(texts)) < 0.3
    xt, yt = x[~held], y[~held]
    weights, bias = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for t in range(1, STEPS + 1):
        error = (_softmax(xt @ weights + bias) - yt) / max(1, len(xt))
        for p_, g, m, v in ((weights, xt.T @ error + PENALTY * weights, *moments[:2]), (bias, error.sum(axis=0), *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p_ -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    model.weights, model.bias = weights.astype(float), bias.astype(float)
    logits = x[held] @ model.weights + model.bias
    scales = np.geomspace(0.1, 3, 30)
    loss = [
        -np.log(np.maximum((_softmax(logits * s) * y[held]).sum(axis=1), 1e-12)).mean() if held.any() else 0
        for s in scales
    ]
    model.scale = float(scales[int(np.argmin(loss))]) if held.any() else 1.0
    wrong = _softmax(logits * model.scale)[labels[held] == UNKNOWN][:, :UNKNOWN]
    if len(wrong):
        model.limit = float(max(LEAST, np.quantile(wrong.max(axis=1), 1 - FALSE_RATE)))
    return model


def sample_paragraphs(docs: DataFrame, id: str, text: str) -> list[str]:
    """At most SAMPLE_DOCS x SAMPLE_PARAGRAPHS paragraphs, of the documents least by a hash of the id,
    evenly spread over each text, and at most WINDOW words of each; of the texts of a repeated id
    the one of least hash is taken."""
    ids = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("id")).distinct()
    ids = ids.orderBy(F.xxhash64(F.lit("licence"), F.col("id")), "id").limit(SAMPLE_DOCS)
    found = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(ids), "id", "left_semi")
    found = found.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in column(batch, "text").to_pylist():
                parts = [x for x in (t or "").split("\n") if x.strip()]
                for i in np.unique(np.linspace(0, len(parts) - 1, min(SAMPLE_PARAGRAPHS, len(parts))).round().astype(int)) if parts else []:
                    out.append(" ".join(parts[i].split()[:WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["paragraph"])

    return sorted(r[0] for r in found.select("text").mapInArrow(run, "paragraph string").collect())


RESULT = "n_paragraphs bigint, licences string, unconfirmed string, probability double, similarity double"


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace the text by what the scan of all of it finds.

    n_paragraphs; licences: confirmed families, sorted, joined by commas; unconfirmed: families that
    were only predicted; probability: the highest of any family in any window; similarity: the
    best template share of a predicted family, 0 without one. Null, empty and wordless texts have no
    paragraph, no family and the probability 0. Every row gives one row; other columns stay.
    """
    require(docs, text)
    rest = docs.drop(text)
    schema = widened(rest, RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, b in chunks(column(batch, text)):
                part = batch.slice(a, b - a)
                extra = scan_texts(m, column(part, text))
                part = part.remove_column(part.schema.get_field_index(text))
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[*part.schema.names, *(f.split()[0] for f in RESULT.split(", "))])

    return docs.select(*(F.col(f"`{c}`") for c in rest.columns), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def scan_texts(m: Model, texts: pa.Array) -> list[pa.Array]:
    p = paragraphs(*text_bytes(texts))
    n = len(texts)
    w, f, doc = m.hits(p)
    used, row = np.unique(w, return_inverse=True)
    probability = m.probabilities(row, f, len(used))
    best = probability[:, :UNKNOWN].argmax(axis=1) if len(used) else np.zeros(0, int)
    value = probability[np.arange(len(used)), best] if len(used) else np.zeros(0)
    top = np.zeros(n)
    silent = _softmax(m.bias[None, :] * m.scale)[0, :UNKNOWN].max()  # of a window without any n-gram
    top[np.unique(p.doc)] = silent
    np.maximum.at(top, doc[used], value)
    confirmed: list[set[str]] = [set() for _ in range(n)]
    predicted: list[set[str]] = [set() for _ in range(n)]
    alike = np.zeros(n)
    edges = np.searchsorted(row, np.arange(len(used) + 1))
    chosen = (value >= m.limit) & (probability.argmax(axis=1) != UNKNOWN) if len(used) else np.zeros(0, bool)
    for i in np.flatnonzero(chosen):
        d, family = doc[used[i]], int(best[i])
        share = m.similarity(f[edges[i] : edges[i + 1]], family)
        alike[d] = max(alike[d], share)
        (confirmed if share >= CONFIRMED else predicted)[d].add(FAMILIES[family])
        if share >= CONFIRMED:
            for other, share in m.further(f[edges[i] : edges[i + 1]], family):
                alike[d] = max(alike[d], share)
                confirmed[d].add(FAMILIES[other])
    return [
        pa.array(np.bincount(p.doc, minlength=n), pa.int64()),
        pa.array([",".join(sorted(x)) for x in confirmed], pa.string()),
        pa.array([",".join(sorted(y - x)) for x, y in zip(confirmed, predicted, strict=True)], pa.string()),
        pa.array(top), pa.array(alike),
    ]


def report(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text")
    return scan(slim, train(sample_paragraphs(slim, "doc_id", "text")))
