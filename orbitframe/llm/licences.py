"""Licence scans by a trained paragraph classifier, confirmed by template comparison.

A multinomial logistic regression over sparse word n-grams (one and two words) is fitted
on variants of known notices (words dropped, holders and years exchanged, other text
around) for each licence family, and on an unknown class: prose that speaks of licences,
and the notices' own words out of order. Probabilities are calibrated on a third of the
variants that the fit doesn't see: a temperature is chosen by likelihood, then the least
probability at which at most FALSE_SHARE of the unknown ones pass. What stays below is unknown.

Line breaks only part words, so notices may be wrapped. In the words of every whole text, a
template is confirmed where at least CONFIRM of its pairs of neighbouring content words stand
within WINDOW words. Each such stretch, cut to its first and last pair, is classified by itself, and
counts if the predicted family is the template's, so notices side by side are each
reported. Where templates of two families hold the same words (half of a stretch's pairs), the
larger share of a template wins. Machine-readable tags (SPDX) name their licence and are reported beside
the notices. As a stretch takes CONTENT_WORDS distinct content words of the
templates, texts with fewer are skipped without changing any result.

Null texts count as empty, without spans; rows of a repeated or null doc_id are each
scanned; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import clean_text, ship_texts, small

WINDOW, CONFIRM, CONTENT_WORDS = 64, 0.7, 3
FALSE_SHARE, VARIANTS, ROUNDS = 0.002, 40, 400
_WORD = re.compile(r"[a-z0-9]+")
STOP = frozenset("a an and any are as at be by for from in is it of on or that the this to under with".split()) - {"under"}

#: Notices by licence family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "PublicDomain": (
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "Proprietary": (
        "Copyright 2020 Example Corporation. All rights reserved. Proprietary and confidential.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
#: Names that a licence tag gives a family by.
TAGS = {
    "MIT": ("MIT",), "Apache": ("Apache-2.0",), "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"), "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only"),
    "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "MPL": ("MPL-2.0",), "CC-BY": ("CC-BY-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",), "PublicDomain": ("CC0-1.0", "Unlicense"),
}
FAMILY_OF = {tag.lower(): family for family, tags in TAGS.items() for tag in tags}
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+)")
#: Prose that is no notice.
PROSE = (
    "you need a driving license to rent a car in most countries",
    "the council may grant or revoke the license of a restaurant",
    "the apache people lived in the southwest and the general spoke to the public",
    "the warranty covers parts but not labour and any person may ask for a copy",
    "she studied at mit and released a software version under pressure",
    "the public library is free of charge and open to any person",
    "creative people share their work and the foundation published the terms",
    "all rights and duties of the members are listed in the following conditions",
    "the source of the river is subject to change without notice",
    "version 3 of the report was published under the title public works",
)
HOLDERS = ("Acme", "the authors", "Jane Doe", "Example Org", "its contributors")
FILLER = ("tion", "lor", "onen", "eau", "schen", "dove", "river", "note", "house", "seven", "blue", "walk")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pairs(found: list[str]) -> set[tuple[str, str]]:
    """Neighbouring content words."""
    content = [w for w in found if w not in STOP]
    return set(zip(content, content[1:]))


def grams(found: list[str]) -> set[str]:
    return set(found) | {f"{a} {b}" for a, b in zip(found, found[1:])}


TEMPLATE_PAIRS = {f: [pairs(words(t)) for t in ts] for f, ts in TEMPLATES.items()}
#: Templates (family, number) that hold a pair.
HOLDERS_OF: dict[tuple[str, str], list[tuple[str, int]]] = {}
for _family, _templates in TEMPLATE_PAIRS.items():
    for _k, _pairs in enumerate(_templates):
        for _pair in _pairs:
            HOLDERS_OF.setdefault(_pair, []).append((_family, _k))
#: Content words of all templates.
CONTENT = frozenset(w for ts in TEMPLATES.values() for t in ts for w in words(t) if w not in STOP)


def variants(rng: np.random.Generator) -> tuple[list[list[str]], np.ndarray]:
    """Training lines as words, with their class: 0 unknown, else the family's number."""
    lines, classes = [], []
    vocabulary = sorted({w for ts in TEMPLATES.values() for t in ts for w in words(t)})
    around = lambda: [str(w) for w in rng.choice(FILLER, rng.integers(0, 12))]
    for c, ts in enumerate(TEMPLATES.values(), 1):
        for template in ts:
            for _ in range(VARIANTS):
                line = [w for w in words(template) if rng.random() > 0.05]
                if rng.random() < 0.3:
                    line = ["copyright", str(rng.integers(1990, 2026)), *words(str(rng.choice(HOLDERS))), *line]
                lines.append(around() + line + around())
                classes.append(c)
            for _ in range(VARIANTS // 2):
                line = words(template)
                rng.shuffle(line)
                lines.append(around() + line[: max(2, len(line) // 2)] + around())
                classes.append(0)
    for prose in PROSE:
        for _ in range(VARIANTS):
            lines.append(around() + [w for w in words(prose) if rng.random() > 0.1] + around())
            classes.append(0)
    for _ in range(VARIANTS * 10):
        lines.append(around() + [str(w) for w in rng.choice(vocabulary, rng.integers(1, 14))] + around())
        classes.append(0)
    return lines, np.array(classes)


@dataclass
class Classifier:
    """Weights (n-gram, class), the calibrated temperature and the least probability of a known class."""

    index: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.5
    families: list[str] = field(default_factory=lambda: list(TEMPLATES))

    def logits(self, lines: list[list[str]]) -> np.ndarray:
        out = np.tile(self.bias, (len(lines), 1))
        for i, line in enumerate(lines):
            at = [self.index[g] for g in grams(line) if g in self.index]
            out[i] += self.weights[at].sum(axis=0)
        return out

    def probabilities(self, lines: list[list[str]]) -> np.ndarray:
        return softmax(self.logits(lines) / self.temperature)

    def predict(self, line: list[str]) -> tuple[str | None, float]:
        """Family and probability of a window, None for the unknown class."""
        p = self.probabilities([line])[0]
        best = int(p.argmax())
        if best == 0 or p[best] < self.least:
            return None, float(p[0])
        return self.families[best - 1], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(seed: int = 11) -> Classifier:
    """Fits and calibrates the classifier; the same seed gives the same one."""
    rng = np.random.default_rng(seed)
    lines, classes = variants(rng)
    allowed = sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(words(t))} | {g for p in PROSE for g in grams(words(p))})
    index = {g: i for i, g in enumerate(allowed)}
    features = np.zeros((len(lines), len(index)), np.float32)
    for i, line in enumerate(lines):
        features[i, [index[g] for g in grams(line) if g in index]] = 1
    held = rng.random(len(lines)) < 1 / 3
    x, y = features[~held], np.eye(len(TEMPLATES) + 1, dtype=np.float32)[classes[~held]]
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    fast_w, fast_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(ROUNDS):
        error = (softmax(x @ w + b) - y) / len(x)
        fast_w = 0.9 * fast_w - 1.5 * (x.T @ error + 1e-5 * w)
        fast_b = 0.9 * fast_b - 1.5 * error.sum(axis=0)
        w, b = w + fast_w, b + fast_b
    model = Classifier(index, w.astype(np.float64), b.astype(np.float64))
    logits, truth = features[held] @ model.weights + model.bias, classes[held]
    each = np.arange(len(truth))
    model.temperature = min((float(t) for t in np.geomspace(0.25, 4, 33)), key=lambda t: -np.log(softmax(logits / t)[each, truth] + 1e-12).mean())
    unknown = softmax(logits[truth == 0] / model.temperature)[:, 1:].max(axis=1)
    model.least = max(0.5, float(np.quantile(unknown, 1 - FALSE_SHARE, method="higher")))
    return model


def lowered(text: str) -> tuple[str, list[int] | None]:
    """The lower-case text, and the place in the text of each of its characters where they differ."""
    low = text.lower()
    return low, None if len(low) == len(text) else [i for i, c in enumerate(text) for _ in c.lower()]


def stretches(found: list[str]) -> list[tuple[int, int, str, set[int]]]:
    """(first word, last word, family, places of held pairs) where a template is confirmed, the largest share first.

    For each template, those are places of at most WINDOW words that don't overlap, from a held
    pair to another; fuller ones go before shorter ones.
    """
    content = [i for i, w in enumerate(found) if w not in STOP]
    hits: dict[tuple[str, int], list[tuple[int, int, tuple[str, str]]]] = {}
    for a, b in zip(content, content[1:]):
        pair = (found[a], found[b])
        for at in HOLDERS_OF.get(pair, ()):
            hits.setdefault(at, []).append((a, b, pair))
    out = []
    for (family, k), held in hits.items():
        size = len(TEMPLATE_PAIRS[family][k])
        least = CONFIRM * size
        if len({pair for _, _, pair in held}) < least:
            continue
        made = []
        for i, (first, _, _) in enumerate(held):
            seen, last = set(), first
            for _, b, pair in held[i : i + WINDOW]:
                if b - first >= WINDOW:
                    break
                if pair not in seen:
                    seen.add(pair)
                    last = b
            if len(seen) >= least:
                made.append((-len(seen), last - first, first, last, i))
        taken: set[int] = set()
        for n, _, first, last, i in sorted(made):
            if taken.isdisjoint(range(first, last + 1)):
                taken.update(range(first, last + 1))
                out.append((n / size, n, first, last, family, {a for a, b, _ in held[i : i + WINDOW] if b <= last}))
    return [s[2:] for s in sorted(out, key=lambda s: s[:5])]


def tagged(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, family, 1) of the licence tags of a text, which name their licence."""
    if "SPDX-License-Identifier" not in text:
        return []
    found = ((m.span(), FAMILY_OF.get(m[1].lower().rstrip("."))) for m in _TAG.finditer(text))
    return [(*span, family, 1.0) for span, family in found if family]


def spans(text: str, model: Classifier) -> list[tuple[int, int, str, float]]:
    """(start, end, family, probability) of the notices and tags of a whole text, by start."""
    return sorted(tagged(text) + notices(text, model))


def notices(text: str, model: Classifier) -> list[tuple[int, int, str, float]]:
    """(start, end, family, probability) of the notices of a whole text, by start."""
    low, origin = lowered(text)
    found = _WORD.findall(low)
    if len(CONTENT.intersection(found)) < CONTENT_WORDS:
        return []
    known = []
    taken: dict[int, str] = {}
    for first, last, family, places in stretches(found):
        said, p = model.predict(found[first : last + 1])
        if said == family and 2 * sum(taken.get(a, family) != family for a in places) <= len(places):
            known.append((first, last, family, p))
            for a in places:
                taken.setdefault(a, family)
    if not known:
        return []
    places = [m.span() for m in _WORD.finditer(low)]
    out: list[tuple[int, int, str, float]] = []
    last_of: dict[str, int] = {}
    for first, last, family, p in sorted(known):
        a, b = places[first][0], places[last][1]
        if origin:
            a, b = origin[a], origin[b - 1] + 1
        k = last_of.get(family)
        if k is not None and a <= out[k][1]:
            out[k] = (out[k][0], max(b, out[k][1]), family, max(p, out[k][3]))
        else:
            last_of[family] = len(out)
            out.append((a, b, family, p))
    return out


def licences(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_spans, families (distinct, sorted, comma-joined), spans (family:start:end, comma-joined; code points)."""
    ship_texts(spark)
    shared = spark.sparkContext.broadcast(fit())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [spans(t, shared.value) for t in batch.column("_of_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({s[2] for s in f})) for f in found]),
                    pa.array([",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in f) for f in found]),
                ],
                ["doc_id", "n_spans", "families", "spans"],
            )

    return docs.select("doc_id", clean_text().alias("_of_text")).mapInArrow(run, "doc_id long, n_spans long, families string, spans string")
