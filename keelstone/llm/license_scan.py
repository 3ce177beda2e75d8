"""Licence scans: a sparse logistic regression over word n-grams names a paragraph's licence family, template comparison confirms it.

Paragraphs are lines; longer ones are read in windows. Wrapped notices and several in one line are found by the places of a template's pairs,
wherever lines end, and read with words on either side. Features are the words and word pairs of the templates, so a paragraph without
any pair of them has the same outcome as an empty one, unknown. The model is trained on templates that are cut, thinned and set
among corpus words, against corpus lines and templates out of order; the unknown class is calibrated by a temperature fitted on
examples of lines and cuts that training didn't see. A prediction counts if it leads the next family by MARGIN, a share of the pairs of one of
the family's templates stands in the paragraph, and so does that share of the pairs which tell the template from each other
family: a licence that is like a known one, but not it, is unknown. A notice that several families have in common names what they share (BSD).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, distinct, flat, mixed, pieces, word_hashes, word_spans
from .decontamination import BETWEEN

GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
#: Notices of common licences.
TEMPLATES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", GNU.format("Affero General Public License", "3")],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License", "Licensed under the Simplified BSD License"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", GNU.format("General Public License", "2")],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", GNU.format("General Public License", "3")],
    "ISC": ["Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1", GNU.format("Lesser General Public License", "2.1")],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", GNU.format("Lesser General Public License", "3")],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "Released under the Unlicense"],
}
for family, notices in TEMPLATES.items():
    if family != "BSD":  # no identifier of its own
        notices.append(f"SPDX-License-Identifier: {family}")
#: Sentences with words of licences that are none.
OTHERS = ["You need a driving license to rent a car", "The license plate was issued in 2004", "He released the MIT study under his own name", "The public was granted free admission to this work", "All rights reserved", "version 2.0 of the file was released"]
UNKNOWN = "unknown"
WINDOW, CORPUS_LINES, ROUNDS = 48, 1500, 400
CHANCE, MARGIN, LIKENESS, SPREAD, EXTRA, NEIGHBOURS, CUTS = 0.5, 0.2, 0.7, 2, 4, 6, 30
SCHEMA = "doc_id long, family string, probability double, likeness double, n_paragraphs long, first_line long"


def hashes(texts: list[str]) -> list[np.ndarray]:
    data, at, _ = flat(pa.array(texts, pa.string()))
    starts, ends, before = word_spans(data, at, BETWEEN)
    h = word_hashes(data, starts, ends)
    return [h[a:b] for a, b in zip(before, before[1:], strict=False)]


def pairs(h: np.ndarray) -> np.ndarray:
    return mixed(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:])


@dataclass
class Classifier:  # telling: of each template the pairs that tell it from each family like its own

    families: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray
    temperature: float
    templates: dict[str, list[np.ndarray]]

    def __post_init__(self):
        """Of each template the pairs that no template of another family of its kind has; families with less than half of its pairs aren't of its kind."""
        whole = {k: distinct(np.concatenate(ts)) for k, ts in self.templates.items()}
        apart = lambda k, t: [t[~np.isin(t, own)] for other, own in whole.items() if other != k and np.isin(t, own).mean() >= 0.5]
        self.telling = {k: [[x for x in apart(k, t) if len(x)] for t in ts] for k, ts in self.templates.items()}

    def likeness(self, family: str, number: int, have: np.ndarray, least: float) -> float:
        """The share of a template's pairs that is there, 0 where the pairs that tell it from another family aren't."""
        if any(np.isin(x, have).mean() < least for x in self.telling[family][number]):
            return 0.0
        return float(np.isin(self.templates[family][number], have).mean())

    def sure(self, p: np.ndarray) -> bool:
        """Whether the first of these chances of families leads by MARGIN."""
        a, b = np.sort(p)[:-3:-1]
        return bool(a - b >= MARGIN)

    def features(self, h: np.ndarray) -> np.ndarray:
        """1 for each word and pair of the vocabulary, then the share of words that aren't in it, then 1."""
        own = np.zeros(len(self.vocabulary) + 2, np.float32)
        words, own_pairs = self.places(h), self.places(pairs(h))
        own[words[words >= 0]] = own[own_pairs[own_pairs >= 0]] = 1
        own[-2:] = (words < 0).mean() if len(h) else 1, 1
        return own

    def places(self, x: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, x)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == x, at, -1)

    def predict(self, h: np.ndarray, least: float = LIKENESS) -> tuple[str, float, float]:
        """Family, calibrated chance and likeness of a paragraph: of the window that is most surely of a licence. No lead, or no template confirmed: unknown, with the chance of the likeliest."""
        step = WINDOW // 2
        rows = [h[a : a + WINDOW] for a in range(0, max(1, len(h) - step), step)]
        p = chances(np.stack([self.features(r) for r in rows]) @ self.weights / self.temperature)
        best = int(p[:, 1:].max(1).argmax())
        k = int(p[best, 1:].argmax()) + 1
        have = distinct(pairs(h))
        family = self.families[k]
        like = max(self.likeness(family, i, have, least) for i in range(len(self.templates[family])))
        return family if like >= least and self.sure(p[best, 1:]) else UNKNOWN, float(p[best, k]), like


    def notices(self, h: np.ndarray, row: np.ndarray, places: np.ndarray, chance: float, likeness: float) -> Iterator[tuple[str, float, float, int, int]]:
        """Family, chance, likeness, first and last word of every notice in words h, wherever its lines end. places: of all pairs of templates.

        A notice holds the share `likeness` of a template's pairs within SPREAD times its words and EXTRA more, in one row, and is read with
        the word before and the word after it, or cut to that share with NEIGHBOURS words on either side: a name may go on there.
        """
        own = mixed(h[places] * U64(0x9E3779B97F4A7C15) + h[places + 1])
        for family, templates in self.templates.items():
            for number, t in enumerate(templates):
                spot = np.searchsorted(t, own)
                spot[spot == len(t)] = 0
                here = t[spot] == own
                at, kind = places[here], spot[here]
                least, reach = max(1, int(np.ceil(likeness * len(t) - 1e-9))), SPREAD * len(t) + EXTRA
                if len(at) < least:
                    continue
                near = at[least - 1 :] - at[: len(at) - least + 1] <= reach
                past = -1
                for i in np.flatnonzero(near & (row[at[least - 1 :]] == row[at[: len(at) - least + 1]])).tolist():
                    if i <= past:
                        continue
                    end = int(np.searchsorted(at, at[i] + reach, "right"))
                    end = i + int((row[at[i:end]] == row[at[i]]).sum())
                    _, new = np.unique(kind[i:end], return_index=True)
                    if len(new) < least:
                        continue
                    for j, more in ((i + int(new.max()), 1), (i + int(np.sort(new)[least - 1]), NEIGHBOURS)):  # all of it, or no more than counts
                        _, last = np.unique(kind[i : j + 1][::-1], return_index=True)
                        a, b = int(at[j - int(last.max())]), int(at[j]) + 2
                        around = np.arange(max(0, a - more), min(len(h), b + more))
                        around = around[row[around] == row[a]]
                        c = chances((self.features(h[around]) @ self.weights / self.temperature)[None])[0]
                        k = int(c[1:].argmax()) + 1
                        if self.families[k] == family and c[k] >= chance and self.sure(c[1:]) and self.likeness(family, number, distinct(pairs(h[around])), likeness):
                            yield family, float(c[k]), len(last) / len(t), a, b - 1
                            past = j
                            break


def chances(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(lines: list[str], seed: int = 5) -> Classifier:
    """lines: corpus paragraphs, taken to be of no licence."""
    rng = np.random.default_rng(seed)
    families = [UNKNOWN, *TEMPLATES]
    own = {k: hashes(v) for k, v in TEMPLATES.items()}
    vocabulary = distinct(np.concatenate([x for ts in own.values() for t in ts for x in (t, pairs(t))]))
    templates = {k: [distinct(pairs(t)) for t in ts] for k, ts in own.items()}
    model = Classifier(families, vocabulary, np.zeros((len(vocabulary) + 2, len(families))), 1.0, templates)
    known = {t for ts in templates.values() for t in np.concatenate(ts).tolist()}
    corpus = [h for h in hashes(lines) if len(h) and sum(x in known for x in pairs(h).tolist()) < 3] or [np.zeros(1, U64)]
    unseen = max(1, len(corpus) // 5)
    rows, labels, seen = [], [], []

    def add(x: np.ndarray, label: int, fit: bool):
        rows.append(model.features(x))
        labels.append(label)
        seen.append(fit)

    for k, ts in enumerate(own.values(), 1):
        for t in ts:
            for i in range(CUTS):
                fit = i >= CUTS // 5  # the others are thinned anew and stand among lines of their own
                lines_here = corpus[unseen:] or corpus if fit else corpus[:unseen]
                x = t[rng.random(len(t)) > (rng.choice([0.0, 0.05, 0.15]) if fit else 0.1)]
                around = [lines_here[rng.integers(len(lines_here))][: rng.integers(0, 12)] for _ in range(2)]
                add(np.concatenate([around[0], x, around[1]]) if rng.random() < 0.5 or not fit else x, k, fit)
                add(rng.permutation(t)[: rng.integers(1, len(t) + 1)], 0, fit)  # a template's words out of order
    for x in hashes(OTHERS) * 20:
        add(x, 0, True)
    for i, x in enumerate(corpus):
        add(x[:WINDOW], 0, i >= unseen or len(corpus) == 1)
    x, y, fit = np.stack(rows), np.array(labels), np.array(seen)
    w, target = model.weights, np.eye(len(families))[y[fit]]
    for _ in range(ROUNDS):
        g = x[fit].T @ (chances(x[fit] @ w) - target) / fit.sum()
        w -= 4.0 * g
        w[:-2] = np.sign(w[:-2]) * np.maximum(np.abs(w[:-2]) - 4.0 * 2e-4, 0)  # sparse: small weights become 0
    logits = x[~fit] @ w
    losses = {t: -np.log(chances(logits / t)[np.arange(len(logits)), y[~fit]] + 1e-12).mean() for t in np.geomspace(0.2, 3, 28)}
    model.temperature = float(min(losses, key=losses.__getitem__))
    return model


def sample(docs: DataFrame, lines: int = CORPUS_LINES) -> list[str]:
    """About so many lines: of the rows with the lowest hashes one line each, anywhere in the text by another hash; the classifier reads WINDOW words of it."""
    some = docs.where("text is not null")
    n = some.count()
    drawn = F.pmod(F.xxhash64(F.lit("licence"), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    every = F.split("text", "\n")
    line = F.get(every, F.pmod(F.xxhash64(F.lit("line"), "doc_id", "text"), F.size(every)).cast("int"))
    words = F.array_join(F.slice(F.split(F.trim(line), "\\s+"), 1, 2 * WINDOW), " ")
    return sorted(r[0] for r in some.where(drawn <= min(1.0, lines / max(1, n))).select(words).collect())


def paragraphs(spans: list[tuple[int, int]]) -> tuple[int, int]:
    """How many runs of lines there are, those that share a line taken as one, and the first line of all."""
    count, end = 0, -1
    for a, b in sorted(spans):
        count += a > end
        end = max(end, b)
    return count, min(spans)[0]


def scan(docs: DataFrame, model: Classifier, chance: float = CHANCE, likeness: float = LIKENESS) -> DataFrame:
    """doc_id, family, probability, likeness, n_paragraphs, first_line (from 0) of every row and every licence family that a paragraph of it names.

    A paragraph is a line, or the lines over which a notice is wrapped; it may name several families. It names one if its calibrated chance is `chance` or more and the
    paragraph holds the share `likeness` of the pairs of one of the family's templates: a line's surest family in the whole line, all others within SPREAD times its words and EXTRA more. Whole texts are read. Null and empty texts name none; rows may repeat, ids may be null; only doc_id, text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        heads = distinct(np.concatenate([t for ts in own.templates.values() for t in ts]))
        for batch in batches:
            for part in pieces(batch, "text"):
                data, at, _ = flat(part.column("text"))
                starts, ends, before = word_spans(data, at, BETWEEN)
                h = word_hashes(data, starts, ends)
                row = np.repeat(np.arange(part.num_rows), np.diff(before))
                breaks = np.flatnonzero(data == 10)
                line = np.searchsorted(breaks, starts) + row  # rows end lines too
                found: dict[tuple[int, str], list] = {}

                def add(family: str, sure: float, like: float, a: int, b: int, row=row, line=line, found=found):
                    f = found.setdefault((int(row[a]), family), [0.0, 0.0, []])
                    f[:2] = max(f[0], sure), max(f[1], like)
                    f[2].append((int(line[a]), int(line[b])))

                if len(h) > 1:
                    p = pairs(h)
                    spot = np.searchsorted(heads, p)
                    spot[spot == len(heads)] = 0
                    known = (heads[spot] == p) & (row[1:] == row[:-1])
                    hit = known & (line[1:] == line[:-1])
                    for n in distinct(line[:-1][hit]).tolist():
                        a, b = np.searchsorted(line, [n, n + 1])
                        family, sure, like = own.predict(h[a:b], likeness)
                        if family != UNKNOWN and sure >= chance:
                            add(family, sure, like, a, a)
                    for family, sure, like, a, b in own.notices(h, row, np.flatnonzero(known), chance, likeness):
                        add(family, sure, like, a, b)
                ids = part.column("doc_id")
                rows = []
                for (r, k), (sure, like, spans) in sorted(found.items()):
                    count, first = paragraphs(spans)
                    rows.append((ids[r].as_py(), k, sure, like, count, first - r - int(np.searchsorted(breaks, at[r]))))
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], kind) for j, kind in enumerate(kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)
