"""Licence notices by a trained paragraph classifier, confirmed against templates.

A sparse logistic regression over hashed word n-grams gives each sentence a licence
family or ``unknown``; its probabilities are calibrated on notices and background that
it was not fitted on. A prediction stands only if the sentence is also close to one of
its family's templates, so a text that merely talks about licences is not reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import ROW, pieces, texts_of, utf8, with_row
from .shingles import Rolling, mix, words

# Customary notices of licence families.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc0": [
        "Released into the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "all-rights-reserved": [
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced or distributed without the prior written permission of the publisher.",
    ],
}
# Sentences that speak of licences or rights and grant none.
BACKGROUND = [
    "He lost his driving license after the accident.",
    "The restaurant has a license to sell wine and beer.",
    "A fishing license is required in this area.",
    "The company will apply for a new license next year.",
    "Human rights are reserved to all people.",
    "The public may obtain a copy at the library.",
    "The version of the story that she told was different.",
    "You may not use this door after six.",
    "Permission to land was granted without delay.",
    "The work is under way and will be released soon.",
    "The conditions of the contract were not met.",
    "Their software was published under great pressure.",
]
FAMILIES = ["unknown", *TEMPLATES]

BUCKETS = 1 << 18
GRAMS = 3  # longest word n-gram
SIMILAR = 0.55  # least share of bigrams in common with a template
CERTAIN = 0.5  # least calibrated probability
BACKGROUND_ROWS = 2000  # documents that background sentences are drawn from, about
BACKGROUND_SENTENCES = 20_000  # sentences drawn, about
CHUNK = 1 << 18  # bytes of text handled at once
WORDY = np.zeros(256, bool)
WORDY[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Sentences:
    """Sentences of the rows of a buffer, with the n-gram hashes of their words.

    Words are runs of ASCII letters and digits (lower-cased) and bytes beyond ASCII.
    A sentence ends at a line end, or at . ! ? before white space.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        base = int(offsets[0])
        raw = data[base : int(offsets[-1])]
        plain = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
        plain = np.where(WORDY[raw], plain, 32).astype(np.uint8)
        self.starts, self.ends, owner = words(plain, offsets - base)
        self.count = 0
        if not len(self.starts):
            return
        self.h = Rolling(plain).of(self.starts, self.ends)
        space = np.isin(np.append(raw[1:], 32), np.array([9, 10, 13, 32], np.uint8))
        stop = (raw == 10) | (np.isin(raw, np.frombuffer(b".!?", np.uint8)) & space)
        passed = np.cumsum(stop)[self.starts]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (passed[1:] != passed[:-1])])
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(self.starts))
        self.sentence = np.cumsum(new) - 1
        self.owner, self.count, self.base = owner[self.first], len(self.first), base

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, sentence) of every run of n words within a sentence."""
        size = len(self.h) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        rolled = np.full(size, n, np.uint64)
        for k in range(n):
            rolled = mix(rolled ^ self.h[k : k + size])
        inside = self.sentence[:size] == self.sentence[n - 1 :]
        return rolled[inside], self.sentence[:size][inside]


def _sentences_of(texts: list[str]) -> Sentences:
    data = [t.encode() for t in texts]
    return Sentences(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))


@dataclass
class Classifier:
    """Weights (bucket, family), constants, temperature and template bigrams."""

    weights: np.ndarray
    constants: np.ndarray
    temperature: float
    keep: np.ndarray  # buckets with weights, by number

    @cached_property
    def row(self) -> np.ndarray:
        out = np.full(BUCKETS, -1, np.int32)
        out[self.keep] = np.arange(len(self.keep))
        return out

    @cached_property
    def templates(self) -> list[tuple[int, str, np.ndarray]]:
        """(family, template, bigram hashes)."""
        out = []
        for family, texts in TEMPLATES.items():
            for text in texts:
                s = _sentences_of([text.replace(". ", ", ")])
                out.append((FAMILIES.index(family), text, np.unique(s.grams(2)[0])))
        return out

    def probabilities(self, s: Sentences) -> np.ndarray:
        """(sentence, family) probabilities."""
        logits = np.tile(self.constants, (s.count, 1))
        for n in range(1, GRAMS + 1):
            h, at = s.grams(n)
            row = self.row[(h % np.uint64(BUCKETS)).astype(np.int64)]
            known = row >= 0
            np.add.at(logits, at[known], self.weights[row[known]])
        z = logits / self.temperature
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)

    def confirm(self, family: int, bigrams: np.ndarray) -> tuple[str, float]:
        """The nearest template of the family and the overlap of bigrams with it.

        The overlap is the share of the smaller side that both have, if that is more
        than three bigrams; else the Jaccard similarity.
        """
        best = ("", 0.0)
        mine = np.unique(bigrams)
        for f, text, theirs in self.templates:
            if f != family:
                continue
            both = len(np.intersect1d(mine, theirs, assume_unique=True))
            small = min(len(mine), len(theirs))
            value = both / small if small > 3 else both / max(1, len(mine) + len(theirs) - both)
            if value > best[1]:
                best = (text, value)
        return best


def _variants(text: str, rng: np.random.Generator, n: int) -> list[str]:
    """Copies of a notice with words lost, added, cut off or in other case."""
    out = [text, text.lower(), text.upper()]
    filler = "project file code document it the our this 2019 author inc team and".split()
    for _ in range(n):
        parts = text.split()
        parts = [w for w in parts if rng.random() > 0.06] or parts
        if rng.random() < 0.3:
            parts.insert(int(rng.integers(0, len(parts) + 1)), filler[int(rng.integers(len(filler)))])
        if rng.random() < 0.25 and len(parts) > 8:
            parts = parts[: int(rng.integers(6, len(parts)))]
        out.append(" ".join(parts))
    return out


def _fit(s: Sentences, y: np.ndarray, steps: int = 150, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Softmax regression on n-gram counts by accelerated gradient steps: (buckets, weights, constants)."""
    hs, ats = zip(*(s.grams(n) for n in range(1, GRAMS + 1)), strict=True)
    bucket = (np.concatenate(hs) % np.uint64(BUCKETS)).astype(np.int64)
    at = np.concatenate(ats)
    marked = np.unique(bucket[y[at] > 0])  # n-grams of notices; others have no weight
    use = np.isin(bucket, marked)
    bucket, at = np.searchsorted(marked, bucket[use]), at[use]
    order = np.argsort(at, kind="stable")
    bucket, at = bucket[order], at[order]
    target = np.zeros((s.count, len(FAMILIES)))
    target[np.arange(s.count), y] = 1
    share = 1.0 / np.bincount(y, minlength=len(FAMILIES)).clip(1)
    importance = (share[y] / share[y].sum())[:, None]
    w, c = np.zeros((len(marked), len(FAMILIES))), np.zeros(len(FAMILIES))
    w_before, c_before = w, c
    for step in range(steps):
        mw, mc = w + step / (step + 3) * (w - w_before), c + step / (step + 3) * (c - c_before)
        z = np.tile(mc, (s.count, 1))
        np.add.at(z, at, mw[bucket])
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        wrong = importance * (p / p.sum(axis=1, keepdims=True) - target)
        gw = ridge * mw
        np.add.at(gw, bucket, wrong[at])
        w_before, c_before = w, c
        w, c = mw - 4.0 * gw, mc - 4.0 * wrong.sum(axis=0)
    return marked, w.astype(np.float32), c


def _share(part: int, whole: int) -> Column:
    """Upper limit of 30-bit hashes that lets about ``part`` of ``whole`` rows through."""
    return F.lit(max(1, round((1 << 30) * min(1.0, part / max(1, whole)))))


def _background(docs: DataFrame, rows: int, sentences: int) -> list[str]:
    """About ``sentences`` different sentences of about ``rows`` different texts, from anywhere in them."""
    every = docs.filter("text IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    low = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    texts = every.filter(low < _share(rows, every.count()))
    lines = texts.select(F.explode(F.split("text", r"\n|(?<=\.) ")).alias("t")).filter("trim(t) <> ''").distinct()
    drawn = F.pmod(F.xxhash64(F.lit("sentence"), "t"), F.lit(1 << 30))
    return [r.t for r in lines.filter(drawn < _share(sentences, lines.count())).orderBy(F.xxhash64("t"), "t").collect()]


def train(
    docs: DataFrame, background_rows: int = BACKGROUND_ROWS, seed: int = 3, background_sentences: int = BACKGROUND_SENTENCES
) -> Classifier:
    """A classifier of notices against background.

    Notices are variants of the templates; background is a fixed list and about
    ``background_sentences`` sentences, drawn by their hash from the whole texts of about
    ``background_rows`` documents, which are drawn by a hash of their text.
    """
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            some = _variants(notice.replace(". ", ", "), rng, 25)
            texts += some
            y += [FAMILIES.index(family)] * len(some)
    for line in BACKGROUND:
        some = _variants(line, rng, 10)
        texts += some
        y += [0] * len(some)
    known = {x for t in TEMPLATES.values() for x in t}
    for line in _background(docs, background_rows, background_sentences):
        low = line.lower()
        if line not in known and not any(m in low for m in ("licen", "copyright", "rights reserved", "redistribut")):
            texts.append(line)
            y.append(0)
    texts = [t.replace("\n", " ").replace(". ", ", ").replace("! ", ", ").replace("? ", ", ") for t in texts]
    keep = [i for i, t in enumerate(texts) if any(WORDY[b] for b in t.encode())]
    label = np.array([y[i] for i in keep])
    held = rng.random(len(keep)) < 0.25
    s = _sentences_of([texts[i] + "\n" for i in np.array(keep)[~held]])
    bucket, weights, constants = _fit(s, label[~held])
    model = Classifier(weights, constants, 1.0, bucket)
    check = _sentences_of([texts[i] + "\n" for i in np.array(keep)[held]])
    best = np.inf
    for temperature in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0):
        trial = Classifier(weights, constants, temperature, bucket)
        p = trial.probabilities(check)[np.arange(check.count), label[held]]
        loss = float(-np.log(np.maximum(p, 1e-12)).mean())
        if loss < best:
            best, model = loss, trial
    return model


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """(_row, start, end, family, probability, template, similarity) of confirmed notices.

    ``docs`` has doc_id and text, or ``_row`` and text; start and end are bytes of the
    UTF-8 text. Null and empty texts have no notices; repeated rows are scanned each; an
    empty table gives no rows.
    """
    docs = with_row(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n-grams of the templates' variants

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = batch.column(ROW).to_numpy()
            out: list[tuple] = []
            for low, high in pieces(offsets, CHUNK):
                s = Sentences(data, offsets[low : high + 1])
                if not s.count:
                    continue
                p = m.probabilities(s)
                family = p[:, 1:].argmax(axis=1) + 1
                sure = p[np.arange(s.count), family]
                hits = np.flatnonzero(sure >= CERTAIN)
                if not len(hits):
                    continue
                h, at = s.grams(2)
                for i in hits.tolist():
                    a, b = np.searchsorted(at, [i, i + 1])
                    template, similar = m.confirm(int(family[i]), h[a:b])
                    if similar >= SIMILAR:
                        begin = int(offsets[low + s.owner[i]]) - s.base
                        out.append((
                            int(keys[low + s.owner[i]]), int(s.starts[s.first[i]]) - begin, int(s.ends[s.last[i] - 1]) - begin,
                            FAMILIES[family[i]], float(sure[i]), template, similar,
                        ))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [ROW, "start", "end", "family", "probability", "template", "similarity"],
            )

    return texts_of(docs, ROW).mapInArrow(
        run, f"{ROW} long, start long, end long, family string, probability double, template string, similarity double"
    )
