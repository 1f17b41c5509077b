"""License scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a line of a text; its words are runs of ASCII letters, digits and characters beyond ASCII,
lower-cased. It is read in windows of SPAN words, half overlapping, so that a notice within a long line is
seen. Features are hashed one- and two-word grams; a multinomial logistic regression gives each window a
probability for every family and for the unknown class. It is trained on variants of the notices
in NOTICES (words dropped, corpus words before and behind) against a bounded sample of corpus lines, and
calibrated by a temperature on variants and lines held out from training. A window whose probability of unknown is under one half
is a find: of every family of which a notice is found around the window (confirmed) and of its most likely family, confirmed or
not. A notice is found if at least SIMILARITY of its SHINGLE-word shingles are there (a shorter notice is one shingle) and they
are no mere part of what is found of another family's notice.

The bound of the sample is a parameter (`lines`); lines are chosen by a hash of the text.

Defined cases: null, empty and word-less texts have no paragraph and no find. A family found in several windows of a paragraph is
reported once, confirmed if any is; finds are in text order, then by family. Texts of over a million bytes are read in parts
of whole lines; a longer line is read in parts that carry their last words on, so that its windows are those of the whole line.
Repeated rows each get a result. Extra columns are returned unchanged, except that a column named like the result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.common import SLICE_BYTES, clean, cut, gram_hashes, powers, texts_of, words_of

#: Notices by which public licences ask to be named, by family.
NOTICES = {
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT License"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "SPDX-License-Identifier: Apache-2.0"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
                "SPDX-License-Identifier: GPL-2.0-or-later"],
    "lgpl": ["it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "This work is licensed under the GNU Lesser General Public License"],
    "agpl-3.0": ["it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
                 "This work is licensed under the GNU Affero General Public License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Licensed under the BSD 3-Clause License.", "Released under the BSD License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, Version 2.0."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "Released under the ISC License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright"],
}

FAMILIES = sorted(NOTICES)
BITS, SPAN, STEP = 15, 40, 20
LINES, VARIANTS, DROPPED = 4000, 60, 0.12
SHINGLE, SIMILARITY = 5, 0.8
DECAY, ROUNDS = 1e-4, 120


def _codes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of each word and of each pair it starts (the last word's pair is a pair with nothing)."""
    mask = np.uint64((1 << BITS) - 1)
    at = np.arange(len(words))
    pairs = gram_hashes(words, at, np.minimum(at + 2, len(words)), powers(1)) if len(words) else words
    return (words & mask).astype(np.int64), (pairs & mask).astype(np.int64)


class Model:
    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.weights, self.bias, self.temperature = weights.astype(np.float32), bias, temperature

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _bags(texts: list[bytes]) -> list[np.ndarray]:
    out = []
    for t in texts:
        one, two = _codes(words_of([clean(t)], powers(0))[1])
        out.append(np.concatenate([one, two[:-1]]))
    return out


def _spread(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bin and value of every feature of short texts."""
    bags = _bags(texts)
    rows = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    values = np.concatenate([np.full(len(b), 1 / np.sqrt(max(1, len(b)))) for b in bags]) if bags else np.empty(0)
    return rows, np.concatenate(bags) if bags else np.empty(0, np.int64), values


def _variants(rng: np.random.Generator, lines: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Notices with words dropped and with corpus words around them, and their family numbers."""
    texts, families = [], []
    around = [w for line in lines[:400] for w in line.split()[:20]] or [b"the"]
    for k, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            words = clean(notice.encode()).split()
            for n in range(VARIANTS):
                kept = [w for w in words if n == 0 or rng.random() > DROPPED] or words
                before, after = ([around[i] for i in rng.integers(0, len(around), rng.integers(0, 10) if n > 4 else 0)] for _ in range(2))
                texts.append(b" ".join([*before, *kept, *after]))
                families.append(k)
    return texts, families


def fit(lines: list[bytes], seed: int = 5) -> Model:
    """Multinomial logistic regression on notice variants against corpus lines, calibrated on the held-out quarter."""
    rng = np.random.default_rng(seed)
    unknown = len(FAMILIES)
    lines = [b" ".join(clean(x).split()[:SPAN]) for x in lines]
    lines = [x for x in lines if x and not confirmed(x)]
    texts, labels = _variants(rng, lines)
    texts, labels = texts + lines, np.array(labels + [unknown] * len(lines))
    held = rng.random(len(texts)) < 0.25
    rows, bins, values = _spread(texts)
    learn = ~held
    target = np.eye(unknown + 1)[labels]
    weight = learn / np.maximum(1, np.bincount(labels[learn], minlength=unknown + 1))[labels]
    weight = weight / weight.sum()
    w, b = np.zeros((1 << BITS, unknown + 1)), np.zeros(unknown + 1)
    speed, drift = np.zeros_like(w), np.zeros_like(b)

    def logits() -> np.ndarray:
        out = np.zeros((len(texts), unknown + 1))
        np.add.at(out, rows, w[bins] * values[:, None])
        return out + b

    for _ in range(ROUNDS):
        error = (Model(w, b).probabilities(logits()) - target) * weight[:, None]
        slope = DECAY * w
        np.add.at(slope, bins, error[rows] * values[:, None])
        speed, drift = 0.9 * speed - 20 * slope, 0.9 * drift - 5 * error.sum(axis=0)
        w, b = w + speed, b + drift
    found, model = logits(), Model(w, b)
    losses = []
    for t in np.geomspace(0.05, 5, 41):
        model.temperature = t
        p = model.probabilities(found[held])
        losses.append((-np.log(np.maximum(p[np.arange(len(p)), labels[held]], 1e-12)).mean() if held.any() else abs(t - 1), t))
    model.temperature = min(losses)[1]
    return model


def _shingles(words: list[bytes]) -> set[tuple]:
    size = min(SHINGLE, len(words))
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if size else set()


_TEMPLATES = {f: [(min(SHINGLE, len(w)), _shingles(w)) for w in (clean(n.encode()).split() for n in notices)] for f, notices in NOTICES.items()}
_SIZES = {size for templates in _TEMPLATES.values() for size, _ in templates}


def confirmed(text: bytes, chances: np.ndarray | None = None) -> set[str]:
    """Families of which a notice is contained in the words of `text`.

    Notices of two families may differ by one word: a notice of which no more is found than a part of what is found of
    another family's does not confirm. Where the same is found of both, the one of the larger of `chances` does, if given.
    """
    words = text.split()
    seen = {tuple(words[k:k + size]) for size in _SIZES for k in range(len(words) - size + 1)}
    near = []
    for k, family in enumerate(FAMILIES):
        for _, shingles in _TEMPLATES[family]:
            there = shingles & seen
            if len(there) >= SIMILARITY * len(shingles):
                near.append((family, there, 0.0 if chances is None else chances[k]))
    return {f for f, there, c in near if not any(g != f and (there < more or there == more and c < d) for g, more, d in near)}


def scan(text: bytes, model: Model, size: int = SLICE_BYTES) -> tuple[int, list[dict]]:
    """(number of paragraphs, finds) of one text, read in parts of about `size` bytes."""
    paragraphs, found, unknown, at, carried, seen = 0, {}, len(FAMILIES), 0, b"", 0
    while at < len(text):
        to = cut(text, at, size)
        part, at = carried + text[at:to], to
        # Only a line that is longer than a part goes on behind it; it is alone in that part.
        goes_on, done, carried, seen = at < len(text) and text[at - 1] != 10, seen, b"", 0
        joined, words, (starts, ends, _) = words_of([clean(part)], powers(0))
        if not len(words):
            continue
        lines = np.flatnonzero(np.frombuffer(part, np.uint8) == 10)
        owner = np.searchsorted(lines, starts)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(words)]]))
        counts = np.maximum(1, -(-(sizes - STEP) // STEP))
        if goes_on:
            # Windows whose surroundings are all here; the last of them and what is behind it are carried on.
            counts = np.maximum(0, (sizes - SPAN) // STEP)
            seen = min(1, int(counts[0]))
            carried = b" ".join([*joined[starts[STEP * (int(counts[0]) - seen)]:].split(), b""])
        line = np.repeat(np.arange(len(first)), counts)
        nth = np.arange(len(line)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = first[line] + STEP * nth
        end = np.minimum(start + SPAN, first[line] + sizes[line])
        one, two = _codes(words)
        sums = [np.concatenate([np.zeros((1, unknown + 1)), np.cumsum(model.weights[c], axis=0, dtype=np.float64)]) for c in (one, two)]
        logits = sums[0][end] - sums[0][start] + sums[1][end - 1] - sums[1][start]
        logits = logits / np.sqrt(2 * (end - start) - 1)[:, None] + model.bias
        # A window is a find if unknown is less likely than not; the exact sum is only needed where it is not the best.
        for k in np.flatnonzero(logits[:, :unknown].max(axis=1) > logits[:, unknown] - 3 * model.temperature):
            p = model.probabilities(logits[k:k + 1])[0]
            if p[unknown] >= 0.5 or k < done:
                continue
            low, high = max(first[line[k]], start[k] - STEP), min(first[line[k]] + sizes[line[k]], end[k] + STEP)
            sure = confirmed(joined[starts[low]:ends[high - 1]], p)
            for family in sure | {FAMILIES[int(p[:unknown].argmax())]}:
                key = (paragraphs + int(line[k]), family)
                before = found.get(key, (False, 0.0))
                found[key] = (family in sure or before[0], max(before[1], float(1 - p[unknown])))
        paragraphs += len(first) - goes_on
    return paragraphs, [{"paragraph": k, "family": f, "confirmed": c, "probability": p} for (k, f), (c, p) in sorted(found.items())]


_RESULT = pa.struct([("paragraphs", pa.int64()), ("finds", pa.list_(pa.struct([
    ("paragraph", pa.int64()), ("family", pa.string()), ("confirmed", pa.bool_()), ("probability", pa.float64())])))])


def train(docs: DataFrame, text: str = "text", lines: int = LINES) -> Model:
    """Fit against about `lines` corpus lines, one from each chosen document."""
    rows = docs.select(F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    n = rows.count()
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < min(1.0, lines / max(1, n)) * (1 << 20))
    split = F.split("text", "\n")
    line = F.get(split, F.pmod(F.xxhash64("text", F.lit("line")), F.size(split)).cast("int"))
    found = chosen.select(F.substring(line, 1, 1000).alias("line")).distinct().collect()
    return fit(sorted(r["line"].encode() for r in found if r["line"]))


def with_licences(docs: DataFrame, model: Model, text: str = "text", column: str = "licences") -> DataFrame:
    """`docs` with (paragraphs, finds): the licences found, by paragraph."""
    def read(texts: pa.Array) -> pa.Array:
        out = []
        for k in range(len(texts)):
            n, finds = scan(texts_of(texts, k, k + 1)[0], model)
            out.append({"paragraphs": n, "finds": finds})
        return pa.array(out, _RESULT)

    returns = "struct<paragraphs:bigint,finds:array<struct<paragraph:bigint,family:string,confirmed:boolean,probability:double>>>"
    return docs.withColumn(column, F.arrow_udf(read, returns).asNondeterministic()(F.col(text).cast("string")))
