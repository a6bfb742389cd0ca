"""Licence notices in paragraphs: sparse n-gram logistic regression, an unknown class, and templates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_slices, text_or_empty

# Short public notice texts of each licence family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "This project is distributed under the terms of the MIT license",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GNU GPL version 2 or later",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights under CC0",
    ],
    "Public-Domain": ["This is free and unencumbered software released into the public domain"],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
}
# Names that stand for a family without the wording of a notice. A name of one word is a match by itself.
NAMES = {
    "MIT": ["SPDX-License-Identifier: MIT", "MIT License", "MIT-licensed", "under the MIT terms", "under the terms of the MIT license"],
    "Apache-2.0": ["Apache-2.0", "Apache License", "Apache License 2.0"],
    "GPL": ["GPL", "GNU General Public License"],
    "LGPL": ["LGPL", "GNU Lesser General Public License"],
    "AGPL": ["AGPL", "GNU Affero General Public License"],
    "BSD": ["BSD 3-Clause", "BSD License", "BSD-style license", "BSD-licensed"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License"],
    "CC-BY-NC": ["CC-BY-NC", "CC BY-NC"],
    "CC-BY-SA": ["CC-BY-SA", "CC BY-SA"],
    "CC-BY": ["CC-BY", "CC BY 4.0"],
    "CC0": ["CC0"],
    "Public-Domain": ["released into the public domain"],
    "ISC": ["SPDX-License-Identifier: ISC", "ISC License"],
}
UNKNOWN = "unknown"
TRAINING_PARAGRAPHS = 4_000
CONFIRMED = 0.6
WORD = re.compile(r"[A-Za-z0-9]+(?:-[A-Za-z]+)*")
FUSED = re.compile(r"([al]?gpl|cc-by(?:-nc|-sa)?|apache|mpl)(?:-?v)?\d*(?:-or-later|-only)?")
LINE = re.compile(r"[^\n]+")
CACHED_WORDS = 300_000
HINT = re.compile(r"licen[cs]|copyright|redistribut|warrant|spdx|permission is hereby|permission to use|public domain|creative commons|\bcc[ -]?(?:by|0)\b|\bgpl\b|free software", re.I)


def word(raw: str) -> str:
    """A word in lower case; numbers count as one word and go from the end of a name, so versions do not matter."""
    raw = raw.lower()
    if raw[0].isdigit():
        return "0" + raw.lstrip("0123456789") if not raw.isdigit() else "0"
    name = FUSED.fullmatch(raw)
    return name[1] if name else raw


def words(text: str) -> list[str]:
    return [word(w) for w in WORD.findall(text)]


def grams(tokens: list[str]) -> set[str]:
    """Word runs of one to three."""
    return {" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)}


def variants(text: str, rng: np.random.Generator) -> Iterator[str]:
    """A template as it stands, with words left out, and with other words around it."""
    tokens = text.split()
    filler = "all files of this work see notice copyright by the authors and contributors unless stated otherwise".split()
    for _ in range(12):
        kept = [t for t in tokens if rng.random() > 0.08] or tokens
        before = list(rng.choice(filler, rng.integers(0, 5)))
        after = list(rng.choice(filler, rng.integers(0, 5)))
        yield " ".join(before + kept + after)
    yield text


class Classifier:
    """Multinomial logistic regression on sparse n-grams with one class for text that is no known licence.

    A paragraph is taken for a family when the calibrated probability is over one half; then the best template of
    the family has to share enough of its n-grams. A paragraph that speaks of licences and fails either is unknown.
    """

    def __init__(self, background: list[str]):
        rng = np.random.default_rng(3)
        samples, labels, check, check_labels = [], [], [], []
        self.families = [UNKNOWN, *TEMPLATES]
        for label, family in enumerate(self.families[1:], 1):
            for template in TEMPLATES[family] + NAMES[family]:
                for i, text in enumerate(variants(template, rng)):
                    (check if i % 4 == 3 else samples).append(grams(words(text)))
                    (check_labels if i % 4 == 3 else labels).append(label)
        vague = ["all rights reserved", "see the license file for details", "licensed under other terms", "copyright by the authors",
                 "released under a proprietary license", "the license of the driver", "license required", "under the terms of the agreement", "version 2.0 released"]
        for i, text in enumerate(vague * 6 + background):
            (check if i % 4 == 3 else samples).append(grams(words(text)))
            (check_labels if i % 4 == 3 else labels).append(0)
        known = {g for kind in (TEMPLATES, NAMES) for family in kind.values() for t in family for g in grams(words(t))} | {g for t in vague for g in grams(words(t))}
        self.index = {g: i for i, g in enumerate(sorted(known))}
        self.templates = [[]] + [[grams(words(t)) for t in TEMPLATES[f] + NAMES[f]] for f in self.families[1:]]
        x, y = self.matrix(samples), np.array(labels)
        self.weights = np.zeros((x.shape[1], len(self.families)))
        target = np.eye(len(self.families))[y]
        share = 1.0 / np.bincount(y, minlength=len(self.families))[y]
        share /= share.sum()
        momentum = np.zeros_like(self.weights)
        for _ in range(400):
            slope = x.T @ ((softmax(x @ self.weights) - target) * share[:, None]) + 1e-5 * self.weights
            momentum = 0.9 * momentum - 4.0 * slope
            self.weights += momentum
        scores, truth = self.matrix(check) @ self.weights, np.array(check_labels)
        heats = np.geomspace(0.25, 4, 17)
        self.heat = min(heats, key=lambda h: -np.log(softmax(scores / h)[np.arange(len(truth)), truth] + 1e-12).mean())

    def matrix(self, samples: list[set[str]]) -> np.ndarray:
        x = np.zeros((len(samples), len(self.index) + 1))
        x[:, -1] = 1.0
        for i, sample in enumerate(samples):
            own = [self.index[g] for g in sample if g in self.index]
            x[i, own] = 1.0
        return x

    def label(self, tokens: list[str]) -> tuple[str, float, float]:
        """(family, probability, similarity to the family's nearest template)."""
        own = grams(tokens)
        chance = softmax(self.matrix([own]) @ self.weights / self.heat)[0]
        best = int(chance.argmax())
        if best == 0 or chance[best] < 0.5:
            return UNKNOWN, float(chance[0]), 0.0
        alike = max(len(own & t) / len(t) for t in self.templates[best])
        return (self.families[best] if alike >= CONFIRMED else UNKNOWN), float(chance[best]), float(alike)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(docs: DataFrame, max_paragraphs: int = TRAINING_PARAGRAPHS) -> Classifier:
    """Templates and their variants against at most ``max_paragraphs`` paragraphs without any licence word."""
    rows = docs.select(text_or_empty().alias("text"))
    share = min(1.0, 0.5 * max_paragraphs / max(1, rows.count()))
    lines = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < max(1, int(1_000_000 * share))).select(
        F.explode(F.split("text", "\n")).alias("line")
    ).where((F.length("line") > 20) & (F.length("line") < 2000) & ~F.col("line").rlike("(?i)licen[cs]|copyright|gnu|creative"))
    return Classifier([row["line"] for row in lines.orderBy(F.xxhash64("line"), "line").limit(max_paragraphs).collect()])


class Finder:
    """Notices in blocks of lines: stretches that hold enough of a template's n-grams, wherever lines are wrapped."""

    def __init__(self, machine: Classifier):
        self.machine = machine
        texts = {tuple(words(t)): None for kind in (TEMPLATES, NAMES) for family in kind.values() for t in family}
        self.ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.names = list(self.ids)
        self.met: dict[str, int] = {}
        self.templates, self.holders = [], {}
        for n, tokens in enumerate(texts):
            ids = [self.ids[w] for w in tokens]
            own = {tuple(ids[i : i + k]) for k in (1, 2, 3) for i in range(len(ids) - k + 1)}
            self.templates.append((own, len(ids)))
            for gram in own:
                self.holders.setdefault(gram, []).append(n)
        self.pairs = {g for g in self.holders if len(g) == 2}
        self.triples = {g for g in self.holders if len(g) == 3}
        self.single = {next(iter(own))[0] for own, size in self.templates if size == 1}

    def numbers(self, raw: list[str]) -> list[int]:
        """The words as numbers, -1 for a word of no template."""
        met = self.met
        if len(met) > CACHED_WORDS:
            met.clear()
        for w in set(raw).difference(met):
            met[w] = self.ids.get(word(w), -1)
        return [met[w] for w in raw]

    def stretches(self, ids: list[int]) -> list[tuple[int, int]]:
        """(first, last) word of the stretches that look like a template, the fullest first, none over another.

        A template of three words or more cannot be shared to 0.6 without one of its pairs, and shorter ones have to
        be there in one piece; so a block without any pair or one-word name of a template holds no notice.
        """
        hits = self.pairs.intersection(zip(ids, ids[1:]))
        single = self.single.intersection(ids)
        if not hits and not single:
            return []
        hits |= self.triples.intersection(zip(ids, ids[1:], ids[2:]))
        hits |= {(i,) for i in set(ids) if i >= 0}
        shared: dict[int, int] = {}
        for gram in hits:
            for n in self.holders.get(gram, ()):
                shared[n] = shared.get(n, 0) + 1
        found = []
        for n, count in shared.items():
            own, size = self.templates[n]
            if count >= CONFIRMED * len(own):
                found.extend(self.places(ids, own, size))
        found.sort(reverse=True)
        taken, out = set(), []
        for _, first, last in found:
            if taken.isdisjoint(range(first, last + 1)):
                taken.update(range(first, last + 1))
                out.append((first, last))
        return sorted(out)

    def places(self, ids: list[int], own: set[tuple], size: int) -> Iterator[tuple[int, int, int]]:
        """(weight, first, last) of the stretches of at most about twice a template's length that share enough."""
        need, widest = CONFIRMED * len(own), 2 * size + 8
        letters = {g[0] for g in own if len(g) == 1}
        seen = [(i, g) for i, w in enumerate(ids) if w in letters for k in (1, 2, 3) if (g := tuple(ids[i : i + k])) in own and len(g) == k]
        seen.sort(key=lambda hit: hit[0] + len(hit[1]))
        left, right, counts = 0, 0, {}
        while right < len(seen):
            at, gram = seen[right]
            counts[gram] = counts.get(gram, 0) + 1
            right += 1
            while at + len(gram) - seen[left][0] > widest or counts[seen[left][1]] > 1:
                counts[seen[left][1]] -= 1
                if not counts[seen[left][1]]:
                    del counts[seen[left][1]]
                left += 1
            if len(counts) < need or size > 1 and not any(len(g) > 1 for g in counts):
                continue
            first = min(i for i, _ in seen[left:right])
            last, whole, more = at + len(gram), set(counts), right
            while more < len(seen) and seen[more][0] + len(seen[more][1]) - first <= widest and len(whole) < len(own):
                if seen[more][1] not in whole:
                    whole.add(seen[more][1])
                    last, right = seen[more][0] + len(seen[more][1]), more + 1
                more += 1
            inside = [(i, g) for i, g in seen[left:right] if i + len(g) <= last]
            best = (len(whole) - max(0, last - first - size), first, last - 1)
            for at in sorted({i for i, _ in inside}):  # words far before the rest belong to something else
                shared = len({g for i, g in inside if i >= at})
                if shared >= need:
                    best = max(best, (shared - max(0, last - at - size), at, last - 1))
            yield best
            while right < len(seen) and seen[right][0] < last:
                right += 1
            left, counts = right, {}

    def notices(self, text: str) -> list[tuple[int, int, str, float, float]]:
        """(start, end, family, probability, similarity); places are those of whole lines."""
        rows: list[tuple[int, int, str, float, float]] = []
        block: list[tuple[int, int, list[str]]] = []
        for line in LINE.finditer(text + "\n\n"):
            raw = WORD.findall(line[0])
            if block and (not raw or line.start() != block[-1][1] + 1):
                rows.extend(self.block(text, block))
                block = []
            if raw:
                block.append((line.start(), line.end(), raw))
        return rows + (self.block(text, block) if block else [])

    def block(self, text: str, lines: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, str, float, float]]:
        rows, covered = [], set()
        ids = self.numbers([w for line in lines for w in line[2]])
        found = self.stretches(ids)
        if found:
            owner = [n for n, line in enumerate(lines) for _ in line[2]]
            tokens = [word(w) for line in lines for w in line[2]]
            for first, last in found:
                a, b = owner[first], owner[last]
                label = self.machine.label(tokens[first : last + 1])
                if rows and label[0] == rows[-1][2] and a <= rows[-1][1]:  # a notice that goes on in the same line
                    best = max(label, rows[-1][2:], key=lambda x: x[2])
                    rows[-1] = (rows[-1][0], max(b, rows[-1][1]), *best)
                else:
                    rows.append((a, b, *label))
                covered.update(range(a, b + 1))
            named = {n for a, b, family, *_ in rows if family != UNKNOWN for n in range(a, b + 1)}
            rows = [r for r in rows if r[2] != UNKNOWN or named.isdisjoint(range(r[0], r[1] + 1))]
        start, end = lines[0][0], lines[-1][1]
        if HINT.search(text, start, end):
            rows.extend((n, n, *self.machine.label(words(text[a:b]))) for n, (a, b, _) in enumerate(lines) if n not in covered and HINT.search(text, a, b))
        return [(lines[a][0], lines[b][1], *label) for a, b, *label in sorted(rows)]


def license_notices(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, family, probability, similarity for each notice, and for each line that speaks of a licence.

    Lines without a blank line between them are a block and read as one text; comment marks alone are blank. Every
    block is held against every template and short name, however its lines are wrapped; the classifier then labels
    the stretch that matches. A row's place is that of the whole lines of the stretch, in code points. What matches
    but is no known licence, and any other line with one of the words of ``HINT``, is ``unknown``. Null texts are
    empty; a line that comes up twice gives two rows; repeated documents give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in small_slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.extend((doc, *notice) for notice in finder.notices(text))
            columns = list(zip(*rows)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "start", "end", "family", "probability", "similarity"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, start bigint, end bigint, family string, probability double, similarity double"
    )
