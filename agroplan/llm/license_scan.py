"""Licence scan: a trained paragraph classifier with an unknown class, confirmed against templates.

Features are hashed word 1-grams and 2-grams (A-Z lower-cased, words of letters, digits and all beyond
ASCII), counts over the square root of their number. A multinomial logistic regression is trained on
noisy, embedded and cut copies of the families' notices and, as ``unknown``, on windows of at most
``sample`` paragraphs of the corpus and on sentences that use licence words otherwise. On notices
that were held out as a whole the scores get a temperature (least log loss), and the threshold is set so
that at most ``false_rate`` of held-out unknown rows pass it; the model is then fitted on all notices.

Scored are every paragraph (a line with a word) and word windows of the lengths ``WINDOWS`` at every
quarter of their length over each whole text, so that neither line breaks (nor the marks of comments)
nor the text around a notice matter. Windows over the threshold that overlap make a region. In a region
and ``REACH`` words around it a family is confirmed where enough word pairs of one of its notices lie
close together, half of those that tell it from all other families and its version numbers among them; of
overlapping places the one counts whose pairs fit the notice best. Short names count beside a notice. The classifier counts the ``VARIETIES`` of a family as the family.

All texts are scored, in vectorised steps with the weights (at most ``BUCKETS`` times families) broadcast. Null, empty and wordless texts have no paragraph and get no family; repeated rows and null
ids get results of their own; equal scores go to the earlier family, equal fits to the shorter and then
the earlier place; no documents give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, as_bytes, release, steps, window_hashes, word_hashes

BUCKETS = 1 << 18
WINDOWS, REACH = (4, 8, 16, 32), 48
UNKNOWN = "unknown"
#: Notices by family, as their licences word them or as they are commonly abridged. Fixed values.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "This project is released under the Apache 2.0 license."],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.", "Released under the GNU GPL v3.", "Released under the GNU GPL v2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Released under the BSD 3-Clause License.", "Released under the BSD 2-Clause License.", "Licensed under the BSD license."],
    "ISC": ["Released under the ISC License.", "Licensed under the ISC license.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Licensed under the Creative Commons Zero 1.0 Universal Public Domain Dedication."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Released under the Mozilla Public License 2.0."],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0.", "Released under the Eclipse Public License 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Zlib": ["Released under the zlib License.", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "reserved": ["All rights reserved.", "Copyright (c) the authors. All rights reserved.", "No part of this publication may be reproduced without written permission of the publisher."],
}
#: Licences that differ from a family by a word or two: the family that the classifier takes them for, and their notices. Fixed values.
VARIETIES = {
    "LGPL": ("GPL", ["This work is licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.", "Released under the GNU LGPL v3."]),
    "AGPL": ("GPL", ["This work is licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.", "Released under the GNU AGPL v3."]),
    **{
        f"CC-{short}": (family, [f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons Attribution-{name} 4.0 International License."])
        for family, short, name in (("CC-BY", "BY-SA", "ShareAlike"), ("CC-BY", "BY-ND", "NoDerivatives"), ("CC-BY-NC", "BY-NC-SA", "NonCommercial-ShareAlike"), ("CC-BY-NC", "BY-NC-ND", "NonCommercial-NoDerivatives"))
    },
}
#: Identifiers of the SPDX list by family or variety. Fixed values.
IDENTIFIERS = {
    "Apache-2.0": "Apache-2.0", "MIT": "MIT", "GPL": "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later", "LGPL": "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later", "AGPL": "AGPL-3.0-only AGPL-3.0-or-later", "BSD": "BSD-2-Clause BSD-3-Clause", "ISC": "ISC",
    "CC-BY-NC": "CC-BY-NC-4.0", "CC-BY": "CC-BY-4.0", "CC-BY-SA": "CC-BY-SA-4.0", "CC-BY-ND": "CC-BY-ND-4.0", "CC-BY-NC-SA": "CC-BY-NC-SA-4.0", "CC-BY-NC-ND": "CC-BY-NC-ND-4.0", "CC0": "CC0-1.0", "MPL": "MPL-2.0", "EPL": "EPL-1.0 EPL-2.0", "Unlicense": "Unlicense", "Zlib": "Zlib",
}
#: Short names, which count only beside a notice that is confirmed ("... or the MIT license"). Fixed values.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"], "MIT": ["MIT license"], "GPL": ["GNU General Public License", "GNU GPL"], "LGPL": ["GNU Lesser General Public License", "GNU LGPL"], "AGPL": ["GNU Affero General Public License", "GNU AGPL"],
    "BSD": ["BSD license", "BSD 3-Clause License", "BSD 2-Clause License"], "ISC": ["ISC license"], "CC-BY": ["CC BY 4.0"], "CC0": ["CC0 1.0"], "MPL": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0"], "EPL": ["Eclipse Public License 2.0"], "Zlib": ["zlib license"],
}
#: Words that may stand between a confirmed notice and a short name.
BESIDE = 4
_PLAIN = [*NOTICES.items(), *((v, n) for v, (_, n) in VARIETIES.items())]
#: Also confirmed and trained on: earlier versions of the Creative Commons licences, and the identifiers' lines.
WORDED = {
    family: notices
    + [n.replace("4.0 International", f"{v} {port}").replace("4.0", v) for v, port in (("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")) for n in notices if family.startswith("CC-")]
    + [f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS.get(family, "").split()]
    for family, notices in _PLAIN
}
OTHERWISE = [
    "The new version was released under pressure from the public.", "He lost his driving license in general traffic.", "Work is licensed by the city and permitted on weekends.", "The rights of the people are reserved for the court to decide.",
    "She was granted permission to copy the documents.", "The license fee rose by two percent.", "All seats are reserved for members.", "A public foundation for creative work in common.", "Version two of the software was free.",
]


def features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of all lines' n-grams, their bounds by line, and each line's number of words."""
    words, bounds = word_hashes(lines, alnum_words())
    if not len(words):
        return np.empty(0, np.int64), np.zeros(len(lines) + 1, np.int64), np.zeros(len(lines), np.int64)
    counts = np.diff(bounds)
    pairs = window_hashes(words, 2) if len(words) > 1 else np.empty(0, np.uint64)
    line = np.repeat(np.arange(len(lines)), counts)
    inside = line[:-1] == line[1:]
    owner = np.concatenate([line, line[:-1][inside]])
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate([words, pairs[inside]])[order] % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lines)))]), counts


def _calibrated(model: dict, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Probabilities by row and class from the summed weights of the rows' ``n`` features."""
    logits = (sums / np.sqrt(np.maximum(1, n))[:, None] + model["bias"]) / model["temperature"]
    if len(logits):
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _sums(model: dict, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights by line and class, and each line's number of features."""
    buckets, bounds, _ = features(lines)
    sums = np.zeros((len(buckets) + 1, model["weights"].shape[1]))
    np.cumsum(model["weights"][model["place"][buckets]], axis=0, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds)


def _windows(bounds: np.ndarray):
    """``(start, end)`` of the word windows of texts with the words [bounds[i], bounds[i+1]); no window is empty."""
    first, last = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0]
    at = np.arange(bounds[-1])
    rel, left = at - np.repeat(first, last - first), np.repeat(last, last - first) - at
    for size in WINDOWS:
        inner = at[(rel % (size // 4) == 0) & (left >= size)]
        yield np.concatenate([inner, np.maximum(first, last - size)]), np.concatenate([inner + size, last])


def _hits(model: dict, words: np.ndarray, pairs: np.ndarray, lines: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Rows (start, end, class, score) of the lines and windows over the threshold, by start."""
    width = model["weights"].shape[1]
    one, two = np.zeros((len(words) + 1, width)), np.zeros((len(pairs) + 1, width))
    np.cumsum(model["weights"][model["place"][words % np.uint64(BUCKETS)]], axis=0, out=one[1:])
    np.cumsum(model["weights"][model["place"][pairs % np.uint64(BUCKETS)]], axis=0, out=two[1:])
    hits = []
    full = np.diff(lines) > 0
    for start, end in [(lines[:-1][full], lines[1:][full]), *_windows(texts)]:
        p = _calibrated(model, one[end] - one[start] + two[end - 1] - two[start], 2 * (end - start) - 1)
        top = p[:, :-1].max(axis=1)
        over = np.flatnonzero(top >= model["threshold"])
        hits.append(np.stack([start[over], end[over], p[over, :-1].argmax(axis=1), top[over]], axis=1))
    hits = np.concatenate(hits)
    return hits[np.lexsort((hits[:, 1], hits[:, 0]))]


def training_rows(negatives: list[str], copies: int = 24, seed: int = 7) -> list[tuple[str, str, str]]:
    """``(family, paragraph, notice)``: the notices with words lost, added and put around, cut to windows, and the unknown rows.

    The copies of a notice name it, so that it can be held out as a whole; unknown rows name themselves.
    """
    draw, rows = random.Random(seed), []
    fillers = [w for text in negatives for w in text.split()] or ["the"]
    taken_for = {family: family for family in NOTICES} | {variety: family for variety, (family, _) in VARIETIES.items()}
    for worded, notices in WORDED.items():
        family = taken_for[worded]
        for notice in notices:
            rows.append((family, notice, notice))
            for copy in range(copies):
                words = [w for w in notice.split() if draw.random() > 0.08]
                around = len(words) if copy % 2 else 3
                if copy % 4 == 3:
                    size = draw.choice([size for size in WINDOWS if size >= min(16, len(words) // 2)])
                    at = draw.randrange(max(1, len(words) - size + 1))
                    words, around = words[at : at + size], max(0, size - len(words)) // 2
                words = [*draw.choices(fillers, k=draw.randrange(around + 1)), *words, *draw.choices(fillers, k=draw.randrange(around + 1))]
                rows.append((family, " ".join(words), notice))
    rows += [(UNKNOWN, text, text) for text in [*negatives, *OTHERWISE * (copies // 4)]]
    for text in negatives:
        words, size = text.split(), draw.choice(WINDOWS)
        at = draw.randrange(max(1, len(words) - size + 1))
        rows.append((UNKNOWN, " ".join(words[at : at + size]), text))
    return rows


def unknown_rows(docs: DataFrame, text_col: str, sample: int) -> list[str]:
    """A window of words of at most ``sample`` distinct paragraphs, drawn by hash over the whole corpus.

    The share of the paragraphs that is looked at follows from their number, so that about 1.5 times
    ``sample`` windows of at most the longest of ``WINDOWS`` reach the driver, however large the corpus is.
    """
    text = F.col(text_col)
    total = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).withColumn("h", F.xxhash64("line"))
    share = int(min(1.0, 1.5 * sample / max(1, total)) * (1 << 40))
    drawn = lines.where(F.pmod("h", F.lit(1 << 40)) < share).withColumn("words", F.array_remove(F.split("line", r"[\x20\x09-\x0D]+"), "")).where(F.size("words") > 0)
    size = F.get(F.array(*map(F.lit, WINDOWS)), F.pmod("h", F.lit(len(WINDOWS))).cast("int"))
    first = F.pmod(F.shiftright("h", 8), F.greatest(F.size("words") - size + 1, F.lit(1))).cast("int") + 1
    rows = drawn.select("h", F.array_join(F.slice("words", first, size), " ").alias("window")).distinct().collect()
    return [r["window"] for r in sorted(rows)[:sample]]


def train(docs: DataFrame, text_col: str = "text", sample: int = 4000, false_rate: float = 0.001) -> dict:
    """Weights, bias, temperature, threshold and class names; ``sample`` bounds the corpus rows used.

    The regression is fitted on the features that two or more training rows have; all others weigh
    nothing and share the last row of ``weights``, to which ``place`` leads from a bucket.
    """
    spark: SparkSession = docs.sparkSession
    classes = [*NOTICES, UNKNOWN]
    rows = training_rows([n for n in unknown_rows(docs, text_col, sample) if not confirmed(n)])
    random.Random(1).shuffle(rows)
    aside = held_out_notices()
    apart = [r[2] in aside or (r[0] == UNKNOWN and int.from_bytes(hashlib.sha1(r[2].encode()).digest()[:4]) % 5 == 0) for r in rows]
    # temperature and threshold from notices that the model never saw; then the same fit on all of them
    frame, place = _vectors(spark, rows, apart, classes)
    release()
    weights, bias = _fitted(frame.where("not held"))
    model = {"weights": weights, "place": place, "bias": bias, "temperature": 1.0, "classes": classes}
    held = [r for r, out in zip(rows, apart, strict=True) if out]
    truth = np.array([classes.index(r[0]) for r in held])
    sums, n = _sums(model, [r[1].encode() for r in held])
    losses = {}
    for temperature in np.geomspace(0.25, 4, 17):
        p = _calibrated(model | {"temperature": temperature}, sums, n)
        losses[temperature] = -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()
    model["temperature"] = min(losses, key=losses.get)
    p = _calibrated(model, sums, n)
    false = np.sort(p[truth == len(classes) - 1, :-1].max(axis=1))
    model["threshold"] = max(0.5, float(false[min(len(false) - 1, int(len(false) * (1 - false_rate)))])) if len(false) else 0.5
    picked = np.where(p[:, :-1].max(axis=1) >= model["threshold"], p[:, :-1].argmax(axis=1), len(classes) - 1)
    model["held_out_accuracy"] = float((picked == truth).mean())
    del rows, held, sums, p
    release()
    model["weights"], model["bias"] = _fitted(frame)
    return model


def held_out_notices() -> set[str]:
    """Of each family or variety with four notices or more, every fourth: whole notices that calibrate."""
    return {n for notices in WORDED.values() for n in notices[3::4]}


def _vectors(spark: SparkSession, rows: list[tuple], apart: list[bool], classes: list[str]) -> tuple[DataFrame, np.ndarray]:
    """``(label, features, held)`` of ``(family, paragraph, ..)``, and the feature of each bucket: those of two or more rows in order, then one for all others."""
    buckets, bounds, _ = features([r[1].encode() for r in rows])
    each = [np.unique(buckets[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    seen = np.flatnonzero(np.bincount(np.concatenate([at for at, _ in each]), minlength=BUCKETS) > 1)
    place = np.full(BUCKETS, len(seen), dtype=np.int32)
    place[seen] = np.arange(len(seen))
    out = []
    for row, held, (at, n), size in zip(rows, apart, each, np.diff(bounds), strict=True):
        kept = place[at] < len(seen)
        out.append((float(classes.index(row[0])), SparseVector(len(seen), place[at[kept]].tolist(), (n[kept] / np.sqrt(max(1, size))).tolist()), held))
    return spark.createDataFrame(out, ["label", "features", "held"]).repartition(4), place


def _fitted(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights by feature and class, with a last row of zeros, and the classes' biases."""
    fitted = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-4, standardization=False).fit(frame)
    weights = fitted.coefficientMatrix.toArray().T.astype(np.float32)
    return np.concatenate([weights, np.zeros_like(weights[:1])]), fitted.interceptVector.toArray()


def _pairs(texts: list[str]) -> list[list[int]]:
    words, bounds = word_hashes([t.encode() for t in texts], alnum_words())
    return [window_hashes(words[a:b], 2).tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _notices() -> tuple[list[tuple], dict[int, list[int]]]:
    """``(family, pairs, own pairs, longest span, versions)`` of every notice, and the notices of every word pair.

    Own pairs have a word that no other family's notice has; where there are none, no other family's
    notice has the pair. ``versions``: for each number in the notice, the pairs with it.
    """
    flat = [(family, notice) for family, notices in WORDED.items() for notice in notices]
    words, bounds = word_hashes([notice.encode() for _, notice in flat], alnum_words())
    listed, families = [], {}
    for (family, _), a, z in zip(flat, bounds[:-1], bounds[1:], strict=True):
        listed.append((family, dict(zip(window_hashes(words[a:z], 2).tolist(), zip(words[a:z].tolist(), words[a + 1 : z].tolist(), strict=False), strict=True))))
    holders: dict[int, list[int]] = {}
    for i, (family, pairs) in enumerate(listed):
        for pair, two in pairs.items():
            holders.setdefault(pair, []).append(i)
            for key in (pair, *two):
                families.setdefault(key, set()).add(family)
    table = []
    numbers = set(word_hashes([str(i).encode() for i in range(100)] + [f"v{i}".encode() for i in range(100)], alnum_words())[0].tolist())
    for family, pairs in listed:
        named = frozenset(p for p, two in pairs.items() if any(len(families[w]) == 1 for w in two))
        own = named or frozenset(p for p in pairs if len(families[p]) == 1)
        versions = [frozenset(p for p, two in pairs.items() if w in two) for w in {w for two in pairs.values() for w in two} & numbers]
        table.append((family, frozenset(pairs), own, len(pairs) + len(pairs) // 2 + 2, versions))
    return table, holders


TABLE, HOLDERS = _notices()
#: Short names by their first pair: family and pairs.
SHORT: dict[int, list[tuple[str, list[int]]]] = {}
for _family, _pairs_of in ((f, p) for f, names in NAMES.items() for p in _pairs(names)):
    SHORT.setdefault(_pairs_of[0], []).append((_family, _pairs_of))


def matches(pairs: list[int], least: float = 0.6) -> list[tuple[str, int, int, float]]:
    """``(family, first, last, fit)``: where at least ``least`` of a notice's word pairs lie close together.

    ``fit`` is the Jaccard similarity of the notice's pairs and those of the place. For each end the start
    of the best fit counts, so that a place does not reach back to words that it shares with another
    notice; of places that overlap the best fit stays. Half of the pairs that tell the family from all
    others have to be there, and every number of the notice (its version). A short name (``NAMES``) counts
    beside a confirmed notice, with at most ``BESIDE`` words between them.
    """
    places: dict[int, list[tuple[int, int]]] = {}
    for at, pair in enumerate(pairs):
        for i in HOLDERS.get(pair, ()):
            places.setdefault(i, []).append((at, pair))
    found = []
    for i, seen in places.items():
        family, all_, own, span, versions = TABLE[i]
        if len({pair for _, pair in seen}) < least * len(all_):
            continue
        for k, (at, _) in enumerate(seen):
            held: set[int] = set()
            best = None
            for first, pair in reversed(seen[: k + 1]):
                if at - first >= span:
                    break
                held.add(pair)
                if len(held) >= least * len(all_) and 2 * len(held & own) >= len(own) and all(v & held for v in versions):
                    fit = len(held) / (len(all_) + at - first + 1 - len(held))
                    if best is None or fit > best[3]:
                        best = (family, first, at, fit)
            if best:
                found.append(best)
    taken: list[tuple[str, int, int, float]] = []
    for match in sorted(found, key=lambda m: (-m[3], m[1] - m[2], m[1], m[0])):
        if all(match[2] < t[1] or match[1] > t[2] for t in taken):
            taken.append(match)
    if taken:
        named = [(family, at, at + len(name) - 1, 1.0) for at, pair in enumerate(pairs) for family, name in SHORT.get(pair, ()) if pairs[at : at + len(name)] == name]
        named = sorted((m for m in named if all(m[2] < t[1] or m[1] > t[2] for t in taken)), key=lambda m: (m[1] - m[2], m[1], m[0]))
        beside = True
        while beside:
            beside = [m for m in named if any(-1 <= gap <= BESIDE + 1 for t in taken for gap in (m[1] - t[2] - 1, t[1] - m[2] - 1)) and all(m[2] < t[1] or m[1] > t[2] for t in taken)][:1]
            taken += beside
    return sorted(taken, key=lambda m: m[1])


def confirmed(text: str) -> list[str]:
    """The families with a confirmed notice in the text."""
    return sorted({family for family, *_ in matches(_pairs([text])[0])})


def _found(model: dict, hits: np.ndarray, pairs: np.ndarray, text: tuple[int, int]) -> list[tuple]:
    """``(word, family, score, confirmed)`` of each confirmed notice, and of each region without one."""
    regions: list[list] = []
    for start, end, kind, score in hits.tolist():
        if regions and start < regions[-1][1]:
            last = regions[-1]
            last[1] = max(last[1], end)
            last[2:] = max((last[3], last[2]), (score, kind))[::-1]
        else:
            regions.append([start, end, kind, score])
    found, sure = [], set()
    for start, end, kind, score in regions:
        low, high = max(text[0], int(start) - REACH), min(text[1], int(end) + REACH)
        near = [(family, low + a, low + z) for family, a, z, _ in matches(pairs[low : max(low, high - 1)].tolist()) if low + a < end and low + z >= start - 1]
        for family, a, z in near:
            if (family, a, z) not in sure:
                sure.add((family, a, z))
                found.append((a, family, score, True))
        if not near:
            found.append((int(start), model["classes"][int(kind)], score, False))
    return found


def scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_paragraphs, n_predicted, n_confirmed, families, score, found)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in steps(batches, limit=1 << 20):
            split = [t.split(b"\n") for t in as_bytes(batch.column(1))]
            words, lines = word_hashes([x for s in split for x in s], alnum_words())
            first = np.concatenate([[0], np.cumsum([len(s) for s in split])])
            texts, full = lines[first], np.diff(lines) > 0
            pairs = window_hashes(words, 2) if len(words) > 1 else np.empty(0, np.uint64)
            hits = _hits(m, words, pairs, lines, texts)
            at, rows = np.searchsorted(hits[:, 0], texts), []
            for i, doc in enumerate(batch.column(0).to_pylist()):
                places = _found(m, hits[at[i] : at[i + 1]], pairs, (int(texts[i]), int(texts[i + 1])))
                found = [{"line": int(np.searchsorted(lines, word, side="right")) - 1 - int(first[i]), "family": family, "score": score, "confirmed": sure} for word, family, score, sure in places]
                sure = [f for f in found if f["confirmed"]]
                rows.append({"doc_id": doc, "n_paragraphs": int(full[first[i] : first[i + 1]].sum()), "n_predicted": len(found), "n_confirmed": len(sure), "families": sorted({f["family"] for f in sure}), "score": max((f["score"] for f in sure), default=None), "found": found})
            yield pa.RecordBatch.from_pylist(rows, schema)

    one = pa.struct([("line", pa.int64()), ("family", pa.string()), ("score", pa.float64()), ("confirmed", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_paragraphs", pa.int64()), ("n_predicted", pa.int64()), ("n_confirmed", pa.int64()), ("families", pa.list_(pa.string())), ("score", pa.float64()), ("found", pa.list_(one))])
    kinds = "doc_id long, n_paragraphs long, n_predicted long, n_confirmed long, families array<string>, score double, found array<struct<line:long,family:string,score:double,confirmed:boolean>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, kinds)
