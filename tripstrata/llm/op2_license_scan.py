"""Licence families of paragraphs: a trained sparse n-gram classifier, confirmed by comparison with templates.

A multinomial logistic regression over hashed word 1- to 3-grams tells licence families from an unknown class. It is
trained on seeded variants of the templates and on a bounded sample of the corpus as unknown text. Held-out
examples calibrate it: a temperature makes its probabilities honest, and the least probability accepted keeps the held-out unknown
paragraphs out. Pieces of lines, and pieces over the ends of adjacent lines with words, are judged, in two sizes. A predicted piece counts
only if a template is mostly in or around it, word run by word run; all such notices count, each on words of its own.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import _BASE, mixed, slices, word_hashes

#: Usual notices of licence families.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-only"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
        "Licensed under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ),
    "epl": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0"),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "bsl-1.0": ("Distributed under the Boost Software License, Version 1.0.", "Licensed under the Boost Software License 1.0.", "SPDX-License-Identifier: BSL-1.0"),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 Universal.", "This work is in the public domain."),
    "reserved": ("All rights reserved.", "Copyright 2024. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."),
}
#: Texts near the subject that state no licence.
NEAR_MISSES = (
    "He renewed his driving licence last week.", "The club lost its license to serve drinks.", "The public library is open to the general public.", "Version 3 of the report was released in general terms.",
    "Permission to enter was granted at the gate.", "The Apache tribes lived in the south.", "You may obtain a permit at the office.", "The work is under way and free of charge.", "Students at MIT released a study.", "The fishing licence costs four pounds.",
)

_WORDS = bytes(c + 0x20 if 0x41 <= c <= 0x5A else c if c == 0x0A or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


@dataclass(frozen=True)
class Scan:
    """Paragraphs of the corpus that training sees at most; hashed features; words in a piece, and in a short one; template share confirming."""

    unknown_sample: int = 4_000
    features: int = 1 << 16
    piece: int = 40
    short: int = 10
    confirmed_at: float = 0.7
    false_alarms: float = 0.001
    seed: int = 7


def _featured(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, offset of each text's first) of 1- to 3-grams; a text of no words has none."""
    counts = np.diff(offsets)
    n = 3 * counts - np.minimum(counts, 1) - np.minimum(counts, 2)  # n + (n - 1) + (n - 2), none below zero
    owner = np.repeat(np.arange(len(counts)), counts)
    runs, owners = [words], [owner]
    for k in (2, 3):
        hashed = mixed(runs[-1][: max(0, len(words) - k + 1)] * _BASE + words[k - 1 :])
        runs.append(hashed)
        owners.append(np.where(owner[: len(hashed)] == owner[k - 1 :], owner[: len(hashed)], -1) if len(hashed) else owner[:0])
    value, of = np.concatenate(runs), np.concatenate(owners)
    value, of = value[of >= 0], of[of >= 0]
    order = np.argsort(of, kind="stable")
    return (value[order] % np.uint64(size)).astype(np.int32), np.concatenate(([0], np.cumsum(n)))


@dataclass
class Model:
    families: list[str]
    weights: np.ndarray  # features x (families + unknown)
    bias: np.ndarray
    temperature: float = 1.0
    accepted_at: float = 0.5

    def hopeful(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts whose features could, at best, lift the families together far enough above unknown to be accepted.

        A feature's lift is its largest weight of a family over unknown, so no family's lead exceeds the sum of lifts.
        """
        size = np.uint64(len(self.weights))
        lift = (self.weights[:, :-1] - self.weights[:, -1:]).max(axis=1).astype(np.float64)
        counts = np.diff(offsets)
        n = 3 * counts - np.minimum(counts, 1) - np.minimum(counts, 2)
        owner = np.repeat(np.arange(len(counts)), counts)
        score, run = lift[(words % size).astype(np.int64)], words
        for k in (2, 3):
            run = mixed(run[: max(0, len(words) - k + 1)] * _BASE + words[k - 1 :])
            score[: len(run)] += lift[(run % size).astype(np.int64)] * (owner[: len(run)] == owner[k - 1 :])
        upto = np.concatenate(([0.0], np.cumsum(score)))
        lead = (upto[offsets[1:]] - upto[offsets[:-1]]) / np.sqrt(np.maximum(n, 1)) + (self.bias[:-1] - self.bias[-1]).max()
        return np.flatnonzero((counts > 0) & (lead >= self.temperature * np.log(self.accepted_at / (1 - self.accepted_at) / (len(self.families) - 1)) - 1e-3))

    def probabilities(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at, starts = _featured(words, offsets, len(self.weights))
        n = np.diff(starts)
        sums = np.zeros((len(n), self.weights.shape[1]), np.float32)
        some = n > 0
        if some.any():
            sums[some] = np.add.reduceat(self.weights[at], starts[:-1][some], axis=0)
        logits = (sums / np.sqrt(np.maximum(n, 1))[:, None] + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def variants(scan: Scan, unknown: list[str], each: int = 60) -> tuple[list[str], list[str]]:
    """Seeded training texts and their families ("" for unknown)."""
    rnd = random.Random(scan.seed)
    filler = [w for x in unknown[:500] for w in x.split()[:20]] or ["and", "the"]
    texts, labels = [], []
    for family, templates in TEMPLATES.items():
        for template in templates:
            for _ in range(each):
                words = template.split()
                for _ in range(rnd.choice((0, 0, 0, 1, 1, 2))):
                    at = rnd.randrange(len(words))
                    words[at : at + rnd.choice((0, 1))] = [rnd.choice(filler)] * rnd.choice((0, 1))
                words = rnd.choices(filler, k=rnd.choice((0, 0, 0, 4, 12, 25))) + words + rnd.choices(filler, k=rnd.choice((0, 0, 0, 4, 12, 25)))
                text = " ".join(words)
                texts.append(rnd.choice((text, text, text.lower(), text.upper())))
                labels.append(family)
    for text in (*unknown, *NEAR_MISSES * 20):
        words = text.split()
        size = rnd.choice((scan.piece, scan.short))
        at = rnd.randrange(max(1, len(words) - size + 1))
        texts.append(" ".join(words[at : at + size]))
        labels.append("")
    return texts, labels


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([x.encode().translate(_WORDS).replace(b"\n", b" ") for x in texts], lower=False)


def trained(scan: Scan, unknown: list[str]) -> tuple[Model, float]:
    """The calibrated model, and its accuracy on the held-out fifth of the examples."""
    texts, labels = variants(scan, unknown)
    order = np.random.default_rng(scan.seed).permutation(len(texts))
    cut = len(order) // 5
    families = [*TEMPLATES, ""]
    y = np.array([families.index(x) for x in labels])
    held, own = order[:cut], order[cut:]
    words, offsets = _hashed([texts[i] for i in own])
    at, starts = _featured(words, offsets, scan.features)
    n = np.maximum(np.diff(starts), 1)
    row = np.repeat(np.arange(len(own)), np.diff(starts))
    scale = (1 / np.sqrt(n)).astype(np.float32)
    model = Model(families, np.zeros((scan.features, len(families)), np.float32), np.zeros(len(families), np.float32))
    goal = np.eye(len(families), dtype=np.float32)[y[own]]
    speed = np.full_like(model.weights, 1e-3)
    for _ in range(60):  # full-batch gradient steps with a rate for each weight
        off = (model.probabilities(words, offsets) - goal).astype(np.float32)
        slope = np.zeros_like(model.weights)
        for c in range(len(families)):
            slope[:, c] = np.bincount(at, (off[:, c] * scale)[row], scan.features)
        slope += 1e-3 * model.weights
        speed += slope * slope
        model.weights -= 1.0 * slope / np.sqrt(speed)
        model.bias -= 0.5 * off.mean(axis=0)
    words, offsets = _hashed([texts[i] for i in held])
    loss = {}
    for t in (0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 4.0):
        model.temperature = t
        loss[t] = -np.log(np.maximum(model.probabilities(words, offsets)[np.arange(cut), y[held]], 1e-9)).mean()
    model.temperature = min(loss, key=loss.get)
    p = model.probabilities(words, offsets)
    # Pieces are accepted by the families' sum, of which a piece with two notices gives each a part; no piece falls out by that.
    strays = p[y[held] == len(families) - 1, :-1].max(axis=1, initial=0)
    model.accepted_at = float(max(0.5, np.quantile(strays, 1 - scan.false_alarms) if len(strays) else 0.5))
    return model, float((p.argmax(axis=1) == y[held]).mean())


def _runs(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


_TEMPLATE_RUNS = {f: [_runs(t.encode().translate(_WORDS).split()) for t in ts] for f, ts in TEMPLATES.items()}


def _triples(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of three words."""
    pairs = mixed(words[: max(0, len(words) - 1)] * _BASE + words[1:])
    return mixed(pairs[: max(0, len(pairs) - 1)] * _BASE + words[2:])


_TEMPLATE_TRIPLES = np.unique(np.concatenate([_triples(_hashed([t])[0]) for ts in TEMPLATES.values() for t in ts]))


def _marks(words: np.ndarray) -> np.ndarray:
    """Number of template word runs that start before each word."""
    return np.concatenate(([0], np.cumsum(np.isin(_triples(words), _TEMPLATE_TRIPLES))))


def template_share(family: str, text: bytes) -> float:
    """Largest share of a template's word runs that the text holds."""
    here = _runs(text.translate(_WORDS).split())
    return max(len(t & here) / len(t) for t in _TEMPLATE_RUNS[family])


def like_a_template(text: str) -> bool:
    """Whether the text holds so much of some template that it is no example of unknown text."""
    here = _runs(text.encode().translate(_WORDS).split())
    return any(4 * len(t & here) >= len(t) and len(t & here) >= min(2, len(t)) for ts in _TEMPLATE_RUNS.values() for t in ts)


def notices(words: list[bytes], least: float) -> list[tuple[str, float, int, int]]:
    """(family, template share, first word, end) of all notices in the words, best first, that share no word."""
    left: list[bytes | None] = list(words)
    out = []
    while True:
        runs = [tuple(left[i : i + 3]) for i in range(max(1, len(left) - 2))]
        best: tuple = (0.0, 0)
        for family, templates in _TEMPLATE_RUNS.items():
            for t in templates:
                if not t.isdisjoint(runs):
                    width = len(t) + 2 + len(t) // 2  # room for words put in
                    at = [i for i, r in enumerate(runs) if r in t]
                    for i in at:
                        inside = [j for j in at if i <= j <= i + width - 3]
                        share = len({runs[j] for j in inside}) / len(t)
                        if share >= least and (share, len(t)) > best[:2]:
                            best = (share, len(t), family, i, min(inside[-1] + 3, len(left)))
        if len(best) == 2:
            return out
        share, _, family, start, end = best
        out.append((family, share, start, end))
        left[start:end] = [None] * (end - start)


def _pieces(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets, unit, place of the first word) of pieces of `size` words, every half piece, of which a unit has at least one."""
    counts = np.diff(offsets)
    if counts.max(initial=0) <= size:
        return words, offsets, np.arange(len(counts)), offsets[:-1]
    n = np.maximum(1, -(-(counts - size) // (size // 2)) + 1)
    unit = np.repeat(np.arange(len(counts)), n)
    starts = offsets[:-1][unit] + (np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)) * (size // 2)
    lengths = np.minimum(size, offsets[1:][unit] - starts)
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return words[at], np.concatenate(([0], np.cumsum(lengths))), unit, starts


def _blocks(offsets: np.ndarray, first_line: np.ndarray) -> np.ndarray:
    """Word ends (start, stop) of runs of two or more adjacent lines with words, of one text each."""
    some = np.diff(offsets) > 0
    opens = some.copy()
    opens[1:] &= ~some[:-1]
    opens[first_line[first_line < len(some)]] = some[first_line[first_line < len(some)]]
    block = np.cumsum(opens)[some] - 1
    lines = np.bincount(block, minlength=int(opens.sum()))
    start = offsets[:-1][opens]
    stop = np.append(start[1:], offsets[-1])
    return np.stack((start, stop), axis=1)[lines > 1]


#: Characters of a sampled paragraph that training reads.
TRAINING_CHARS = 2_000


def scan_licenses(docs: DataFrame, scan: Scan = Scan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences stated in each row's text: doc_id, n_paragraphs, n_confirmed, n_unconfirmed, families, paragraphs.

    A paragraph is a line with a word; long ones are judged in overlapping pieces, and so are runs of adjacent lines, over whose ends
    notices may go on; short pieces, for short notices, are judged where they have a word run of a template. `families` are the confirmed ones, sorted; `paragraphs` holds (line_no, family, probability, template_share,
    confirmed) of all predicted lines, once for each family: of a notice over several lines, the first. A null or empty text has none. Null
    or repeated ids keep their rows; other columns are not read. Training reads at most `unknown_sample` paragraphs, those with the
    smallest seeded hashes, of a long one 2,000 characters at a drawn place; every paragraph is then scanned, in one pass without a shuffle.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = rows.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("length(line) > 0").withColumn("h", F.xxhash64(F.lit(scan.seed), "doc_id", "line"))
    subject = F.lower("line").rlike("licen[sc]e|copyright|all rights reserved|public domain|permission")
    # Of a long line a window is learned from, at a place that the hash draws.
    start = F.pmod("h", F.greatest(F.lit(1), F.length("line") - TRAINING_CHARS + 1)).cast("int") + 1
    drawn = lines.where(~subject).select("h", F.substr("line", start, F.lit(TRAINING_CHARS)).alias("line"))
    # Only hashes below a bound that some times as many lines have are sorted, so no task sends more than its part of them.
    share = min(1.0, 4 * scan.unknown_sample / max(1, lines.count()))
    while True:
        low = drawn if share == 1 else drawn.where(F.col("h") < int(share * 2**64) - 2**63)
        sample = low.orderBy("h", "line").limit(scan.unknown_sample).collect()
        if share == 1 or len(sample) == scan.unknown_sample:
            break
        share = min(1.0, 8 * share)
    unknown = [r["line"] for r in sample if not like_a_template(r["line"])]
    model, _ = trained(scan, unknown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [(x or "").encode() for x in batch.column(1).to_pylist()]
            for a, b in slices(texts, 2_000_000):
                yield _scanned(ids.slice(a, b - a), texts[a:b], model, scan)

    return rows.mapInArrow(run, "doc_id bigint, n_paragraphs bigint, n_confirmed bigint, n_unconfirmed bigint, families array<string>, paragraphs array<struct<line_no:int,family:string,probability:double,template_share:double,confirmed:boolean>>")


_FOUND = pa.list_(pa.struct([("line_no", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("template_share", pa.float64()), ("confirmed", pa.bool_())]))


def _scanned(ids: pa.Array, texts: list[bytes], model: Model, scan: Scan) -> pa.RecordBatch:
    split = [x.split(b"\n") for x in texts]
    raw = [line for x in split for line in x]
    words, offsets = word_hashes([line.translate(_WORDS) for line in raw], lower=False)
    first_line = np.cumsum([0, *map(len, split)])
    found: list[dict[tuple[int, str], dict]] = [{} for _ in texts]
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]  # (first line, last line, family) of confirmed notices
    line_of = lambda word: int(np.searchsorted(offsets, word, side="right")) - 1
    lines = np.stack((offsets[:-1], offsets[1:]), axis=1)
    blocks, marks = _blocks(offsets, first_line), _marks(words)
    # Short pieces find short notices, which a long one's other words would outvote. They are made only where a template
    # has a word run in common, without which it can't confirm them.
    for across, size in itertools.product((False, True), (scan.piece, scan.short)):
        units = blocks if across else lines
        if size == scan.short:
            upto = np.minimum(np.maximum(units[:, 1] - 2, units[:, 0]), len(marks) - 1)
            units = units[marks[upto] > marks[np.minimum(units[:, 0], len(marks) - 1)]]
        sizes = np.diff(units, axis=1)[:, 0]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        w, o, of, starts = _pieces(words if units is lines else words[np.repeat(units[:, 0] - upto[:-1], sizes) + np.arange(upto[-1])], upto, size)
        hopeful = model.hopeful(w, o)
        lengths = np.diff(o)[hopeful]
        ends = np.cumsum(lengths)
        p = model.probabilities(w[np.repeat(o[hopeful] - (ends - lengths), lengths) + np.arange(lengths.sum())], np.concatenate(([0], ends)))
        for k in np.flatnonzero(1 - p[:, -1] >= model.accepted_at):
            start, stop = units[of[hopeful[k]]]
            at = int(starts[hopeful[k]] - upto[of[hopeful[k]]] + start)
            end = at + int(lengths[k])
            if across and line_of(at) == line_of(end - 1):
                continue  # judged as a piece of its line
            # Notices may begin before the piece or end after it; the longest, with words put in, fits beside it.
            low, high = max(int(start), at - 3 * scan.piece // 2), min(int(stop), end + 3 * scan.piece // 2)
            one, two = line_of(low), line_of(high - 1)
            near = b" ".join(x.translate(_WORDS) for x in raw[one : two + 1]).split()[low - offsets[one] : high - offsets[one]]
            d = int(np.searchsorted(first_line, one, side="right")) - 1
            # What lies apart from the piece may be cut, and has pieces of its own.
            sure = [x for x in notices(near, scan.confirmed_at) if low + x[2] < end and low + x[3] > at]
            for family, share, i, j in sure:
                line, last = line_of(low + i) - int(first_line[d]), line_of(low + j - 1) - int(first_line[d])
                entry = {"line_no": line, "family": family, "probability": float(p[k, model.families.index(family)]), "template_share": share, "confirmed": True}
                old = found[d].get((line, family))
                if old is None or (True, share, entry["probability"]) > (old["confirmed"], old["template_share"], old["probability"]):
                    found[d][line, family] = entry
                spans[d].append((line, last, family))
            best = int(p[k, :-1].argmax())
            family, covered = model.families[best], range(line_of(at) - int(first_line[d]), line_of(end - 1) - int(first_line[d]) + 1)
            old = [found[d][x, family] for x in covered if (x, family) in found[d]]
            if not sure and (not old or (not across and not old[0]["confirmed"] and old[0]["probability"] < p[k, best])):
                found[d][covered[0], family] = {"line_no": covered[0], "family": family, "probability": float(p[k, best]), "template_share": template_share(family, b" ".join(near)), "confirmed": False}
    for d, confirmed in enumerate(spans):
        found[d] = {x: e for x, e in found[d].items() if e["confirmed"] or not any(a <= x[0] <= b for a, b, _ in confirmed)}
    sure = [[e for e in f.values() if e["confirmed"]] for f in found]
    has_word = np.add.reduceat((np.diff(offsets) > 0).astype(np.int64), first_line[:-1]) if len(raw) else np.zeros(0, np.int64)
    return pa.record_batch(
        [ids, pa.array(has_word), pa.array([len(s) for s in sure], pa.int64()), pa.array([len(f) - len(s) for f, s in zip(found, sure, strict=True)], pa.int64()),
         pa.array([sorted({e["family"] for e in s}) for s in sure], pa.list_(pa.string())), pa.array([list(f.values()) for f in found], _FOUND)],
        names=["doc_id", "n_paragraphs", "n_confirmed", "n_unconfirmed", "families", "paragraphs"],
    )
