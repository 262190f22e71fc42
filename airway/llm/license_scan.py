"""Licence notices in documents: a trained paragraph classifier, confirmed by templates.

Paragraphs are sets of word n-grams. A logistic regression over the n-grams of known
notices, and over where these meet words that are in none, names the licence family or
``unknown``; its scores are calibrated on notices and paragraphs it was not fitted on. A
found family is confirmed by comparison with its templates, above all with what only
templates of this family say.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, code_points, map_batches, plain_words
from airway.sources.staging import Work, session_work

# What notices of the licence families say.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "Distributed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Released under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is distributed under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
    ],
    "isc": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
}
# Sentences on licences that are no notice, and notices of families that are not told apart.
OTHER = [
    "Licensed under the Eclipse Public License 2.0.",
    "This program is made available under the terms of the Eclipse Public License v1.0.",
    "The contents of this file are subject to the Common Development and Distribution License.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This font is licensed under the SIL Open Font License, Version 1.1.",
    "Released under the Microsoft Public License.",
    "This database is made available under the Open Database License.",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: CDDL-1.0",
    "SPDX-License-Identifier: EUPL-1.2",
    "SPDX-License-Identifier: OFL-1.1",
    "Released under the Q Public License, version 1.0.",
    "Distributed under the terms of the Common Public License.",
    "Permission is hereby granted to enter the building with a copy of this letter.",
    "All rights reserved.",
    "A driving license is required for this job, and the licence must be valid.",
    "The terms of service are subject to change without notice.",
    "The city released the new version of its public plan under pressure.",
    "You may not use this form except with permission of the office.",
    "This work is part of a larger project on software and public law.",
    "The free software movement began at a university.",
    "He graduated from MIT and joined the Apache helicopter program.",
]
UNKNOWN = "unknown"
# Paragraphs of the corpus that stand for ``unknown`` in the fit, at most.
SAMPLE = 3000
NGRAMS = 3
VARIANTS = 24
# Share of a template's n-grams that a paragraph must hold to be confirmed.
CONFIRM = 0.5
# Probability from which the model names a family.
SURE = 0.5
# Words beside a run of words that the model sees with it.
AROUND = 2
# Stands for any word that no template holds.
FOREIGN = b"\0"


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def grams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {g for n in range(1, NGRAMS + 1) for g in zip(*(words[i:] for i in range(n)))}


@dataclass
class LicenseModel:
    families: list[str]
    places: dict[tuple[bytes, ...], int]
    weights: np.ndarray
    temperature: float
    templates: dict[str, list[frozenset]]

    def __post_init__(self):
        self.listed = [t for ts in self.templates.values() for t in ts]
        families: dict[tuple[bytes, ...], set[str]] = {}
        for family, ts in self.templates.items():
            for t in ts:
                for g in t:
                    families.setdefault(g, set()).add(family)
        self.own = {t: frozenset(g for g in t if len(families[g]) == 1) for t in self.listed}
        self.holders: dict[tuple[bytes, ...], list[int]] = {}
        for i, t in enumerate(self.listed):
            for g in t:
                self.holders.setdefault(g, []).append(i)

    def known(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Place and text of every n-gram of the words that is in a template."""
        places = self.places
        for i, word in enumerate(words):
            if (word,) in places:
                for n in range(1, NGRAMS + 1):
                    g = tuple(words[i : i + n])
                    if len(g) < n or g not in places:
                        break
                    yield i, g

    def notices(self, words: list[bytes], confirm: float) -> list[tuple[int, int, str, float, float]]:
        """``first, end, family, probability, likeness`` of the runs of words, as long as a
        template and with a share of ``confirm`` of its n-grams, that the model names. Of
        runs that overlap the likest, then the longest stays."""
        held = list(self.known(words))
        shared = Counter(i for g in {g for _, g in held} for i in self.holders[g])
        found = []
        for i, n in shared.items():
            if n >= confirm * len(self.listed[i]):
                for first, end in _runs(held, self.listed[i], len(words), confirm):
                    family, probability = self.predict(words[max(0, first - AROUND) : end + AROUND])
                    like = self.likeness(family, words[first:end])
                    if family != UNKNOWN and probability >= SURE and like >= confirm:
                        found.append((first, end, family, probability, like))
        kept: list = []
        ends: list[int] = []
        for run in sorted(found, key=lambda r: (-r[4], r[0] - r[1], -r[3], r[0])):
            at = bisect_left(ends, run[0] + 1)
            if at == len(ends) or kept[at][0] >= run[1]:
                ends.insert(at, run[1])
                kept.insert(at, run)
        return kept

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, float]:
        """Known n-grams of a paragraph and the value each has (long paragraphs dilute).
        They lie in runs of known words, so only these are taken apart."""
        places, run, seen = self.places, [], set()
        last = None
        for word in [*words, None]:
            if word is not None and (word,) in places:
                if not run and last is not None:
                    run.append(FOREIGN)
                run.append(word)
            elif run:
                seen |= grams(run if word is None else [*run, FOREIGN])
                run = []
            last = word
        found = sorted(places[g] for g in seen if g in places)
        return np.array(found, int), 1 / max(1.0, NGRAMS * len(words)) ** 0.5

    def predict(self, words: list[bytes]) -> tuple[str, float]:
        found, value = self.inputs(words)
        margins = (self.weights[-1] + self.weights[found].sum(0) * value) / self.temperature
        odds = np.exp(margins - margins.max())
        best = int(odds.argmax())
        return self.families[best], float(odds[best] / odds.sum())

    def likeness(self, family: str, words: list[bytes]) -> float:
        """Greatest share of a template of the family that the words hold: of all its n-grams,
        or of those that no other family has, whichever is smaller."""
        held = grams(words)

        def share(part: frozenset) -> float:
            return len(held & part) / len(part) if part else 1.0

        return max((min(share(t), share(self.own[t])) for t in self.templates.get(family, ())), default=0.0)


def _runs(held: list, template: frozenset, n_words: int, confirm: float) -> Iterator[tuple[int, int]]:
    """The first best of each group of overlapping windows, of the template's length, that
    hold the share of its n-grams."""
    size = sum(len(g) == NGRAMS for g in template) + NGRAMS - 1
    places = [(i, g) for i, g in held if g in template]
    by_end = sorted(range(len(places)), key=lambda k: places[k][0] + len(places[k][1]))
    inside: Counter = Counter()
    entered = bytearray(len(places))
    best: tuple[int, int] | None = None
    left = come = 0
    for start in sorted({i for i, _ in places}):
        while places[left][0] < start:
            if entered[left]:
                g = places[left][1]
                inside[g] -= 1
                if not inside[g]:
                    del inside[g]
            left += 1
        while come < len(by_end) and places[by_end[come]][0] + len(places[by_end[come]][1]) <= start + size:
            i, g = places[by_end[come]]
            if i >= start:
                inside[g] += 1
                entered[by_end[come]] = 1
            come += 1
        if best and start >= best[1] + size:
            yield best[1], min(n_words, best[1] + size)
            best = None
        if len(inside) >= confirm * len(template) and (best is None or len(inside) > best[0]):
            best = len(inside), start
    if best:
        yield best[1], min(n_words, best[1] + size)


def _variants(rng, words: list[bytes], filler: list[bytes]) -> Iterable[list[bytes]]:
    yield words
    for _ in range(VARIANTS):
        kept = [w for w in words if rng.random() > 0.12] or words
        around = [filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 9))]
        cut = rng.integers(0, len(around) + 1)
        yield around[:cut] + kept + around[cut:]


def fit(paragraphs: list[list[bytes]], seed: int = 5) -> LicenseModel:
    """Multinomial logistic regression on variants of the templates and on ``paragraphs``
    of the corpus, which count as unknown unless a template is found in them. Every
    fourth example is kept aside to choose the temperature by its likelihood."""
    rng = np.random.default_rng(seed)
    texts = {f: [plain_words(t.encode()) for t in ts] for f, ts in TEMPLATES.items()}
    templates = {f: [frozenset(grams(w)) for w in ws] for f, ws in texts.items()}
    families = [*texts, UNKNOWN]
    known = {g for ts in templates.values() for t in ts for g in t}
    edges = {e for g in known if len(g) < NGRAMS for e in ((FOREIGN, *g), (*g, FOREIGN))}
    places = {g: i for i, g in enumerate(sorted(known | edges))}
    model = LicenseModel(families, places, np.zeros((len(places) + 1, len(families))), 1.0, templates)
    other = [p for p in paragraphs if p and all(model.likeness(f, p) < CONFIRM for f in texts)]
    filler = [w for p in other for w in p][:20_000] or [b"text"]
    examples = [(v, k) for k, f in enumerate(texts) for w in texts[f] for v in _variants(rng, w, filler)]
    examples += [(p, len(texts)) for p in other]
    examples += [(v, len(texts)) for t in OTHER for v in _variants(rng, plain_words(t.encode()), filler)]
    rng.shuffle(examples)
    made = [(*model.inputs(w), k) for w, k in examples]
    held, used = made[::4], [m for i, m in enumerate(made) if i % 4]
    squares = np.full_like(model.weights, 1e-3)
    for _ in range(12):
        for places_, value, k in (used[i] for i in rng.permutation(len(used))):
            margins = model.weights[-1] + model.weights[places_].sum(0) * value
            odds = np.exp(margins - margins.max())
            error = odds / odds.sum()
            error[k] -= 1
            rows = np.append(places_, len(places))
            step = np.outer(np.append(np.full(len(places_), value), 1.0), error) + 1e-5 * model.weights[rows]
            squares[rows] += step**2
            model.weights[rows] -= 0.3 * step / np.sqrt(squares[rows])

    def loss(temperature: float) -> float:
        total = 0.0
        for places_, value, k in held:
            margins = (model.weights[-1] + model.weights[places_].sum(0) * value) / temperature
            total += float(np.log(np.exp(margins - margins.max()).sum()) + margins.max() - margins[k])
        return total

    model.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return model


def word_spots(line: bytes) -> list[tuple[int, int]]:
    """Start and end of each of the ``plain_words`` of a line in code points."""
    spots, seen, done = [], 0, 0
    for m in _WORD.finditer(line):
        seen += code_points(line[done : m.start()])
        done = m.end()
        spots.append((seen, seen + code_points(m[0])))
        seen = spots[-1][1]
    return spots


@dataclass
class Line:
    number: int
    start: int
    size: int
    text: bytes
    words: list[bytes]


def paragraphs(text: bytes) -> Iterator[list[Line]]:
    """The runs of lines with words; ``start`` and ``size`` in code points."""
    held, at = [], 0
    for number, raw in enumerate(text.split(b"\n")):
        line = Line(number, at, code_points(raw), raw, plain_words(raw))
        if line.words:
            held.append(line)
        elif held:
            yield held
            held = []
        at += line.size + 1
    if held:
        yield held


def _named(model: LicenseModel, lines: list[Line], confirm: float) -> Iterator[tuple]:
    """``paragraph, start, end, family, probability, likeness, confirmed`` of a paragraph's notices."""
    runs = model.notices([w for line in lines for w in line.words], confirm)
    ends = [0]
    for line in lines:
        ends.append(ends[-1] + len(line.words))
    placed = [(bisect_right(ends, r[0]) - 1, bisect_left(ends, r[1]) - 1, r) for r in runs]
    wrapped = {k for first, last, _ in placed if first < last for k in range(first, last + 1)}
    spots: dict[int, list[tuple[int, int]]] = {}

    def spot(k: int, word: int) -> tuple[int, int]:
        if k not in spots:
            spots[k] = word_spots(lines[k].text)
        a, b = spots[k][word - ends[k]]
        return lines[k].start + a, lines[k].start + b

    named = {}
    for k, line in enumerate(lines):
        family, sure = model.predict(line.words) if k not in wrapped else (UNKNOWN, 1.0)
        if family != UNKNOWN and sure >= SURE:
            named[k] = family
            like = model.likeness(family, line.words)
            yield line.number, line.start, line.start + line.size, family, round(sure, 6), round(like, 6), like >= confirm
    for first, last, (a, b, family, sure, like) in placed:
        if first == last and (named.get(first) == family or first in named and 2 * (b - a) > len(lines[first].words)):
            continue
        yield lines[first].number, spot(first, a)[0], spot(last, b - 1)[1], family, round(sure, 6), round(like, 6), like >= confirm


def corpus_paragraphs(docs: DataFrame, text: str, sample: int, work: Work) -> list[list[bytes]]:
    """One paragraph each of at most ``sample`` documents, the first by a hash of the text."""
    docs, text = docs.select(F.col(text).alias("text")), "text"
    print_of = F.xxhash64(text)
    first = work.stage(docs.where(F.length(text) > 0).select(print_of.alias("_print")).distinct().orderBy("_print").limit(sample), "sample")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x)) > 0)
    chosen = F.element_at(lines, (F.pmod(print_of, F.greatest(F.size(lines), F.lit(1))) + 1).cast("int"))
    rows = docs.join(F.broadcast(first), print_of == F.col("_print"), "left_semi").where(F.size(lines) > 0)
    rows = rows.groupBy(print_of.alias("_print")).agg(F.first(chosen.cast("binary")).alias("line")).orderBy("_print")
    return [plain_words(bytes(r["line"])) for r in rows.collect()]


def find_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    confirm: float = CONFIRM,
    work: Work | None = None,
) -> DataFrame:
    """One row per line named a licence notice, and per notice that is wrapped over lines or
    stands inside a longer line: ``id, paragraph, start, end, family, probability, likeness,
    confirmed``; fits first, on at most ``sample`` paragraphs of the corpus and the templates.

    A paragraph is a run of lines with words; marks of comments are no words. Its runs of words
    that hold a template's share ``confirm`` of n-grams are looked at by themselves, so that
    neither prose around a notice nor line breaks hide it. A family is named from a
    probability of ``SURE``; families without templates are ``unknown`` and give no row.
    ``paragraph`` is the number of the (first) line, ``start`` and ``end`` (of the line, or the run)
    are code points of the text. ``confirmed``: ``likeness`` of ``confirm`` or more. Null and
    empty texts have no paragraphs, texts of any length are read whole, an empty table gives no
    rows. Rows are judged by themselves: repeated rows and rows without id give their own
    rows; other columns are not read. Among runs of one likeness the longest stays, then the surest, then the first."""
    work = work or session_work(docs.sparkSession)
    model = fit(corpus_paragraphs(docs, text, sample, work))

    def start():
        single = {g[0] for g in model.places if len(g) == 1}

        def run(columns):
            out: tuple[list, ...] = tuple([] for _ in range(8))
            for doc, raw in zip(*columns, strict=True):
                for paragraph in paragraphs(raw or b""):
                    if not any(not single.isdisjoint(line.words) for line in paragraph):
                        continue
                    for row in _named(model, paragraph, confirm):
                        for column, value in zip(out, (doc, *row), strict=True):
                            column.append(value)
            return list(out)

        return run

    schema = "id long, paragraph int, start long, end long, family string, probability double, likeness double, confirmed boolean"
    return map_batches(docs.select(F.col(id_column).alias("id"), as_bytes(text)), start, schema)
