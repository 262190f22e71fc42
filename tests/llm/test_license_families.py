"""Licence families that are told apart, those that are not, and notices over several lines."""

import textwrap

import pytest

from airway.llm import license_scan
from airway.llm.batches import plain_words

HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
)
NAMED = {
    "SPDX-License-Identifier: GPL-2.0-only": "gpl",
    "SPDX-License-Identifier: Apache-2.0": "apache",
    "SPDX-License-Identifier: MIT": "mit",
    HEADER.format("General Public License"): "gpl",
    HEADER.format("Affero General Public License"): "agpl",
    HEADER.format("Lesser General Public License"): "lgpl",
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0": "cc-by-sa",
}
# None of these families has a template; the model was not fitted on the last ones.
UNNAMED = [
    "Eclipse Public License 2.0",
    "Licensed under the Eclipse Public License 2.0",
    "CC BY-ND 4.0",
    "Licensed under CC BY-ND 4.0",
    "Permission is hereby granted to enter the building between nine and five.",
    "SPDX-License-Identifier: BSL-1.0",
    "SPDX-License-Identifier: Zlib",
    "Distributed under the Boost Software License, Version 1.0.",
    "This is released under the Artistic License 2.0.",
    "Licensed under the Academic Free License version 3.0",
    "Released under the PostgreSQL License.",
]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from airway.sources.staging import Work

    with Work(spark) as work:
        return license_scan.fit(license_scan.corpus_paragraphs(docs, "text", license_scan.SAMPLE, work))


def named(model, text):
    rows = [r for p in license_scan.paragraphs(text.encode()) for r in license_scan._named(model, p, license_scan.CONFIRM)]
    return [(r[3], text[r[1] : r[2]]) for r in rows if r[-1]]


@pytest.mark.parametrize("text", NAMED)
def test_families_with_templates(model, text):
    assert [f for f, _ in named(model, text)] == [NAMED[text]]


@pytest.mark.parametrize("text", UNNAMED)
def test_other_families_are_not_confirmed(model, text):
    assert named(model, text) == []


@pytest.mark.parametrize("mark", ["# ", "// ", " * ", ""])
@pytest.mark.parametrize("family", ["General", "Affero General", "Lesser General"])
def test_wrapped_notices_are_one(model, mark, family):
    notice = HEADER.format(f"{family} Public License")
    lines = textwrap.wrap(notice, 72)
    text = f"{mark}Tool for é maps\n{mark.rstrip()}\n" + "\n".join(mark + x for x in lines) + f"\n{mark.rstrip()}\nimport os\n"
    found = named(model, text)
    assert [f for f, _ in found] == [{"General": "gpl", "Affero General": "agpl", "Lesser General": "lgpl"}[family]]
    words = plain_words(found[0][1].encode())
    assert len(words) >= 0.8 * len(plain_words(notice.encode())) and set(words) <= set(plain_words(notice.encode()))


def test_likeness_by_its_definition(model):
    def grams(text):
        words = plain_words(text.encode())
        return {tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}

    families = {f: [grams(t) for t in ts] for f, ts in license_scan.TEMPLATES.items()}
    for text in [*NAMED, *UNNAMED, *license_scan.OTHER]:
        held = grams(text)
        for family, templates in families.items():
            elsewhere = set().union(*(t for f, ts in families.items() if f != family for t in ts))
            shares = [min(len(held & t) / len(t), len(held & (t - elsewhere)) / len(t - elsewhere) if t - elsewhere else 1) for t in templates]
            assert model.likeness(family, plain_words(text.encode())) == pytest.approx(max(shares))
