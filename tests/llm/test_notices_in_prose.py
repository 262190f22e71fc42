"""Licence notices inside long lines."""

import pytest

from airway.llm import license_scan

NOTICES = {
    "mit": "Released under the MIT License.",
    "apache": "Licensed under the Apache License, Version 2.0.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
}


@pytest.mark.parametrize("around", [20, 320, 1000])
def test_notices_in_long_lines_are_named(docs_of, table, around):
    words = " ".join(r["text"] or "" for r in table("documents").where("lang = 'en'").orderBy("doc_id").limit(60).collect() if "icense" not in (r["text"] or "")).split()
    rows = []
    for i, notice in enumerate(NOTICES.values()):
        filler = words[i * around : (i + 1) * around]
        rows.append((i, "é\n" + " ".join([*filler[: around // 2], notice, *filler[around // 2 :]])))
    both = " ".join([*words[:around], NOTICES["mit"], *words[around : 2 * around], NOTICES["apache"], *words[:around]])
    rows += [(50, both), (51, " ".join(words[: 3 * around]))]
    found = license_scan.find_licenses(docs_of(rows)).collect()
    named = {(r["id"], r["family"]) for r in found if r["confirmed"]}
    assert named == {*enumerate(NOTICES), (50, "mit"), (50, "apache")}
    for r in found:
        assert NOTICES[r["family"]].rstrip(".") in dict(rows)[r["id"]][r["start"] : r["end"]]
