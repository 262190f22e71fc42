"""Near-duplicates and repeated paragraphs against plain Python."""

import itertools
import random

import pytest

from airway.llm import near_dedup, paragraph_dedup
from airway.llm.linking import components
from airway.sources.staging import session_work


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def roots(keys, sets, percent):
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {k: find(k) for k in keys}


def copies(seed, groups, size, words=120):
    """Texts of ``groups`` families, members edited at rates of their own."""
    rng, texts = random.Random(seed), []
    for g in range(groups):
        base = [f"w{g}x{rng.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            rate = rng.choice([0, 0.005, 0.01, 0.02, 0.05, 0.1])
            texts.append(" ".join(f"e{rng.randrange(30)}" if rng.random() < rate else w for w in base))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("groups", "size"), [(1, 120), (15, 8)])
def test_near_duplicates_equal_all_pairs(docs_of, groups, size):
    rows = list(enumerate(copies(groups, groups, size)))
    want = roots([i for i, _ in rows], {i: shingles(t) for i, t in rows}, 85)
    got = {r["id"]: r["root"] for r in near_dedup.near_duplicates(docs_of(rows)).collect()}
    assert got == want


def test_near_duplicates_edge_cases(docs_of):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(9, "One two THREE"), (3, "one  two\nthree"), (4, "one two"), (5, None), (6, ""), (7, " \t\n"), (None, "one two three")]
    rows += [(8, long), (2, long + " end"), (2, long + " end"), (2, "other text altogether here now")]
    found = near_dedup.near_duplicates(docs_of(rows)).collect()
    assert len(found) == len(rows)
    got = sorted((r["id"] if r["id"] is not None else -1, r["size"], r["root"]) for r in found)
    assert got[0] == (-1, 1, None)
    assert got[1:] == [(2, 1, 2), (2, 59_997, 2), (2, 59_997, 2), (3, 1, 3), (4, 1, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 59_996, 2), (9, 1, 3)]
    kept = near_dedup.without_near_duplicates(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 2, 2, 3, 4, 5, 6, 7]


def test_pair_operators_on_empty_tables(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).collect() == []
    assert paragraph_dedup.repeated_paragraphs(docs_of([])).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (7, 6)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, session_work(spark)).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1300)}


def test_repeated_paragraphs_equal_all_pairs(docs_of):
    texts = copies(3, 12, 7, words=40)
    rng = random.Random(1)
    rows, places = [], {}
    for doc in range(30):
        lines = [texts[rng.randrange(len(texts))] if rng.random() < 0.7 else f"short line {doc}" for _ in range(5)]
        rows.append((doc, "\n".join(lines)))
        places |= {(doc, k): line for k, line in enumerate(lines) if len(line.split()) >= 25}
    want = roots(sorted(places), {p: shingles(t) for p, t in places.items()}, 80)
    sizes = {}
    for root in want.values():
        sizes[root] = sizes.get(root, 0) + 1
    found = paragraph_dedup.repeated_paragraphs(docs_of([*rows, rows[0], (None, rows[0][1]), (99, None), (98, "")])).collect()
    got = {(r["id"], r["paragraph"]): (r["first_id"], r["first_paragraph"]) for r in found}
    assert got == {p: root for p, root in want.items() if sizes[root] > 1}
    assert len(found) == len(got)
    for r in found:
        assert dict(rows)[r["id"]][r["start"] : r["end"]] == places[r["id"], r["paragraph"]]
        assert r["removed"] == ((r["id"], r["paragraph"]) != (r["first_id"], r["first_paragraph"]))
