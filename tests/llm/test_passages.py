"""Repeated passages wherever lines begin and end."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airway.llm import passage_dedup
from airway.sources import staging


def prose(rng, n):
    return [f"w{rng.randrange(5000)}é" for _ in range(n)]


def test_passages_of_fifty_words_are_found_in_any_lines(docs_of):
    rng = random.Random(12)
    rows, places = [], {}
    for case in range(40):
        shared = prose(rng, 50)
        inside = [*prose(rng, 45), *shared, *prose(rng, 45)]
        wrapped = [*prose(rng, 10), *shared, *prose(rng, 7)]
        rows.append((case, " ".join(inside)))
        rows.append((1000 + case, "\n".join(" ".join(wrapped[i : i + 12]) for i in range(0, len(wrapped), 12)).upper().replace("É", "é")))
        places[case] = shared
    rows += [(5000, None), (5001, ""), (5002, "one two"), (None, rows[0][1]), rows[3]]
    rows += [(6000, " ".join(prose(rng, 300)))]
    twice = prose(rng, 60)
    rows += [(7000, " ".join([*twice, *prose(rng, 30), *twice]))]
    # Alike means equal here; units that reach a word beyond the passage would be nearly so.
    found = passage_dedup.repeated_passages(docs_of(rows), percent=100).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["id"], []).append(r)
        words = dict(rows)[r["id"]][r["start"] : r["end"]].lower().split()
        assert len(words) == r["n_words"] >= passage_dedup.LEAST
        shared = twice if r["id"] == 7000 else places[r["id"] % 1000]
        assert " ".join(words) in " ".join(shared)
        assert r["first_id"] == (7000 if r["id"] == 7000 else r["id"] % 1000)
    assert sorted(by_id) == sorted([*range(40), *range(1000, 1040), 7000])
    assert all(not r["removed"] for i in range(40) for r in by_id[i]) and all(r["removed"] for i in range(1000, 1040) for r in by_id[i])
    assert sorted(r["removed"] for r in by_id[7000]) == [False, True]
    assert passage_dedup.repeated_passages(docs_of([])).collect() == []


def test_passages_with_some_words_changed_are_found(docs_of):
    rng = random.Random(21)
    rows = []
    for case in range(150):
        shared = prose(rng, 60)
        other = [w if rng.random() >= 0.04 else f"x{rng.randrange(9999)}" for w in shared]
        for i, part in ((case, shared), (1000 + case, other)):
            rows.append((i, " ".join([*prose(rng, 40), *part, *prose(rng, 40)])))
    rows += [(5000 + i, " ".join(prose(rng, 150))) for i in range(50)]
    found = passage_dedup.repeated_passages(docs_of(rows)).collect()
    ids = {r["id"] for r in found}
    assert not [i for i in ids if i >= 5000]
    assert sum(i in ids and 1000 + i in ids for i in range(150)) >= 0.9 * 150
    assert all(r["first_id"] == r["id"] % 1000 for r in found)


def plain_distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def test_links_equal_all_pairs_of_a_list(spark, docs_of):
    """A family of variants of one unit: components equal those of all pairs that share a band."""
    rng = random.Random(3)
    base = prose(rng, 150)
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(150)] = f"y{rng.randrange(9999)}"
        rows.append((i, " ".join(words)))
    nodes = {}
    for i, text in rows:
        made = passage_dedup.units(text.encode())
        hashed = passage_dedup.word_hashes(text.encode())
        for first, last, _, _, a, _, *bands in zip(*made, strict=True):
            nodes.setdefault(int(a), (tuple(hashed[first:last].tolist()), {int(b) for b in bands}, i, int(first)))
    keys = sorted(nodes)
    root = {a: a for a in keys}

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(keys):
        for b in keys[:i]:
            (x, of_x, i_x, first_x), (y, of_y, i_y, first_y) = nodes[a], nodes[b]
            size = max(len(x), len(y))
            if i_x == i_y and abs(first_x - first_y) < 24:
                continue
            if of_x & of_y and 100 * (size - plain_distance(x, y)) >= 80 * size:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    want = {a: top(a) for a in keys}
    docs = docs_of(rows)
    banded = spark.createDataFrame([(b, a, (i, f)) for i, t in rows for f, _, _, _, a, _, *bs in zip(*[c.tolist() for c in passage_dedup.units(t.encode())], strict=True) for b in bs],
                                   "band long, a long, place struct<id: long, first: int>")
    lists = staging.staged(banded.groupBy("band", "a").agg(F.min("place").alias("low")), "lists")
    found = passage_dedup._near_roots(docs, "doc_id", "text", lists, 80, staging.session_work(spark))
    got = {a: a for a in keys} | {r["node"]: r["root"] for r in found.collect()}
    assert got == want and len(set(want.values())) < len(keys)


def test_edit_distance_of_word_arrays(spark):
    rng = random.Random(5)
    pairs = [([rng.randrange(6) for _ in range(rng.randrange(24))], [rng.randrange(6) for _ in range(rng.randrange(24))]) for _ in range(60)]
    df = spark.createDataFrame(pairs, "x array<long>, y array<long>")
    found = df.select("x", "y", passage_dedup.edit_distance(F.col("x"), F.col("y")).alias("d")).collect()
    assert [r["d"] for r in found] == [plain_distance(r["x"], r["y"]) for r in found]


def test_words_and_lists_do_not_outlive_their_step(spark, docs_of):
    """What only the comparison of units reads is gone from disk before passages are made."""
    rng = random.Random(8)
    shared = prose(rng, 80)
    rows = [(i, " ".join([*prose(rng, 40), *shared[: 40 + i], f"z{i}", *shared[41 + i :], *prose(rng, 40)])) for i in range(12)]
    with staging.Work(spark) as work:
        found = passage_dedup.repeated_passages(docs_of(rows), work=work)
        kept = {path.rsplit("/", 1)[1].split("-")[0] for path in work.paths}
        assert not kept & {"mixed", "words", "links", "rooted", "open"}
        # Texts of a repeated row are compared once.
        twice = passage_dedup.repeated_passages(docs_of([*rows, *rows]), work=work)
        assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, found.collect())) != []


def staged_rows(monkeypatch):
    """Rows of every table staged from now on, by name."""
    counts, stage = {}, staging.Work.stage

    def counting(self, df, name):
        made = stage(self, df, name)
        counts.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(staging.Work, "stage", counting)
    return counts


def test_units_of_many_texts_are_those_of_each():
    rng = random.Random(2)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 7)):
            words = [f"É{rng.randrange(rng.choice([1, 2, 4, 900]))}" for _ in range(rng.choice([0, 1, 24, 25, 26, 27, 40, 200]))]
            texts.append((rng.choice(["", " \n"]) + rng.choice([" ", "\t ", "\n"]).join(words) + rng.choice(["", "\x0b"])).encode())
        of, *found = passage_dedup.units_of(texts)
        for i, text in enumerate(texts):
            hashed, own = passage_dedup.word_hashes(text), passage_dedup.units(text)
            assert all(np.array_equal(x, y[of == i]) for x, y in zip(own, found, strict=True))
            if len(hashed) < passage_dedup.SPARSE + passage_dedup.GRAM - 1:
                assert not len(own[0])
                continue
            mixed = passage_dedup._grams(hashed, passage_dedup.GRAM)
            starts, stops = [sorted({w + int(np.argmin(mixed[w : w + n])) for w in range(len(mixed) - n + 1)}) for n in (passage_dedup.SPARSE, passage_dedup.DENSE)]
            want = [(s, min(e for e in stops if e >= s + passage_dedup.LEAST)) for s in starts if stops[-1] >= s + passage_dedup.LEAST]
            assert list(zip(own[0].tolist(), own[1].tolist(), strict=True)) == want


def test_overlapping_units_are_not_compared(docs_of, monkeypatch):
    """Units of one place share bands and words; none is read or tried, and the shuffles of a step go with it."""
    rng = random.Random(31)
    counts = staged_rows(monkeypatch)
    docs = docs_of([(i, " ".join(prose(rng, 600))) for i in range(20)])
    before = docs.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    assert passage_dedup.repeated_passages(docs).collect() == []
    assert counts["lists"][0] > 100 and counts["mixed"] == counts["tries"] == counts["words"] == [0]
    assert docs.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == before


@pytest.mark.parametrize("percent", [80, 60])
def test_marks_and_rare_words_rule_out_no_pair_that_is_alike(spark, percent):
    rng = random.Random(17)
    rows = []
    for a in range(120):
        shift = rng.randrange(8)
        words = [j % rng.choice([5, 64, 99]) + 3 if rng.random() < 0.15 else j for j in range(shift, shift + rng.randrange(18, 24))]
        rows.append((1, a, words))
    units = spark.createDataFrame(rows, "band long, a long, words array<long>")
    kept = passage_dedup._keyed(units.select("band", "a").join(passage_dedup._marked(units, percent), "a"), percent).collect()
    assert len(kept) == len(rows) and all(1 < len(r["keys"]) for r in kept)
    made = spark.createDataFrame(kept).join(units.select("a", "words"), "a")
    x, y = [made.select(*[F.col(c).alias(f"{c}_{side}") for c in ("a", "words", "mark", "keys")]) for side in "xy"]
    near = passage_dedup._may_be_near("mark_x", "mark_y") & F.arrays_overlap("keys_x", "keys_y")
    pairs = x.crossJoin(y).where("a_x < a_y").select("words_x", "words_y", near.alias("near")).collect()
    alike = 0
    for r in pairs:
        size = max(len(r["words_x"]), len(r["words_y"]))
        if 100 * (size - plain_distance(r["words_x"], r["words_y"])) >= percent * size:
            alike += 1
            assert r["near"]
    assert alike > 100 and sum(not r["near"] for r in pairs) > 100


def test_units_that_share_a_phrase_only_do_not_all_meet(spark, docs_of, monkeypatch):
    """A list of many units that are unlike but for a phrase makes no pair for each two of them."""
    rng = random.Random(41)
    counts, verified = staged_rows(monkeypatch), passage_dedup._verified
    tried = []

    def counting(pairs, words, percent):
        tried.append(pairs.count())
        return verified(pairs, words, percent)

    monkeypatch.setattr(passage_dedup, "_verified", counting)
    phrase = prose(rng, 14)
    rows = [(i, " ".join([*(f"u{i}x{j}" for j in range(40)), *phrase, *(f"v{i}x{j}" for j in range(40))])) for i in range(150)]
    lists = []
    for i, text in rows:
        made = passage_dedup.units(text.encode())
        lists += [(1, int(a), (i, int(first))) for first, a in zip(made[0], made[4], strict=True)]
    lists = staging.staged(spark.createDataFrame(lists, "band long, a long, low struct<id: long, first: int>"), "lists")
    n = lists.count()
    passage_dedup._near_roots(docs_of(rows), "doc_id", "text", lists, 80, staging.session_work(spark))
    assert n > 600 and counts["open"][0] > 500 and sum(tried) < 20 * n < n * n / 20
