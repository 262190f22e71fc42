"""Operators on single texts against plain Python, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from airway.llm import license_scan, quality_model, quality_rules, secret_scan, token_counts
from airway.llm import queries as registered

EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (4, "x" * 300_000), (5, "a\n" * 50_000), (6, "tie"), (6, "tie")]
SF = "/root/testdata/sf0.001"


# secrets


def base_spans(text):
    spans = []
    rx = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    spans += [(m.start(), 0, m.end()) for m in rx.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def windows_of_entropy(run, kind):
    hits = set()
    for i in range(len(run) - kind.window + 1):
        part = run[i : i + kind.window]
        bits = -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())
        if bits >= kind.bits - 1e-9 and all(set(part) & set(s) for s in kind.needs):
            hits |= set(range(i, i + kind.window))
    return hits


def test_entropy_by_counts_equals_entropy_by_definition():
    rng = random.Random(2)
    for kind in secret_scan.CLASSES:
        for alphabet in (b"ab1", b"0123456789abcdef", b"ABCDEFGH234567", bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))):
            run = bytes(rng.choice(alphabet) for _ in range(90))
            got = {x for a, b in secret_scan.random_ranges(run, kind) for x in range(a, b)}
            assert got == windows_of_entropy(run, kind)


def test_secret_query_equals_plain_patterns(spark, table):
    texts = {r["doc_id"]: r["text"] or "" for r in table("documents").collect()}
    for r in registered.op5_secrets(spark, SF).collect():
        want = base_spans(texts[r["doc_id"]])
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_secret_kinds_positions_and_allow_list(docs_of):
    key = "q7Zr9TfK2mXv4LpW8sNd"
    rows = [
        (1, f"é é Passwd = 'hunter22' then {key} end"),
        (2, "id 123e4567-e89b-12d3-a456-426614174000 and AKIAEXAMPLE and token: abc"),
        (3, "AKIA" + "Z" * 16 + " " + "0a" * 12),
        (4, "ſecret=abcdef1234"),
    ]
    found = {r["id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secret_scan.find_secrets(docs_of(rows)).collect()}
    assert found[1] == [("assign", 4, 22), ("entropy", 29, 49)]
    assert found[2] == []
    assert found[3] == [("access", 0, 20), ("hex", 21, 45)]
    assert found[4] == []
    clean = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secret_scan.redact(docs_of([*rows, (9, None)])).collect()}
    assert clean[1] == ("é é [SECRET]' then [SECRET] end", 31)
    assert clean[2] == (rows[1][1], len(rows[1][1])) and clean[9] == (None, None)


# quality rules


def plain_base(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    counts = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    inside = {k for i in range(len(ws) - 2) if counts[tuple(ws[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_rules_equal_plain_counts(spark, table):
    texts = {r["doc_id"]: r["text"] or "" for r in table("documents").collect()}
    for r in registered.op10_quality_rules(spark, SF).collect():
        want = plain_base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_distances_follow_their_definition(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "river", "stone"]) + rng.choice(["", ".", "s"]) for _ in range(120))) for i in range(60)]
    rows.append((99, "$$$ ### " * 20 + " ".join(f"%{i}%" for i in range(100))))
    found = {r["id"]: r for r in quality_rules.judge_quality(docs_of(rows)).collect()}
    shares = np.zeros(len(quality_rules.CLASSES))
    for _, t in rows:
        counts = quality_rules.class_counts(t.encode())
        shares += counts * 1_000_000 // counts.sum()
    p, q = quality_rules.class_counts(rows[3][1].encode()).astype(float), shares / shares.sum()
    p /= p.sum()
    m = (p + q) / 2
    bits = sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)) / 2
    assert found[3]["char_distance"] == pytest.approx(bits**0.5, abs=1e-9)
    assert all(found[i]["kept"] or found[i]["base_failed"] for i in range(60))
    assert not found[99]["kept"]


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [r for r in registered.op10_quality_rules(spark, sf).collect() if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in judged) >= 0.99 * len(judged)


# quality model


def test_machine_scores_all_pairs():
    rng = np.random.default_rng(1)
    rows = [quality_model.features(t.encode()) for t in ("a b c d a.", "B!! B!!\nC", "")]
    model = quality_model.fit(rows, np.array([1.0, 0.0, 1.0]))
    model.vectors = rng.normal(size=model.vectors.shape)
    for row in rows:
        places, values = model.row(*row)
        pairs = sum(
            values[i] * values[j] * model.vectors[places[i]] @ model.vectors[places[j]] for i in range(len(places)) for j in range(i)
        )
        want = model.bias + (model.weights[places] * values).sum() + pairs
        assert model.margins(places, values, np.zeros(1, int))[0][0] == pytest.approx(want)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = registered.op4_quality_scores(spark, sf).collect()
    assert len(found) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)


def test_quality_without_labels_or_with_one_class(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_model.score_quality(docs_of(EDGES), none).collect()} == {0.5}
    one = spark.createDataFrame([(2, 1, 0), (3, 1, 0), (None, 0, 0), (6, 1, None), (6, 0, None)], "doc_id long, quality int, toxic int")
    assert len({r["score"] for r in quality_model.score_quality(docs_of(EDGES), one).collect()}) == 1
    assert quality_model.good_documents(docs_of(EDGES), one).count() == len(EDGES)
    assert quality_model.good_documents(docs_of(EDGES), none).count() == len(EDGES)
    bad = spark.createDataFrame([(i, 0, 0) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError, match="all 0"):
        quality_model.good_documents(docs_of(EDGES), bad)


# token counts


def best_count(word, pieces):
    trie = token_counts.PrefixTrie(pieces)
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        tries = [(best[end - 1][0] + trie.unknown * size, -(best[end - 1][1] + size))]
        tries += [(best[s][0] + pieces[word[s:end]], -(best[s][1] + 1)) for s in range(end) if word[s:end] in pieces]
        score, count = max(tries)
        best.append((score, -count))
    return best[-1][1]


def test_token_counts_equal_one_word_at_a_time(docs_of):
    rng = random.Random(6)
    pieces = token_counts.zipf_scores(["▁", "a", "b", "ab", "▁a", "ba", "aba", "bab", "▁ab", "abba"])
    rows = [(i, " ".join("".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(40))) for i in range(20, 25)]
    for limit in (10, 300_000):
        for r in token_counts.count_tokens(docs_of(rows + EDGES[:3]), pieces=pieces, trie_nodes=limit, counted_words=limit, text_bytes=limit).collect():
            words = (dict(rows + EDGES[:3])[r["id"]] or "").split()
            assert r["n_pretokens"] == len(words)
            assert r["n_tokens"] == sum(best_count("▁" + w, pieces) for w in words)


# licences


def test_licence_notices_are_found_and_prose_is_not(spark, docs_of, table):
    notices = [
        ("apache", "Licensed under the Apache License, Version 2.0."),
        ("gpl", "This work is licensed under the GNU General Public License, version 3."),
        ("mit", "Released under the MIT License."),
        ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ]
    prose = [r["text"].split("\n")[0] for r in table("documents").limit(150).collect()]
    rows = [(i, f"é\n{prose[i]}\n{t}") for i, (_, t) in enumerate(notices)] + [(100 + i, p) for i, p in enumerate(prose)]
    rows.append((50, "A driving license is required for this job."))
    found = license_scan.find_licenses(docs_of(rows + EDGES)).collect()
    named = [(r["id"], r["paragraph"], r["family"], r["confirmed"]) for r in found if "icense" in dict(rows)[r["id"]]]
    assert sorted(named) == [(i, 2, f, True) for i, (f, _) in enumerate(notices)]
    assert not [r for r in found if r["confirmed"] and "icense" not in dict(rows)[r["id"]]]
    for r in found[:4]:
        assert dict(rows)[r["id"]][r["start"] : r["end"]] == dict(enumerate(t for _, t in notices))[r["id"]]


# edge cases of all


@pytest.mark.parametrize("rows", [EDGES, []])
def test_edges_give_a_row_each(docs_of, rows):
    docs = docs_of(rows)
    assert secret_scan.find_secrets(docs).count() == len(rows)
    assert token_counts.count_tokens(docs, pieces={"a": -1.0}).count() == len(rows)
    judged = quality_rules.judge_quality(docs).collect()
    assert len(judged) == len(rows)
    assert all(r["base_failed"] for r in judged)
    assert secret_scan.redact(docs).count() == len(rows)
    assert license_scan.find_licenses(docs).count() == 0
