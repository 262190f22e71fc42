"""Quality rules where a language has too few documents for a reference."""

import random
import re
from collections import Counter
from math import log2

import pytest
from pyspark.sql import functions as F

from airway.llm import quality_rules


KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:!?", "\"'()[]{}-", "#*$%&|<>")


def classes(text):
    return Counter("beyond" if c > "\x7f" else next((k for k in KINDS if c in k), "other") for c in text)


def distance(p, q):
    total = 0.0
    for key in {*p, *q}:
        a, b = p.get(key, 0.0), q.get(key, 0.0)
        total += sum(x * log2(2 * x / (a + b)) for x in (a, b) if x) / 2
    return max(0.0, total) ** 0.5


def test_texts_of_rare_and_null_languages_are_not_held_against_others(docs_of):
    rng = random.Random(8)

    def text(words):
        return " ".join(rng.choice(words) + rng.choice("abcdefgh") for _ in range(150))

    rows = [(i, text(["the", "of", "river", "stone"])) for i in range(80)]
    rows += [(100 + i, text(["река", "и", "камень", "на"])) for i in range(10)]
    rows += [(200 + i, text(["fluss", "und", "der", "stein"])) for i in range(10)]
    rows += [(300, "same words again " * 60), (301, "$$$ ### " * 10 + " ".join(f"%{i}%" for i in range(150)))]
    lang = F.when(F.col("doc_id").between(100, 199), "ru").when(F.col("doc_id").between(200, 300), F.lit(None)).otherwise("en")
    found = {r["id"]: r for r in quality_rules.judge_quality(docs_of(rows).withColumn("lang", lang)).collect()}
    assert all(found[i]["kept"] for i, _ in rows if i < 300)
    assert all(found[i]["char_distance"] is None for i, _ in rows if 200 <= i < 300)
    assert found[300]["base_failed"] and not found[300]["kept"]
    assert found[301]["char_distance"] > quality_rules.MAX_CHAR_DISTANCE and not found[301]["kept"]


def test_distances_and_verdicts_equal_the_definition(spark, table):
    docs = table("documents").select("doc_id", "text", F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"))
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in docs.collect()]
    held = {}
    for i, text, lang in rows:
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        held[i] = (words, classes(text), lang)
    made = {}
    for words, chars, lang in held.values():
        if lang is not None and len(words) >= 50:
            one = made.setdefault(lang, [0, Counter(), Counter()])
            one[0] += 1
            one[1].update({c: n / sum(chars.values()) for c, n in chars.items()})
            one[2].update({w: n / len(words) for w, n in Counter(words).items()})
    top = {lang: sorted(words, key=lambda w: (-words[w], w.encode()))[:64] for lang, (_, _, words) in made.items()}
    judged = 0
    for r in quality_rules.judge_quality(docs).collect():
        words, chars, lang = held[r["id"]]
        slack = spread = 0.0
        if lang in made and r["n_words"] >= 50:
            n_docs, char_sums, word_sums = made[lang]
            total, whole = sum(chars.values()), sum(char_sums.values())
            by_char = distance({c: n / total for c, n in chars.items()}, {c: n / whole for c, n in char_sums.items()})
            assert r["char_distance"] == pytest.approx(by_char, abs=2e-4)
            if len(words) >= 100:
                mine = Counter(w if w in set(top[lang]) else None for w in words)
                theirs = {w: word_sums[w] / n_docs for w in top[lang]}
                theirs[None] = max(0.0, 1 - sum(theirs.values()))
                assert r["word_distance"] == pytest.approx(distance({w: n / len(words) for w, n in mine.items()}, theirs), abs=0.01)
                judged += 1
            slack, spread = n_docs**-0.5, 2 / r["n_words"] ** 0.5
        else:
            assert r["char_distance"] is None and r["word_distance"] is None
        near = (r["char_distance"] or 0) <= 0.30 + slack and (r["word_distance"] or 0) <= 0.28 + slack + spread
        assert r["kept"] == (near and not r["base_failed"])
    assert judged > 50


def test_one_document_more_changes_bounds_a_little(docs_of):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["the", "of", "river", "stone"]) + rng.choice("abcdefgh") for _ in range(150))) for i in range(60)]
    odd = (900, " ".join(f"%{i}%$" for i in range(150)))
    kept = [{r["id"]: r["kept"] for r in quality_rules.judge_quality(docs_of([*good[:n], odd])).collect()} for n in (40, 48, 49, 50, 60)]
    assert all(k[i] for k in kept for i in k if i != 900)
    assert [k[900] for k in kept] == [kept[0][900]] * 5
