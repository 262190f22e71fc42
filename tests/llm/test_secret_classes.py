"""Random strings of every usual alphabet, and whole texts against the definition."""

import math
import random
import string
from collections import Counter

import pytest

from airway.llm import secret_scan

LETTERS, DIGITS = string.ascii_letters, string.digits
CASES = [
    (LETTERS + DIGITS, 20, 0.99),
    (LETTERS + DIGITS, 32, 0.99),
    (DIGITS + "ABCDEF", 20, 0.98),
    (DIGITS + "ABCDEF", 24, 0.99),
    (string.ascii_lowercase + DIGITS, 20, 0.98),
    (string.ascii_uppercase + "234567", 24, 0.98),
    (LETTERS, 20, 0.93),
    (LETTERS, 32, 0.99),
    (LETTERS + DIGITS + ".", 32, 0.98),
    (LETTERS + DIGITS + "!@#$%^&*", 20, 0.93),
    (LETTERS + DIGITS + "!@#$%^&*", 32, 0.98),
]


@pytest.mark.parametrize(("alphabet", "size", "share"), CASES)
def test_random_strings_are_found(alphabet, size, share):
    rng = random.Random(size)
    found = 0
    for _ in range(2000):
        text = f"see {''.join(rng.choice(alphabet) for _ in range(size))} there"
        hits = {x for a, _, b in secret_scan.scan(text.encode()) for x in range(a, b)}
        found += 2 * len(hits & set(range(4, 4 + size))) >= size
    assert found >= share * 2000


def test_words_numbers_and_addresses_are_not():
    for text in (
        "getElementsByClassNameFromDocument",
        "InternationalizationConfigurationManager",
        "www.example.org/Library/Reference.html",
        "John.Smith1985@Mail2.Example.com",
        "the.quick.brown.fox.jumps.over.the.lazy.dog",
        "Well...Yes!!!...Perhaps...And...Then...No",
        "1.234.567.890.123.456.789,00",
        "20240101T000000.20240131T235959",
    ):
        assert not secret_scan.scan(f"x {text} y".encode()), text


def bits(part):
    return -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())


def by_definition(text):
    """Bytes inside any window of high entropy that the allow-list does not explain."""
    inside = set()
    for pattern, classes in ((secret_scan.CANDIDATE, (*secret_scan.CLASSES, secret_scan.LETTERS)), (secret_scan.JOINED, (secret_scan.SIGNS,))):
        for m in pattern.finditer(text):
            if pattern is secret_scan.JOINED:
                whole = m[0].strip(b".!*")
                if not secret_scan.SIGN.search(whole) or secret_scan.ADDRESS.fullmatch(whole):
                    continue
            for kind in classes:
                for first, end in secret_scan.unexplained(m[0], names=kind is not secret_scan.LETTERS):
                    for run in kind.run.finditer(text, m.start() + first, m.start() + end):
                        for i in range(run.start(), run.end() - kind.window + 1):
                            part = text[i : i + kind.window]
                            if bits(part) >= kind.bits - 1e-9 and all(sum(c in s for c in part) >= kind.least for s in kind.needs):
                                inside |= set(range(i, i + kind.window))
    return inside


def test_scan_of_whole_texts_equals_the_definition(table):
    rng = random.Random(9)
    texts = [(r["text"] or "").encode() for r in table("documents").collect()]
    for _ in range(300):
        alphabet, size, _ = rng.choice(CASES)
        token = "".join(rng.choice(alphabet) for _ in range(size + rng.randrange(40)))
        texts.append(f"è {rng.choice(['', 'Example/', 'a.', '(', '=====', 'id-'])}{token}{rng.choice(['', '.', '!', '/x', '-dummy'])} ü".encode())
    some = 0
    for text in texts:
        spans = secret_scan.scan(text)
        base = {x for a, k, b in spans if k != 3 for x in range(a, b)}
        got = {x for a, k, b in spans if k == 3 for x in range(a, b)}
        want = by_definition(text)
        assert got <= want - base
        # What is left beside: separators and words alone at a pattern, and dots and signs at the ends.
        lost = want - base - got
        around = {x + d for x in base for d in range(-40, 41)}
        assert all(x in around or text[x] in b".!*+/_=-" for x in lost)
        some += bool(got)
    assert some >= 240
