"""Secrets that the fixed patterns leave to the entropy spans."""

import random

import pytest

from airway.llm import secret_scan

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def random_text(seed, alphabet, size=40):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(size))


def covered(text):
    return {x for a, _, b in secret_scan.scan(text.encode()) for x in range(a, b)}


@pytest.mark.parametrize("letters", [LOWER, UPPER])
def test_tokens_of_one_case_and_digits_are_found(letters):
    for seed in range(50):
        key = random_text(seed, letters + DIGITS)
        text = f"see {key} there"
        assert len(covered(text) & set(range(4, 44))) >= 30
    assert not covered("donaudampfschifffahrtsgesellschaft and AAAAAAAAAA0000000000 and 20240101000000000000")


def test_a_secret_joined_to_a_pattern_is_found():
    access, digest = "AKIA" + "Z7" * 8, "0a1b2c3d4e5f" * 2
    for seed in range(20):
        key = random_text(seed, LOWER + UPPER + DIGITS)
        for before, joint in [(access, "/"), (access, "+"), (access, "="), (access, "-"), (access, "_"), (digest, "-"), (digest, "_"), (digest, "/")]:
            text = f"x {before}{joint}{key} y"
            at = text.index(key)
            assert set(range(at, at + 38)) <= covered(text)
            assert secret_scan.scan(text.encode())[0][:1] + secret_scan.scan(text.encode())[0][2:] == (2, 2 + len(before))
        backwards = f"x {key}-{digest} y"
        assert set(range(4, 42)) <= covered(backwards)


def test_words_before_an_assignment_are_no_secret():
    text = "my_api_key=q7Zr9TfK2mXv4LpW8sNd"
    assert [k for _, k, _ in secret_scan.scan(text.encode())] == [0]


def test_harmless_words_explain_only_themselves():
    for seed in range(20):
        key = random_text(seed, LOWER + UPPER + DIGITS)
        for before in ("configs/example/", "your_key=", "=====", "-----", "dummy-", "xxxxxx_", "0123456789/"):
            text = f"x {before}{key} y"
            at = text.index(key)
            assert set(range(at, at + 38)) <= covered(text)
    blob = random_text(3, LOWER + UPPER + DIGITS, 200)
    assert len(covered(blob[:100] + "dummy" + blob[100:])) >= 190


def test_what_is_harmless_stays_unmarked():
    alphabet = UPPER + LOWER + DIGITS + "+/"
    for text in (
        alphabet,
        DIGITS + LOWER + UPPER,
        "abC1" * 9,
        "123E4567-e89b-12d3-a456-426614174000",
        "YOUR_API_KEY_goes_here_2024",
        "sk-exampleKey1234567890",
        "=" * 40,
        "docs/Example/Release_v1",
    ):
        assert not covered(f"x {text} y"), text
