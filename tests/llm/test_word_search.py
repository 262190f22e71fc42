"""Tables of the benchmark search: results against plain search, size, clashes of hashes."""

import random
import tracemalloc

import pytest

from airway.llm import decontamination


def plain(items, words, window):
    inside, found = set(), set()
    for number, item in enumerate(items):
        m = min(window, len(item))
        for i in range(len(item) - m + 1 if m else 0):
            for at in range(len(words) - m + 1):
                if words[at : at + m] == item[i : i + m]:
                    inside |= set(range(at, at + m))
                    found.add(number)
    return inside, found


@pytest.mark.parametrize("clash", [False, True])
def test_search_equals_plain_search(monkeypatch, clash):
    if clash:  # a hash of few values: every block and window meets others
        monkeypatch.setattr(decontamination, "hash", lambda x: len(x[0]) + len(x), raising=False)
    rng = random.Random(4)
    for _ in range(60):
        alphabet = [b"a", b"bb", b"c", b"dd"][: rng.randrange(1, 5)]
        items = [[rng.choice(alphabet) for _ in range(rng.randrange(9))] for _ in range(6)]
        items += [items[0], [], items[2] + items[2]]
        words = [rng.choice([*alphabet, b"z"]) for _ in range(60)]
        spans, found = decontamination.search(decontamination.build(items, 4), words)
        assert ({x for a, b in spans for x in range(a, b)}, found) == plain(items, words, 4)


def test_tables_take_a_few_hundred_bytes_a_word():
    rng = random.Random(4)
    items = [[b"w%d" % rng.randrange(30_000) for _ in range(200)] for _ in range(500)]
    tracemalloc.start()
    try:
        tables = decontamination.build(items, 10)
        size = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert tables and size < 350 * 100_000


def test_passes_are_bounded_by_bytes_and_long_texts_are_whole(spark, docs_of):
    words = [f"word{i}" for i in range(40_000)]
    benchmark = spark.createDataFrame(
        [(f"i{n}", " ".join(words[k : k + 12]), n, n) for n, k in enumerate((5, 20_000, 39_980))], "item_id string, text string, doc_id long, hits long"
    )
    docs = docs_of([(1, " ".join(words)), (1, " ".join(words)), (2, None)])
    for size in (10, 16_000_000):
        found = decontamination.find_benchmark(docs, benchmark, pass_bytes=size).orderBy("id").collect()
        assert [(r["id"], r["n_words"], r["items"]) for r in found] == [(1, 40_000, ["i0", "i1", "i2"])] * 2 + [(2, 0, [])]
        assert [(h["from"], h["to"]) for h in found[0]["hits"]] == [(5, 17), (20_000, 20_012), (39_980, 39_992)]
