"""Passages that repeat: MinHash bands over paragraphs.

Paragraphs that share a band are candidates, exact Jaccard similarity of their shingle
sets decides, and of each component of similar paragraphs all but the first go.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, code_points, map_batches
from airway.llm.linking import link, semi_join
from airway.llm.near_dedup import SLACK, list_array, shingle_set, with_partners
from airway.sources.staging import Work, session_work

WIDTH = 5
PERCENT = 80
# Shorter paragraphs (headings, boilerplate) may repeat.
MIN_WORDS = 25
# Two paragraphs of similarity s share a band with probability 1 - (1 - s ** ROWS) ** BANDS: 0.99996 at 0.8.
BANDS, ROWS = 10, 2
# Values that a pair's similarity is estimated from; paragraphs up to this size are compared exactly.
ESTIMATE = 128
_MULTIPLY = np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)


def bands(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band of a set's MinHash signature."""
    mixed = shingles.view(np.uint64)[:, None] * _MULTIPLY
    least = (mixed ^ (mixed >> np.uint64(29))).min(0).reshape(BANDS, ROWS)
    return np.array([xxhash.xxh3_64_intdigest(x.tobytes(), seed=i) for i, x in enumerate(least)], np.uint64).view(np.int64)


def paragraphs(text: bytes, min_words: int) -> list[tuple[int, int, int, list[bytes]]]:
    """``(number, start, end, lower-cased words)`` of the lines with enough words;
    positions in code points."""
    found, at = [], 0
    for number, line in enumerate(text.split(b"\n")):
        size = code_points(line)
        words = line.lower().split()
        if len(words) >= min_words:
            found.append((number, at, at + size, words))
        at += size + 1
    return found


def _occurrences(docs: DataFrame, id_column: str, text: str, width: int, min_words: int) -> DataFrame:
    def start():
        def work(columns):
            out: tuple[list, ...] = tuple([] for _ in range(7))
            for doc, raw in zip(*columns, strict=True):
                for number, a, b, words in paragraphs(raw or b"", min_words):
                    items = shingle_set(words, width)
                    row = (doc, number, a, b, len(items), xxhash.xxh3_128_digest(items.tobytes()), bands(items))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            return [*out[:6], list_array(out[6])]

        return work

    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), as_bytes(text))
    return map_batches(rows, start, "id long, paragraph int, start long, end long, size long, node binary, bands array<long>")


def _sets(docs: DataFrame, id_column: str, text: str, width: int, min_words: int, members: DataFrame, work: Work) -> DataFrame:
    """``node, size, sketch, items`` of the members, read from one occurrence each."""
    wanted = work.stage(members.groupBy("id").agg(F.collect_set("paragraph").alias("numbers")), "wanted")

    def start():
        def run(columns):
            nodes, sets = [], []
            for raw, numbers in zip(*columns, strict=True):
                numbers = set(numbers)
                for number, _, _, words in paragraphs(raw or b"", min_words):
                    if number in numbers:
                        sets.append(shingle_set(words, width))
                        nodes.append(xxhash.xxh3_128_digest(sets[-1].tobytes()))
            return nodes, [len(s) for s in sets], list_array([s[:ESTIMATE] for s in sets]), list_array(sets)

        return run

    rows = semi_join(docs.select(F.col(id_column).alias("id"), as_bytes(text)), wanted, ["id"], "inner").select(text, "numbers")
    found = map_batches(rows, start, "node binary, size long, sketch array<long>, items array<long>")
    return semi_join(found, members.select("node"), ["node"]).dropDuplicates(["node"])


def repeated_paragraphs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
    min_words: int = MIN_WORDS,
    work: Work | None = None,
) -> DataFrame:
    """One row per paragraph that is like another: ``id, paragraph, start, end, first_id,
    first_paragraph, removed``; runs jobs.

    Paragraphs are lines of at least ``min_words`` words between ASCII white space;
    ``paragraph`` is the line's number from 0, ``start`` and ``end`` its code points. Two
    are alike if their sets of ``width``-word shingles (A-Z lowered) have ``percent``
    Jaccard similarity; ``first_id, first_paragraph`` name the least occurrence reachable
    over such links, in this document or another, and all but it are ``removed``. Null
    and empty texts have no paragraphs; rows without id cannot be named and take no part;
    a repeated row is the same document and repeats nothing. Other columns are not read."""
    work = work or session_work(docs.sparkSession)
    found = work.stage(_occurrences(docs, id_column, text, width, min_words), "paragraphs")
    here = F.struct("id", "paragraph")
    nodes = found.groupBy("node").agg(F.min(here).alias("first"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    nodes = work.stage(nodes.select("node", "size", "bands", "first.id", "first.paragraph"), "nodes")
    members = work.stage(with_partners(nodes, "bands", F.lit(BANDS), F.lit(1)), "members")
    postings = work.stage(members.select(F.explode("bands").alias("bucket"), "node", "size", "own"), "postings")
    sets = work.stage(_sets(docs, id_column, text, width, min_words, members, work), "sets")
    roots = link(postings, sets, percent, ESTIMATE, SLACK, work)

    places = found.select("id", "paragraph", "start", "end", "node").distinct()
    rooted = work.stage(places.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node"), "rooted")
    firsts = rooted.groupBy("root").agg(F.count("*").alias("n"), F.min(here).alias("first")).where("n > 1")
    repeated = rooted.join(work.stage(firsts.select("root", "first"), "firsts"), "root")
    return repeated.select(
        "id",
        "paragraph",
        "start",
        "end",
        F.col("first.id").alias("first_id"),
        F.col("first.paragraph").alias("first_paragraph"),
        (here != F.col("first")).alias("removed"),
    )
