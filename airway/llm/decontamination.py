"""Benchmark texts in documents, by Wu-Manber search over words.

The strings to find are windows of consecutive item words. A table gives for every block
of two words how far the search may move on; only where it may not move, the bucket of a
suffix hash, over all words of a window, names the places of item words to compare directly.
Windows of one length share a table, so that a short item does not shorten the steps of the others.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, fresh, map_batches, plain_words
from airway.llm.linking import semi_join
from airway.sources.staging import Work, session_work

WINDOW = 10
# Item words, and bytes of item texts, searched for in one pass over the documents; a larger benchmark
# takes several passes. A task's tables take about 250 bytes a word.
PASS_WORDS, PASS_BYTES = 500_000, 16_000_000


class WordSearch:
    """Wu-Manber tables of all windows that have one length. ``words`` are those of all items
    in one list, ``starts`` the place of each item's first."""

    def __init__(self, length: int, words: list[bytes], starts: list[int]):
        self.length, self.words, self.starts = length, words, starts
        self.block = min(2, length)
        # By hashes: of two blocks that share one the smaller step holds.
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[int] | int] = {}

    def _item(self, place: int) -> int:
        return bisect_right(self.starts, place) - 1

    def add(self, place: int) -> None:
        m, b = self.length, self.block
        window = tuple(self.words[place : place + m])
        for end in range(b, m + 1):
            block = hash(window[end - b : end])
            self.shift[block] = min(self.shift.get(block, m), m - end)
        key = hash(window)
        known = self.buckets.get(key)
        if known is None:
            self.buckets[key] = place
            return
        places = known if isinstance(known, list) else [known]
        # Items come one after the other: a window that this item has already is not listed again.
        if self._item(places[-1]) != self._item(place) or not self._holds(places[-1], window):
            places.append(place)
            self.buckets[key] = places

    def _holds(self, place: int, window: tuple) -> bool:
        return tuple(self.words[place : place + self.length]) == window

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Start and items of every occurrence."""
        m, b, n = self.length, self.block, len(words)
        shift, buckets, far = self.shift, self.buckets, m - b + 1
        end = m
        while end <= n:
            block = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            step = shift.get(hash(block), far)
            if step:
                end += step
                continue
            window = tuple(words[end - m : end])
            known = buckets.get(hash(window))
            if known is not None:
                items = [self._item(p) for p in (known if isinstance(known, list) else [known]) if self._holds(p, window)]
                if items:
                    yield end - m, items
            end += 1


def build(items: list[list[bytes]], window: int) -> list[WordSearch]:
    """Tables for the windows of items given as words, by window length."""
    tables: dict[int, WordSearch] = {}
    one: dict[bytes, bytes] = {}  # equal words are one object
    words: list[bytes] = []
    starts: list[int] = []
    for item in items:
        starts.append(len(words))
        words.extend(one.setdefault(w, w) for w in item)
    for start, item in zip(starts, items, strict=True):
        length = min(window, len(item))
        if not length:
            continue
        table = tables.setdefault(length, WordSearch(length, words, starts))
        for place in range(start, start + len(item) - length + 1):
            table.add(place)
    return list(tables.values())


def search(tables: list[WordSearch], words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged hit ranges (of words, end exclusive) and the items that occur."""
    spans, items = [], set()
    for table in tables:
        for start, found in table.find(words):
            spans.append((start, start + table.length))
            items.update(found)
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged, items


def _passes(benchmark: DataFrame, id_column: str, text: str, limit: int, limit_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items as words, streamed to the driver in groups of about ``limit`` words or ``limit_bytes``."""
    group, held, size = [], 0, 0
    for name, raw in benchmark.select(F.col(id_column).cast("string"), as_bytes(text)).toLocalIterator(prefetchPartitions=False):
        words = plain_words(bytes(raw or b""))
        group.append((name or "", words))
        held += len(words)
        size += len(raw or b"")
        if held >= limit or size >= limit_bytes:
            yield group
            group, held, size = [], 0, 0
    yield group


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_words: int = PASS_WORDS,
    pass_bytes: int = PASS_BYTES,
    work: Work | None = None,
) -> DataFrame:
    """One row per document: ``id, print, n_words, hits, items``; reads the benchmark.

    Words are runs of ASCII letters and digits and of all characters above them, A-Z
    lowered. ``hits`` are ranges of words (``from``, ``to`` exclusive) inside occurrences
    of a window of ``window`` consecutive item words (a shorter item is one window);
    ``items`` the ids of items that occur, as text, sorted, each once. Null and empty
    texts have no words, on either side. An item without id is searched for under the
    empty id. Repeated rows give repeated results; ``print`` is ``xxhash64`` of the text.

    Texts of any length are read whole; empty tables give no rows or no hits. Other columns of
    either table are not read. Items with equal windows are all named.

    Item words are bounded per pass: documents are scanned once for every
    ``pass_words`` item words, or ``pass_bytes`` of their texts, and the results of the passes united."""
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), as_bytes(text))

    def scan(group):
        names, items = [g[0] for g in group], [g[1] for g in group]

        def start():
            tables = build(items, window)

            def run(columns):
                counts, hits, found = [], [], []
                for raw in columns[2]:
                    words = plain_words(raw or b"")
                    spans, numbers = search(tables, words)
                    counts.append(len(words))
                    hits.append([{"from": a, "to": b} for a, b in spans])
                    found.append(sorted({names[i] for i in numbers}))
                return columns[0], columns[1], counts, hits, found

            return run

        schema = "id long, print long, n_words long, hits array<struct<from:long,to:long>>, items array<string>"
        return map_batches(rows, start, schema)

    scans = [scan(group) for group in _passes(benchmark, item_id, item_text, pass_words, pass_bytes)]
    if len(scans) == 1:
        return scans[0]
    work = work or session_work(docs.sparkSession)
    more = scans[1].where("size(hits) > 0")
    for each in scans[2:]:
        more = more.unionByName(each.where("size(hits) > 0"))
    # Results depend on the text alone, so passes meet by its print and length.
    more = work.stage(more.groupBy("print", "n_words").agg(F.collect_set("hits").alias("hits_2"), F.collect_set("items").alias("items_2")), "passes")
    joined = scans[0].join(more, ["print", "n_words"], "left")
    spans = F.sort_array(F.concat(F.col("hits"), F.flatten(F.coalesce("hits_2", F.array()))))
    kind = "array<struct<from:long,to:long>>"
    united = F.aggregate(
        spans,
        F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["to"] >= x["from"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["from"].alias("from"), F.greatest(F.element_at(done, -1)["to"], x["to"]).alias("to")
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    names = F.sort_array(F.array_distinct(F.concat(F.col("items"), F.flatten(F.coalesce("items_2", F.array())))))
    return joined.select("id", "print", "n_words", united.alias("hits"), names.alias("items"))


def hit_words(hits: str = "hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["to"] - h["from"])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without documents that hold a benchmark window. All columns stay; null
    and empty texts stay. A row is judged by its text, whatever its id."""
    work = options.pop("work", None) or session_work(docs.sparkSession)
    found = find_benchmark(docs, benchmark, id_column, text, work=work, **options)
    (mark,) = fresh(docs, "_print")
    gone = work.stage(found.where("size(hits) > 0").select(F.col("print").alias(mark)).distinct(), "contaminated")
    return semi_join(docs, gone, F.xxhash64(text) == F.col(mark), "left_anti")
