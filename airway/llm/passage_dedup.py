"""Passages that repeat, exactly or nearly, wherever lines begin and end.

A text is its words, in one sequence. Words whose hash is the least of a window of
neighbours are anchors, which depend on content only. From every sparse anchor a unit of
words reaches to a dense anchor further on: these are the paragraphs, whatever the layout.
Units with the same words are one node. MinHash bands over word shingles put nodes into
lists; nodes that meet in a list are compared by their exact edit distance in words, and
components of similar nodes are one passage. Adjacent units that occur elsewhere are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, map_batches
from airway.llm.linking import components
from airway.llm.near_dedup import list_array
from airway.sources.staging import Work, session_work, shuffles_removed

# A sparse anchor is in any SPARSE successive words, a dense one in any DENSE; a unit has LEAST words or up to
# DENSE - 1 more. Two texts that share SURE words share a unit of them: the first sparse anchor that only these
# words decide is among the first 24, the unit's end among the first 48, and words hash with the GRAM - 1 that follow.
SPARSE, DENSE, LEAST, GRAM = 24, 6, 18, 3
SURE = 50
WIDTH = 5
# Units of Jaccard similarity s share a band with probability 1 - (1 - s ** ROWS) ** BANDS: 0.95 at 0.8, 0.77 where
# one word in the middle of a unit differs. A passage holds several units.
BANDS, ROWS = 3, 2
# Two units are alike if their edit distance in words leaves this percentage of the longer one.
PERCENT = 80
# Rows of a list that all meet; in longer lists only those that share a rare word do.
FEW = 16
# Words that head a unit, where pairs are told apart by few bits.
HEAD = 8
# Bytes of text whose words are hashed and mixed at a time.
GROUP = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_MULTIPLY = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = np.random.default_rng(6).integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)


def _powers(multiply: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, multiply, np.uint64)))


def _grams(hashed: np.ndarray, size: int) -> np.ndarray:
    mixed = np.zeros(len(hashed) - size + 1, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(_MULTIPLY[0]) + hashed[i : i + len(mixed)]
    return mixed ^ (mixed >> np.uint64(29))


def _anchors(mixed: np.ndarray, window: int, usable: np.ndarray | None = None) -> np.ndarray:
    """Places of the first least value of every window, or of those whose first places are ``usable``."""
    value, least, size = mixed, np.arange(len(mixed)), 1
    while size < window:
        # Of two windows that adjoin or overlap the left one's least stays unless the right one's is less.
        step = min(size, window - size)
        less = value[step:] < value[:-step]
        value = np.where(less, value[step:], value[:-step])
        least = np.where(less, least[step:], least[:-step])
        size += step
    if usable is not None:
        least = least[usable[: len(least)]]
    return least[np.append(True, least[1:] != least[:-1])[: len(least)]]


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def unit_words(hashed: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``first, last`` (exclusive) words of the units of a text, or of texts one after the other;
    then ``ends`` has for each word where its text ends."""
    if len(hashed) < SPARSE + GRAM - 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = _grams(hashed, GRAM)
    ends = np.full(len(hashed), len(hashed)) if ends is None else ends
    left = ends - np.arange(len(hashed))
    starts, stops = (_anchors(mixed, window, left >= window + GRAM - 1) for window in (SPARSE, DENSE))
    found = np.searchsorted(stops, starts + LEAST)
    last = np.append(stops, len(hashed))[found]
    whole = last < ends[starts]
    return starts[whole], last[whole]


def units(text: bytes) -> tuple[np.ndarray, ...]:
    """``first, last, start, end, a, b, band...`` of the units of a text: words from 0 (``last``
    exclusive), code points, 128 bits of hash, and a hash for each band. A-Z is lowered."""
    return units_of([text])[1:]


def units_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Place of the text, and its ``units``, of all texts at once."""
    text = b" ".join(texts)
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    begin = np.flatnonzero(~space & np.append(True, space[:-1])[: len(raw)])
    stop = np.flatnonzero(~space & np.append(space[1:], True)[: len(raw)]) + 1
    hashed = word_hashes(text)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    words = np.searchsorted(begin, at)
    first, last = unit_words(hashed, np.repeat(words[1:], np.diff(words)))
    if not len(first):
        return tuple(np.empty(0, np.int64) for _ in range(7 + BANDS))
    points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    keys = []
    for multiply in _MULTIPLY:
        # Sums of hash * multiply ** place, moved to place 0 by the inverse (modulo 2 ** 64).
        sums = np.append(np.uint64(0), np.cumsum(hashed * _powers(multiply, len(hashed))[:-1]))
        back = _powers(pow(multiply, -1, 1 << 64), len(hashed))
        keys.append(((sums[last] - sums[first]) * back[first]).view(np.int64))
    # The least of each mixed shingle hash over a unit's shingles, all units at once.
    shingles = np.append(_grams(hashed, WIDTH), np.uint64(0xFFFFFFFFFFFFFFFF))
    spans = np.stack([first, last - WIDTH + 1], 1).ravel()
    least = []
    for multiply in _MIX:
        mixed = shingles * multiply
        mixed ^= mixed >> np.uint64(31)
        least.append(np.minimum.reduceat(mixed, spans)[::2])
    bands = []
    for band in range(BANDS):
        mixed = np.full(len(first), band + 1, np.uint64)
        for row in range(ROWS):
            mixed = (mixed ^ least[band * ROWS + row]) * np.uint64(_MULTIPLY[1])
            mixed ^= mixed >> np.uint64(32)
        bands.append(mixed.view(np.int64))
    of = np.searchsorted(words, first, "right") - 1
    zero = points[at[of]]
    return of, first - words[of], last - words[of], points[begin[first]] - zero, points[stop[last - 1]] - zero, *keys, *bands


_BANDS = [f"band{i}" for i in range(BANDS)]
_PLACES = ("first", "last", "start", "end")


def _units(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    names = ["first", "last", "start", "end", "a", *_BANDS]

    def start():
        def work(columns):
            made = [[np.empty(0, np.int64)] * (1 + len(names))]
            ids, texts = np.array(columns[0], np.int64), [raw or b"" for raw in columns[1]]
            # Together as many texts as make some GROUP bytes.
            groups = np.cumsum([len(t) for t in texts]) // GROUP
            for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(groups)) + 1):
                of, *found = units_of([texts[i] for i in group])
                # Without the second half of the hash, which no step reads.
                made.append([ids[group[of]], *(c for i, c in enumerate(found) if i != 5)])
            return [pa.array(np.concatenate(c)) for c in zip(*made, strict=True)]

        return work

    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), as_bytes(text))
    return map_batches(rows, start, "id long, " + ", ".join(f"{n} {'int' if n in _PLACES else 'long'}" for n in names))


def _words_of(docs: DataFrame, id_column: str, text: str, wanted: DataFrame) -> DataFrame:
    """``a, id, first, words`` of nodes, read from the one occurrence given (``a, id, first``); as often
    as rows of this id have it."""
    places = wanted.groupBy("id").agg(F.collect_list(F.struct("first", "a")).alias("places"))

    def start():
        def work(columns):
            keys, ids, firsts, words = [], [], [], []
            for i, raw, found in zip(*columns, strict=True):
                hashed = word_hashes(raw or b"")
                first, last = unit_words(hashed)
                ends = dict(zip(first.tolist(), last.tolist(), strict=True))
                for place in found:
                    # Another row of this id may have another text.
                    if place["first"] in ends:
                        part = hashed[place["first"] : ends[place["first"]]]
                        if _key(part) == place["a"]:
                            keys.append(place["a"])
                            ids.append(i)
                            firsts.append(place["first"])
                            words.append(part.view(np.int64))
            return keys, ids, firsts, list_array(words)

        return work

    rows = docs.select(F.col(id_column).cast("long").alias("id"), as_bytes(text)).join(places.hint("shuffle_hash"), "id").select("id", text, "places")
    return map_batches(rows, start, "a long, id long, first int, words array<long>")


def _key(hashed: np.ndarray) -> int:
    return int((hashed * _powers(_MULTIPLY[0], len(hashed))[:-1]).sum(dtype=np.uint64).view(np.int64))


def _padded(arrays: pa.ListArray, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes, and a column for each position with the values there, ``fill`` where there are none."""
    sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.full((len(sizes), int(sizes.max(initial=0))), fill, np.int64)
    found[np.arange(found.shape[1]) < sizes[:, None]] = arrays.flatten().to_numpy(zero_copy_only=False)
    return sizes, np.ascontiguousarray(found.T)


def distances(x: pa.ListArray, y: pa.ListArray) -> np.ndarray:
    """Edit distances of arrays of numbers, pair by pair. The table of a pair is filled row by
    row, each cell for all pairs at once; a pair's distance stands where both arrays end."""
    (size_x, of_x), (size_y, of_y) = _padded(x, 0), _padded(y, 0)
    found = np.where(size_x == 0, size_y, 0).astype(np.int32)
    row = [np.full(len(found), j, np.int32) for j in range(len(of_y) + 1)]
    for i, values in enumerate(of_x, 1):
        before, row[0] = row[0], np.full(len(found), i, np.int32)
        for j, others in enumerate(of_y, 1):
            cell = np.minimum(row[j], row[j - 1]) + np.int32(1)
            np.minimum(cell, before + (values != others), out=cell)
            before, row[j] = row[j], cell
        ended = np.flatnonzero(size_x == i)
        if len(ended):
            found[ended] = np.stack([r[ended] for r in row])[size_y[ended], np.arange(len(ended))]
    return found


def edit_distance(x: Column, y: Column) -> Column:
    """Edit distance of two short arrays."""

    @F.arrow_udf("int")
    def of(xs: pa.Array, ys: pa.Array) -> pa.Array:
        steps = range(0, len(xs), 4096)
        return pa.array(np.concatenate([distances(xs.slice(i, 4096), ys.slice(i, 4096)) for i in steps]) if len(xs) else [], pa.int32())

    return of(x, y)


def _apart(x: str, y: str) -> Column:
    """Whether the units at two places do not overlap. Units that overlap are like each other and repeat nothing."""
    return (F.col(f"{x}.id") != F.col(f"{y}.id")) | (F.abs(F.col(f"{x}.first") - F.col(f"{y}.first")) >= LEAST + DENSE)


def _verified(pairs: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar."""
    full = pairs
    for side in ("x", "y"):
        full = full.join(words.select(F.col("a").alias(side), F.col("words").alias(f"words_{side}")), side)
    size = F.greatest(F.size("words_x"), F.size("words_y"))
    near = F.lit(100) * (size - edit_distance(F.col("words_x"), F.col("words_y"))) >= F.lit(percent) * size
    return full.where(near).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _marked(words: DataFrame, percent: int) -> DataFrame:
    """``a, words`` and ``mark``: the most edits that leave a unit like one of its size, and bits of its words; of
    those before HEAD and of those that ``edits`` of the longest unit cannot move there."""
    longest = (100 - percent) * (LEAST + DENSE - 1) // 100

    def bits(of: str) -> Column:
        return F.expr(f"aggregate({of}, 0L, (bits, word) -> bits | shiftleft(1L, cast(word & 63 AS int)))")

    edits = F.floor(F.lit(100 - percent) * F.size("words") / 100).cast("int")
    tail = f"slice(words, {HEAD + longest + 1}, {LEAST + DENSE})"
    return words.select("a", "words", F.struct(edits.alias("edits"), bits("words").alias("all"), bits(f"slice(words, 1, {HEAD})").alias("head"), bits(tail).alias("tail")).alias("mark"))


def _may_be_near(x: str, y: str) -> Column:
    """False only for pairs of marked units that are not alike. A word that the other unit lacks costs an edit; one edit
    never replaces a word of a head by one of the other's tail, so what both lack there adds up."""

    def lacking(part: str, one: str, other: str) -> Column:
        return F.bit_count(F.col(f"{one}.{part}").bitwiseAND(F.bitwise_not(F.col(f"{other}.all"))))

    edits = F.greatest(f"{x}.edits", f"{y}.edits")
    found = F.lit(True)
    for one, other in ((x, y), (y, x)):
        found = found & (lacking("all", one, other) <= edits) & (lacking("head", one, other) + lacking("tail", other, one) <= edits)
    return found


def _keyed(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with ``keys`` for their ``words``: only null in a list of up to FEW rows, in others the rarest words of the
    list, one more than the edits that leave the longest unit alike. Units that are alike share one of these: else
    one of them would have so many words that the other lacks."""
    most = (100 - percent) * (LEAST + DENSE - 1) // 100 + 1
    of_word = rows.withColumn("_rows", F.count("*").over(Window.partitionBy("band"))).where(F.col("_rows") > FEW)
    of_word = of_word.select("band", "a", F.explode(F.array_distinct("words")).alias("word"))
    rare = of_word.withColumn("_n", F.count("*").over(Window.partitionBy("band", "word"))).groupBy("band", "a")
    rare = rare.agg(F.slice(F.sort_array(F.collect_list(F.struct("_n", "word"))), 1, most)["word"].alias("keys"))
    return rows.drop("words").join(rare, ["band", "a"], "left").withColumn("keys", F.coalesce("keys", F.array(F.lit(None).cast("long"))))


def _near_roots(docs: DataFrame, id_column: str, text: str, lists: DataFrame, percent: int, work: Work) -> DataFrame:
    """``node, root`` of nodes that are like another node of one of their lists. ``lists``:
    staged ``band, a, low``. First each node meets the least of its list; in long lists that still
    mix components it meets the least of those that share a rare word with it; then nodes
    of different components meet, in long lists if they share a rare word.
    Lists whose units all overlap, and pairs that do, are left out before words are read."""
    of_list = Window.partitionBy("band")
    with Work(docs.sparkSession) as own:
        leader = F.min(F.struct("a", "low")).over(of_list)
        ends = lists.select("band", "a", "low", leader.alias("x"), F.min("low").over(of_list).alias("_low"), F.max("low").over(of_list).alias("_high"))
        mixed = own.stage(ends.where(_apart("_low", "_high")).drop("_low", "_high"), "mixed")
        tries = own.stage(mixed.where((F.col("a") != F.col("x.a")) & _apart("low", "x.low")).select("x.a", F.col("a").alias("y")).toDF("x", "y").distinct(), "tries")
        places = mixed.select("a", "low").groupBy("a").agg(F.min("low").alias("low"))
        words = own.stage(_words_of(docs, id_column, text, places.select("a", "low.id", "low.first")).dropDuplicates(["a"]), "words")
        first = own.stage(_verified(tries, words, percent), "links")
        roots = components(first, work)

        # ``x`` is the leader of the list, which all others have met.
        rooted = mixed.where("a <> x.a").select("band", "a", "low").join(roots, F.col("a") == F.col("node"), "left")
        rooted = rooted.select("band", "a", "low", F.coalesce("root", "a").alias("root"))
        still = rooted.select("*", F.min("root").over(of_list).alias("_low"), F.max("root").over(of_list).alias("_high"))
        still = still.where("_low <> _high").select("band", "a", "low", "root")
        open_rows = own.stage(_keyed(still.join(_marked(words, percent), "a"), percent), "open")
        key = Window.partitionBy("band", "key")
        posts = open_rows.where("keys[0] IS NOT NULL").select("*", F.explode("keys").alias("key"))
        led = posts.select("a", "low", "root", "mark", F.min(F.struct("a", "low", "root", "mark")).over(key).alias("x"))
        led = led.where((F.col("root") != F.col("x.root")) & _apart("low", "x.low") & _may_be_near("mark", "x.mark"))
        second = own.stage(_verified(led.select("x.a", F.col("a").alias("y")).toDF("x", "y").distinct(), words, percent), "links")
        if not second.isEmpty():
            first = first.unionByName(second)
            roots = components(first, work)
            open_rows = open_rows.drop("root").join(roots, F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a"))

        sides = open_rows.select("band", F.explode("keys").alias("key"), "a", "low", "root", "mark", "keys")
        left, right = [sides.select("band", "key", *[F.col(c).alias(f"{c}_{side}") for c in ("a", "low", "root", "mark", "keys")]) for side in "xy"]
        meet = (left["band"] == right["band"]) & left["key"].eqNullSafe(right["key"]) & (F.col("root_x") < F.col("root_y"))
        meet = meet & _apart("low_x", "low_y") & _may_be_near("mark_x", "mark_y")
        # A pair meets at the first key that both have.
        meet = meet & F.array_intersect("keys_x", "keys_y")[0].eqNullSafe(left["key"])
        rest = left.join(right, meet).select(F.col("a_x").alias("x"), F.col("a_y").alias("y"))
        third = own.stage(_verified(rest.distinct(), words, percent), "links")
        return roots if third.isEmpty() else components(first.unionByName(third), work)


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT, work: Work | None = None
) -> DataFrame:
    """One row per passage that repeats: ``id, start, end, n_words, first_id, removed``; runs jobs.

    A passage is a maximal run of adjoining units that occur elsewhere too, in this
    document or another, with the same words (between ASCII white space, A-Z lowered) or with
    an edit distance in words that leaves ``percent`` of the longer unit. Of every run of
    ``SURE`` words that occurs twice a unit is found; shorter ones of ``LEAST`` words or more
    may be. Similar units are found by their bands, so a unit may be missed where the other
    units of its passage are not. ``start`` and ``end`` are code points. Of every component of
    similar units the least occurrence by id and place stays, all others are ``removed``;
    ``first_id`` is the document with the least occurrence of the passage's first unit. Null and
    empty texts have no units, texts of any length are read whole, an empty table gives no rows.
    Rows without id take no part; a repeated row is the same document and repeats nothing.
    Ids are integers; other columns are not read."""
    work = work or session_work(docs.sparkSession)
    place = F.struct("id", "first")
    with shuffles_removed(docs.sparkSession):
        found = work.stage(_units(docs, id_column, text), "units")
        banded = found.select(F.explode(F.array(*_BANDS)).alias("band"), "a", "id", "first").repartition("band")
        # Rows travel once: where a band is, its nodes are made and its rows counted.
        shared = banded.groupBy("band", "a").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("_n"))
        shared = shared.withColumn("_rows", F.sum("_n").over(Window.partitionBy("band"))).where("_rows > 1")
        lists = work.stage(shared.drop("_n", "_rows"), "lists")
        roots = _near_roots(docs, id_column, text, lists, percent, work)

        # Nodes that occur twice, or that are like another node.
        nodes = lists.groupBy("a").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        nodes = nodes.join(roots, F.col("a") == F.col("node"), "left").where("node IS NOT NULL OR low <> high")
        nodes = work.stage(nodes.select("a", F.coalesce("root", "a").alias("root"), "low", "high"), "nodes")
        firsts = nodes.groupBy("root").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
        repeated = work.stage(nodes.select("a", "root").join(firsts.select("root", F.col("low").alias("least")), "root").select("a", "least"), "repeated")

    rows = found.select("id", "first", "last", "start", "end", "a").join(repeated.hint("shuffle_hash"), "a").select(
        "id", "first", "last", "start", "end", F.col("least.id").alias("first_id"), (place != F.col("least")).alias("removed")
    )
    kind = Window.partitionBy("id", "removed").orderBy("first", "last")
    before = F.max("last").over(kind.rowsBetween(Window.unboundedPreceding, -1))
    # Copies of a row, windows and runs all lie within an id and kind, so rows travel once.
    rows = rows.repartition("id", "removed").distinct()
    rows = rows.withColumn("_new", F.coalesce(F.col("first") > before, F.lit(True)).cast("int"))
    runs = rows.withColumn("_run", F.sum("_new").over(kind.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "removed", "_run")
    made = runs.agg(
        F.min("start").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        (F.max("last") - F.min("first")).cast("long").alias("n_words"),
        F.min(F.struct("first", "first_id")).alias("_first"),
    )
    return made.select("id", "start", "end", "n_words", F.col("_first.first_id").alias("first_id"), "removed")
