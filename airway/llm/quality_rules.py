"""Quality rules: counted limits, and how far a document's histograms lie from its language.

The references are made from the corpus itself: for every language the mean histogram of
character classes and the mean shares of its most common words, each document weighing
the same. A document is held against them by the Jensen-Shannon distance.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, map_batches, plain_words, space_words
from airway.sources.staging import Work, session_work

# Limits of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"

COMMON_WORDS = 64
# Distances (0 to 1) from which a document is taken for something else than its language's prose.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.28
# Few words lie far from any histogram by chance alone: the bound on the word distance
# grows by this over the root of their number.
WORD_NOISE = 2.0
# Shorter documents say too little about their words to be judged by them.
WORD_GUARD = 100
# A reference made from few documents is uncertain itself: both bounds grow by this over the root of
# their number, whatever it is.
REFERENCE_NOISE = 1.0
_UNIT = 1_000_000

CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "quote", "symbol", "other", "beyond")
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)  # continuation bytes belong to the character before
for _place, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:!?", b"\"'()[]{}-", SYMBOLS)
):
    _CLASS_OF[list(_bytes)] = _place
_CLASS_OF[[b for b in range(128) if _CLASS_OF[b] == len(CLASSES)]] = CLASSES.index("other")
_CLASS_OF[192:] = CLASSES.index("beyond")


def class_counts(text: bytes) -> np.ndarray:
    """Characters of each class."""
    return np.bincount(_CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    inside = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            inside[i : i + 3] = b"\1\1\1"
    return inside.count(1)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


_NO_WORD = _SPACES + bytes(range(0x80, 0xC0))


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), len(text.translate(None, _NO_WORD)), symbols, repeated_lines(text), repeated_words(words)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence in bits) of two distributions."""
    m = (p + q) / 2

    def bits(x):
        some = x > 0
        return float(np.sum(x[some] * np.log2(x[some] / m[some])))

    return max(0.0, (bits(p) + bits(q)) / 2) ** 0.5


def _shares(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, kind, word, n``: summed shares, in millionths, of words and of character
    classes (``kind`` is the class, or -1 for a word, or -2 with ``n`` documents). Copies
    merge per batch before the shuffle; whole numbers make the sums exact."""

    def start():
        def work(columns):
            sums: Counter = Counter()
            for language, raw in zip(*columns, strict=True):
                words = plain_words(raw or b"")
                if len(words) < MIN_WORDS:
                    continue
                sums[language, -2, b""] += 1
                counts = class_counts(raw)
                for k, n in enumerate((counts * _UNIT // counts.sum()).tolist()):
                    sums[language, k, b""] += n
                unit = _UNIT / len(words)
                for word, n in Counter(words).items():
                    sums[language, -1, word] += int(n * unit)
            keys = list(sums)
            return [k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [sums[k] for k in keys]

        return work

    parts = map_batches(docs.select(F.col(lang).alias("lang"), as_bytes(text)), start, "lang string, kind int, word binary, n long")
    return parts.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, lang: str, text: str, common: int, work: Work) -> dict:
    """Language -> (class shares, common words, their shares, documents). Reads the whole
    corpus; only the common words of each language come to the driver. No language (null)
    has no reference."""
    sums = work.stage(_shares(docs, lang, text), "shares")
    own = sums.where("lang IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    words = own.where("kind = -1").withColumn("_rank", rank).where(F.col("_rank") <= common).drop("_rank")
    made: dict = {}
    for language, kind, word, n in own.where("kind <> -1").unionByName(words).collect():
        made.setdefault(language, {})[kind, bytes(word)] = n
    result = {}
    for language, found in made.items():
        n_docs = found[-2, b""]
        chars = np.array([found.get((k, b""), 0) for k in range(len(CLASSES))], float)
        top = sorted(w for k, w in found if k == -1)
        share = np.array([found[-1, w] / (n_docs * _UNIT) for w in top])
        result[language] = (chars / chars.sum(), top, np.append(share, max(0.0, 1 - share.sum())), n_docs)
    return result


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    common: int = COMMON_WORDS,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    word_guard: int = WORD_GUARD,
    work: Work | None = None,
) -> DataFrame:
    """One row per input row; runs a job for the references. Columns: ``id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, char_distance, word_distance,
    base_failed, kept``.

    A text fails the base rules with fewer than 50 words or more than half of its words
    in repeated 3-word windows; null and empty texts have no words and fail. Others are
    kept if both distances to the reference of their language stay within the bounds. These
    grow by ``REFERENCE_NOISE`` over the root of the number of documents that the reference
    is made from, that on words also for short texts by ``WORD_NOISE`` over the root of the
    word count; texts of fewer than ``word_guard`` words are judged by characters alone (their
    word distance is null). A null language gives no distance: its texts are kept unless
    they fail the base rules. Texts of any length are read whole, an empty table gives no
    rows; words of equal shares are common in byte order. Rows are judged by themselves:
    repeated rows and rows without id give a row each; other columns are not read."""
    work = work or session_work(docs.sparkSession)
    known = references(docs, lang, text, common, work)

    def start():
        places = {language: {w: i for i, w in enumerate(top)} for language, (_, top, _, _) in known.items()}

        def distances(language, raw, n_words):
            if language not in known or n_words < MIN_WORDS:
                return None, None
            chars, top, shares, _ = known[language]
            counts = class_counts(raw)
            by_char = js_distance(counts / counts.sum(), chars)
            words = plain_words(raw)
            if len(words) < word_guard:
                return by_char, None
            place, held = places[language], np.zeros(len(top) + 1)
            for word in words:
                held[place.get(word, -1)] += 1
            return by_char, js_distance(held / len(words), shares)

        def run(columns):
            ids, languages, texts = columns
            rows = []
            for language, raw in zip(languages, texts, strict=True):
                raw = raw or b""
                base = base_counts(raw, space_words(raw))
                failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]
                near = distances(language, raw, base[0])
                slack = REFERENCE_NOISE / known[language][3] ** 0.5 if language in known else 0.0
                noise = slack + WORD_NOISE / max(1, base[0]) ** 0.5
                far = (near[0] or 0.0) > max_char_distance + slack or (near[1] or 0.0) > max_word_distance + noise
                rows.append((*base, *near, failed, not failed and not far))
            return [ids, *(list(c) for c in zip(*rows))] if rows else [[] for _ in range(10)]

        return run

    schema = (
        "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "char_distance double, word_distance double, base_failed boolean, kept boolean"
    )
    return map_batches(docs.select(F.col(id_column).alias("id"), F.col(lang).alias("lang"), as_bytes(text)), start, schema)
