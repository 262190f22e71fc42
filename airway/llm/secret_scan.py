"""Secrets in text: fixed patterns, and windows of high entropy.

Candidate strings are cut into runs of one character class. A window slides along each
run; its Shannon entropy follows from counts that change by the character that enters and
the one that leaves. What an allow-list explains is cut out of the strings first.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, map_batches, slices

# Patterns, shortest lengths and the order of the kinds.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
SHORTEST_VALUE, SHORTEST_ACCESS = 6, 20

CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharClass:
    """Characters of one alphabet, the window that slides over their runs and the
    entropy (bits a character) from which a window is taken for random. ``needs``: sets
    of characters of which a window must hold at least ``least`` each."""

    run: re.Pattern
    window: int
    bits: float
    needs: tuple[bytes, ...]
    least: int = 1


_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Random strings of the window's length reach the bound in 99 cases of 100.
CLASSES = (
    CharClass(re.compile(rb"[0-9A-F]{20,}|[0-9a-f]{20,}"), 20, 2.85, (_DIGITS, b"abcdefABCDEF")),
    CharClass(re.compile(rb"[A-Z2-7]{24,}"), 24, 3.5, (b"234567", _UPPER)),
    CharClass(re.compile(rb"[a-z0-9]{20,}"), 20, 3.35, (_DIGITS, _LOWER)),
    CharClass(re.compile(rb"[A-Z0-9]{20,}"), 20, 3.35, (_DIGITS, _UPPER)),
    CharClass(re.compile(rb"[A-Za-z0-9+/_=-]{20,}"), 20, 3.55, (_DIGITS, _LOWER, _UPPER)),
)
# Words put together hold few letters of one of the cases; that, not their form, tells them apart.
LETTERS = CharClass(re.compile(rb"[A-Za-z0-9]{20,}"), 20, 3.5, (_LOWER, _UPPER), 6)
# Strings with dots and signs inside, looked for where there are such; addresses of mail are none.
JOINED = re.compile(rb"[A-Za-z0-9+/_=.!@#$%^&*-]{20,}")
SIGN = re.compile(rb"[A-Za-z0-9+/_=-][.!@#$%^&*]+[A-Za-z0-9+/_=-]")
SIGNS = CharClass(JOINED, 20, 3.65, (_LOWER, _UPPER, _DIGITS + b"!@#$%^&*"), 2)
ADDRESS = re.compile(rb"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_ENDS = b".!*"
# Strings known to be harmless as a whole: identifiers in the usual grouping, and words.
ALLOWED = re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Za-z]+([/_-][A-Za-z]+)*[0-9]{0,4}")
# What is harmless inside a string: placeholders, the alphabet, and at its start one
# character or a short pattern over and over.
_ALPHABET = b"abcdefgh" + b"".join(b"(?:%c" % c for c in b"ijklmnopqrstuvwxyz") + b")?" * 18
HARMLESS = re.compile(
    rb"(?i:example|placeholder|changeme|your(?:[_-][a-z]+(?![a-z0-9+/]))+|your[_-]|dummy|x{6,}|0123456789|" + _ALPHABET + rb")"
)
REPEATED = re.compile(rb"(.{1,4}?)\1{4,}")
# Between separators, harmless text explains its neighbours too if they are fewer than this.
FEW = 20
PART = re.compile(rb"[A-Za-z0-9]+")
SEPARATORS = b"+/_=-"
NAME = re.compile(rb"[A-Za-z]+([/_-][A-Za-z]+)*")


def random_ranges(run: bytes, kind: CharClass) -> list[tuple[int, int]]:
    """Merged ranges of the windows of ``run`` whose entropy reaches the bound."""
    w = kind.window
    if len(run) < w:
        return []
    cost = [0.0] + [c * math.log2(c) for c in range(1, w + 1)]
    needs = [frozenset(s) for s in kind.needs]
    counts = [0] * 256
    held = [0] * len(needs)
    total = 0.0  # sum of c * log2(c)
    found: list[tuple[int, int]] = []
    bound = (math.log2(w) - kind.bits) * w + 1e-9
    for i, c in enumerate(run):
        total += cost[counts[c] + 1] - cost[counts[c]]
        counts[c] += 1
        for k, s in enumerate(needs):
            held[k] += c in s
        if i >= w:
            old = run[i - w]
            total += cost[counts[old] - 1] - cost[counts[old]]
            counts[old] -= 1
            for k, s in enumerate(needs):
                held[k] -= old in s
        if i >= w - 1 and total <= bound and min(held) >= kind.least:
            start = i - w + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def left_of(text: bytes, a: int, b: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the merged spans ``base`` leave of a range. Separators alone, and the words
    before an assignment ("my_" of "my_token="), are nothing."""
    for x, kind, y in [*base[bisect_right(base, a, key=lambda span: span[2]) : bisect_left(base, b, key=lambda span: span[0])], (b, -1, b)]:
        piece = text[a:x].strip(SEPARATORS)
        if piece and not (kind == 0 and NAME.fullmatch(piece)):
            yield a, x
        a = max(a, y)


def merge(spans: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap or touch as one, of the kind of the first."""
    merged: list[tuple[int, int, int]] = []
    for a, kind, b in sorted(spans):
        if merged and a <= merged[-1][2]:
            merged[-1] = (*merged[-1][:2], max(b, merged[-1][2]))
        else:
            merged.append((a, kind, b))
    return merged


def unexplained(candidate: bytes, names: bool = True) -> list[tuple[int, int]]:
    """The ranges of a candidate that the allow-list does not explain. Without ``names`` a
    string is not taken for harmless because it has the form of a name."""
    if names and ALLOWED.fullmatch(candidate):
        return []
    start = REPEATED.match(candidate)
    found = [(0, 0, start.end())] if start else []
    words = [m.span() for m in HARMLESS.finditer(candidate)]
    if words:
        found += [(a, 0, b) for a, b in words]
        firsts, ends = [a for a, _ in words], [b for _, b in words]
        for part in PART.finditer(candidate):
            inside = words[bisect_right(ends, part.start()) : bisect_left(firsts, part.end())]
            held = sum(min(b, part.end()) - max(a, part.start()) for a, b in inside)
            if held and part.end() - part.start() - held < FEW:
                found.append((part.start(), 0, part.end()))
    left, at = [], 0
    for a, _, b in [*merge(found), (len(candidate), 0, len(candidate))]:
        if a > at:
            left.append((at, a))
        at = b
    return left


def entropy_ranges(text: bytes) -> Iterator[tuple[int, int]]:
    """The ranges of high entropy of every class, wherever the allow-list does not explain them."""
    for m in CANDIDATE.finditer(text):
        looked = [*product(CLASSES, unexplained(m[0])), *product([LETTERS], unexplained(m[0], names=False))]
        for kind, (first, end) in looked:
            for run in kind.run.finditer(text, m.start() + first, m.start() + end):
                for a, b in random_ranges(run[0], kind):
                    yield run.start() + a, run.start() + b
    for m in JOINED.finditer(text):
        if SIGN.search(m[0]) and not ADDRESS.fullmatch(m[0].strip(_ENDS)):
            for first, end in unexplained(m[0]):
                for a, b in random_ranges(m[0][first:end], SIGNS):
                    found = m[0][first + a : first + b]
                    start = m.start() + first + a + len(found) - len(found.lstrip(_ENDS))
                    yield start, start + len(found.strip(_ENDS))


def scan(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every secret, in bytes, sorted by start, then kind."""
    spans = []
    low = text.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or b"api" in low:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST_VALUE]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = merge(spans)
    more: set[tuple[int, int, int]] = set()
    for a, b in entropy_ranges(text):
        more.update((x, 3, y) for x, y in left_of(text, a, b, base))
    return sorted(spans + merge(more))


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans with positions in code points."""
    at, seen, done = {}, 0, 0
    for place in sorted({x for a, _, b in spans for x in (a, b)}):
        seen += len(text[done:place].decode("utf-8", "replace"))
        done = place
        at[place] = seen
    return [(at[a], kind, at[b]) for a, kind, b in spans]


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``id, spans`` with spans ``kind, start, end`` (code points,
    end exclusive) sorted by start, then kind as in ``KINDS``.

    Kinds ``assign``, ``access`` and ``hex`` are what the fixed patterns match. ``entropy``
    is what these leave of windows of high entropy that the allow-list does not explain. Null
    and empty texts have none, texts of any length are read whole, an empty table gives no rows. Rows
    are independent: repeated rows and rows without id give a result each; other columns are not read."""

    def start():
        def work(columns):
            found = []
            for raw in columns[1]:
                raw = raw or b""
                spans = in_code_points(raw, scan(raw))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            return columns[0], found

        return work

    rows = docs.select(F.col(id_column).alias("id"), as_bytes(text))
    return map_batches(rows, start, "id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans become one mark.
    All rows and columns stay; ``n_chars``, if there is such a column, is counted anew for
    texts that changed. Null texts stay null."""
    schema = docs.schema
    place = schema.fieldNames().index(text)
    count = schema.fieldNames().index(n_chars) if n_chars in schema.fieldNames() else None

    def clean(value: str | None) -> str | None:
        raw = (value or "").encode("utf-8", "surrogatepass")
        spans = scan(raw)
        if not spans:
            return value
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [raw[at:a], mark.encode()]
            at = max(at, b)
        return b"".join([*out, raw[at:]]).decode("utf-8", "replace")

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            old = batch.column(place).to_pylist()
            new = [clean(x) for x in old]
            columns = list(batch.columns)
            columns[place] = pa.array(new, columns[place].type)
            if count is not None:
                sizes = columns[count].to_pylist()
                sizes = [n if a == b else len(b) for n, a, b in zip(sizes, old, new, strict=True)]
                columns[count] = pa.array(sizes, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
