"""Quality of documents by a factorisation machine.

Inputs are the hashed words of a text, statistics of its structure, and its lengths as
metadata. Each input has a weight and a short vector; the score adds the inputs' weights
and the products of all pairs of vectors, which the identity
``sum of pairs = (square of sum - sum of squares) / 2`` gives in linear time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, map_batches, slices, space_words
from airway.llm.quality_rules import class_counts
from airway.sources.staging import Work, session_work

BUCKETS = 1 << 15
RANK = 8
# Labelled documents that the model is fitted on at most, the first by a hash of their id.
SAMPLE = 6000
EPOCHS, LEAST_STEPS, BATCH = 6, 300, 64
RATE, DECAY = 0.05, 1e-5

STATISTICS = (
    "words", "word_length", "distinct", "top_word", "dup_lines", "line_words", "bytes", "code_points_a_byte",
    "lower", "upper", "digit", "space", "line", "stop", "quote", "symbol", "other", "beyond", "ended_words", "ended_lines",
)
_ENDS = frozenset(b".,;:!?")


def statistics(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The values of ``STATISTICS``; an empty text has zeros."""
    if not words:
        return [0.0] * len(STATISTICS)
    n, classes = len(words), class_counts(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    points = int(classes.sum())
    return [
        float(np.log1p(n)),
        points / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        float(np.log1p(len(text))),
        points / len(text),
        *(classes / points).tolist(),
        sum(w[-1] in _ENDS for w in words) / n,
        sum(line.rstrip()[-1] in _ENDS for line in lines) / len(lines),
    ]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets and values of the words (log counts, of length 1 together), statistics."""
    words = space_words(text.lower())
    counts = Counter(words)
    hashed = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % BUCKETS
    values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    buckets, place = np.unique(hashed, return_inverse=True)
    values = np.bincount(place, values, minlength=len(buckets))
    norm = np.sqrt((values**2).sum())
    return buckets, values / norm if norm else values, statistics(text, words, counts)


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def row(self, buckets, values, stats) -> tuple[np.ndarray, np.ndarray]:
        """All inputs of a document: words first, then standardised statistics."""
        scaled = np.clip((np.asarray(stats) - self.mean) / self.spread, -4, 4) / len(STATISTICS) ** 0.5
        return np.append(buckets, BUCKETS + np.arange(len(STATISTICS))), np.append(values, scaled)

    def margins(self, places: np.ndarray, values: np.ndarray, starts: np.ndarray):
        """Scores of documents whose inputs begin at ``starts``, and the vector sums."""
        moved = self.vectors[places] * values[:, None]
        sums = np.add.reduceat(moved, starts)
        pairs = (sums**2 - np.add.reduceat(moved**2, starts)).sum(1) / 2
        return self.bias + np.add.reduceat(self.weights[places] * values, starts) + pairs, sums, moved

    def score(self, text: bytes) -> float:
        places, values = self.row(*features(text))
        margin = self.margins(places, values, np.zeros(1, int))[0][0]
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple], labels: np.ndarray, rank: int = RANK, seed: int = 7) -> FactorisationMachine | float:
    """The machine fitted to feature rows by stochastic gradients (AdaGrad) of the
    logistic loss; with labels of one class, or none, the score that stands for all."""
    n, ones = len(labels), int(labels.sum())
    if ones in (0, n):
        return (ones + 0.5) / (n + 1)
    stats = np.array([r[2] for r in rows])
    rng = np.random.default_rng(seed)
    inputs = BUCKETS + len(STATISTICS)
    prior = float(np.log(ones / (n - ones)))
    model = FactorisationMachine(
        prior, np.zeros(inputs), rng.normal(0, 0.05, (inputs, rank)), stats.mean(0), np.maximum(stats.std(0), 1e-6)
    )
    made = [model.row(*r) for r in rows]
    square_w, square_v, square_b = np.full(inputs, 1e-4), np.full((inputs, rank), 1e-4), 1e-4
    steps = -(-n // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // steps))):
        order = rng.permutation(n)
        for first in range(0, n, BATCH):
            chosen = order[first : first + BATCH]
            sizes = np.array([len(made[i][0]) for i in chosen])
            places = np.concatenate([made[i][0] for i in chosen])
            values = np.concatenate([made[i][1] for i in chosen])
            starts = np.append(0, np.cumsum(sizes)[:-1])
            margin, sums, moved = model.margins(places, values, starts)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            by_input = np.repeat(error, sizes) * values
            used, back = np.unique(places, return_inverse=True)
            step_w = np.bincount(back, by_input) + DECAY * model.weights[used]
            pull = by_input[:, None] * (np.repeat(sums, sizes, axis=0) - moved)
            step_v = np.stack([np.bincount(back, pull[:, f]) for f in range(rank)], axis=1) + DECAY * model.vectors[used]
            square_w[used] += step_w**2
            square_v[used] += step_v**2
            square_b += error.sum() ** 2
            model.weights[used] -= RATE * 4 * step_w / np.sqrt(square_w[used])
            model.vectors[used] -= RATE * step_v / np.sqrt(square_v[used])
            model.bias -= RATE * error.sum() / square_b**0.5
    return model


def held_out(id_column: str) -> Column:
    """Documents that labels are not learned from: crc32 of the id as text leaves 1 by 3.
    A null id is not among them; it has no label either."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, sample: int, work: Work
) -> FactorisationMachine | float:
    """Fit on at most ``sample`` labelled rows that are not held out, one for each id: of
    rows that repeat an id the text of least hash. Ids labelled both ways teach nothing;
    labels other than 0 and 1 and null ones are passed over."""
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(label).alias("_low"), F.max(label).alias("_label"))
        .where("_low = _label")
    )
    chosen = work.stage(agreed.select("_id", "_label").orderBy(F.xxhash64("_id"), "_id").limit(sample), "chosen")

    def start():
        def run(columns):
            made = [features(t or b"") for t in columns[2]]
            return columns[0], columns[1], [m[0] for m in made], [m[1] for m in made], [m[2] for m in made]

        return run

    texts = docs.select(F.col(id_column).alias("_id"), as_bytes(text, "_text"))
    one = F.min(F.struct(F.xxhash64("_text").alias("_print"), "_text")).alias("_one")
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(one).select("_id", "_label", "_one._text")
    schema = "id long, label int, buckets array<long>, values array<double>, stats array<double>"
    table = map_batches(found, start, schema).toArrow().sort_by([("id", "ascending")])
    columns = [table.column(c).combine_chunks() for c in ("buckets", "values", "stats")]
    rows = [tuple(np.array(c[i].values) for c in columns) for i in range(table.num_rows)]
    return fit(rows, np.array(table.column("label").to_pylist(), float))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    work: Work | None = None,
) -> DataFrame:
    """One row per input row: ``id, print, held_out, score, predicted``; fits first.

    ``score`` (0 to 1) says how likely label 1 is, ``predicted`` is 1 from 0.5 on. Only
    the text is looked at, so null and empty texts have one score, repeated rows the
    same, and rows without id theirs. ``print`` is ``xxhash64`` of the text. With labels
    of one class, or none, all rows have the score of the prior (0.5 without labels).
    The fit reads at most ``sample`` labelled rows; the model is about 2 MB."""
    work = work or session_work(docs.sparkSession)
    model = train(docs, labels, id_column, text, label, sample, work)

    def start():
        def run(columns):
            ids, prints, held, texts = columns
            scores = [model if isinstance(model, float) else model.score(t or b"") for t in texts]
            return ids, prints, held, scores, [int(s >= 0.5) for s in scores]

        return run

    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), held_out(id_column), as_bytes(text))
    return map_batches(rows, start, "id long, print long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows predicted 0; all columns stay. Rows are judged by their
    text alone, so this reads each text once more and needs no join. Without labels, or with
    labels of 1 only, no row is rejected; labels of 0 only would reject all, and are an error."""
    work = options.pop("work", None) or session_work(docs.sparkSession)
    model = train(docs, labels, id_column, text, options.get("label", "quality"), options.get("sample", SAMPLE), work)
    if isinstance(model, float):
        if model < 0.5:
            raise ValueError("the labels that may be learned from are all 0: nothing tells good documents")
        return docs
    place = docs.schema.fieldNames().index(text)

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            texts = batch.column(place).to_pylist()
            kept = batch.filter(pa.array([model.score((t or "").encode("utf-8", "surrogatepass")) >= 0.5 for t in texts], pa.bool_()))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(run, docs.schema)
