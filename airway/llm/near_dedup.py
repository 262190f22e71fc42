"""Near-duplicate documents from bottom-k sketches of word shingles.

Every text becomes the set of its hashed shingles; its k smallest hashes are its sketch.
Texts of one set are one node. Nodes that share too few of their retained values with
any other are done. For the others, larger sketches make inverted lists, which give
candidates; the union of two sketches estimates their similarity; full sets decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import as_bytes, fresh, map_batches, space_words
from airway.llm.linking import link, semi_join
from airway.sources.staging import Work, session_work

WIDTH = 5
PERCENT = 85
# Values retained of every text, and of texts that have possible partners: those their
# similarity is estimated from, and those that lists are made of.
SKETCH = 48
ESTIMATE = 192
LISTED = 256
# Standard errors by which a sketch may fall short of the similarity it is drawn from.
SLACK = 5.0


def shingle_set(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. Fewer words than ``width`` are one
    shingle, no words none."""
    if not words:
        return np.empty(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    mixed = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(width, len(words))):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[i : i + n]
    mixed ^= mixed >> np.uint64(30)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(27)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed.view(np.int64))


def list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def sketches(docs: DataFrame, id_column: str, text: str, k: int, width: int) -> DataFrame:
    """``id, print, size, node, sketch`` of each row; ``print`` hashes the raw text."""

    def start():
        def work(columns):
            ids, prints, texts = columns
            sets = [shingle_set(space_words((t or b"").lower()), width) for t in texts]
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return ids, prints, [len(s) for s in sets], nodes, list_array([s[:k] for s in sets])

        return work

    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), as_bytes(text))
    return map_batches(rows, start, "id long, print long, size long, node binary, sketch array<long>")


def full_sets(docs: DataFrame, id_column: str, text: str, width: int, members: DataFrame, k: int) -> DataFrame:
    """``node, size, sketch, items`` of the member nodes, from the text of one row each."""

    def start():
        def work(columns):
            sets = [shingle_set(space_words((t or b"").lower()), width) for t in columns[1]]
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            same = [i for i, node in enumerate(nodes) if node == columns[0][i]]
            kept = [sets[i] for i in same]
            return [nodes[i] for i in same], [len(s) for s in kept], list_array([s[:k] for s in kept]), list_array(kept)

        return work

    rows = docs.select(F.col(id_column).alias("rep"), as_bytes(text))
    rows = semi_join(rows, members, ["rep"], "inner").select("node", text)
    found = map_batches(rows, start, "node binary, size long, sketch array<long>, items array<long>")
    return found.dropDuplicates(["node"])


def _need(size: Column, k: int, percent: int) -> Column:
    """Retained values that two similar sets share at least, given the size of either.
    Exact where both sketches are whole sets; above that ``SLACK`` standard errors below
    the mean."""
    p = percent / 100
    held = F.least(size, F.lit(k))
    loose = F.floor(held * p - SLACK * F.sqrt(held * p * (1 - p)))
    return F.greatest(F.when(size <= int(k * p), F.ceil(size * percent / 100)).otherwise(loose), F.lit(1))


def with_partners(nodes: DataFrame, values: str, held: Column, need: Column) -> DataFrame:
    """Nodes of whose ``held`` values at least ``need`` occur in other nodes too; ``own``
    counts the others. A value of one node names it by its least node, so counting them
    takes no join."""
    listed = nodes.select("node", F.explode(values).alias("bucket"))
    single = listed.groupBy("bucket").agg(F.count("*").alias("df"), F.min("node").alias("node")).where("df = 1")
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    found = nodes.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    return found.where(held - F.col("own") >= need)


def postings_of(sets: DataFrame, k: int, percent: int) -> DataFrame:
    """``bucket, node, size, own``: each node under its rarest retained values.

    Two similar sets share at least ``need`` of them, so among the rarest
    ``held - need + 1`` of either there is a shared one. Values of a single node count
    towards these but need no list."""
    values = sets.select("node", "size", F.explode(F.slice("items", 1, k)).alias("bucket"))
    shared = values.groupBy("bucket").agg(F.count("*").alias("df")).where("df > 1")
    held = F.least("size", F.lit(k))
    ranked = (
        values.join(shared, "bucket")
        .groupBy("node", "size")
        .agg(F.sort_array(F.collect_list(F.struct("df", "bucket"))).alias("lists"))
        .withColumn("own", held - F.size("lists"))
        .withColumn("first", F.greatest(held - _need(F.col("size"), k, percent) + 1 - F.col("own"), F.lit(0)).cast("int"))
    )
    rarest = ranked.where("first > 0").select("node", "size", "own", F.explode(F.slice("lists", 1, F.col("first"))).alias("l"))
    return rarest.select(F.col("l.bucket").alias("bucket"), "node", "size", "own")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    k: int = SKETCH,
    width: int = WIDTH,
    work: Work | None = None,
) -> DataFrame:
    """One row per input row: ``id, print, size, root``; runs jobs.

    ``root`` is the smallest id reachable over links of ``percent`` Jaccard similarity
    of distinct ``width``-word shingles (words between ASCII white space, A-Z lowered).
    Texts that are null or hold no word are linked with nothing. A row without id is
    linked with nothing and has no root. Rows are linked by their texts, not ids: two
    rows of one id and different texts may have different roots, and repeated rows have
    the same. ``print`` is ``xxhash64`` of the raw text and with the id names a row.
    Other columns are not read. No cap holds for groups, lists or texts."""
    work = work or session_work(docs.sparkSession)
    rows = work.stage(sketches(docs, id_column, text, k, width), "sketches")
    nodes = work.stage(
        rows.where("size > 0 AND id IS NOT NULL")
        .groupBy("node")
        .agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    held = F.least("size", F.lit(k))
    paired = with_partners(nodes, "sketch", held, _need(F.col("size"), k, percent))
    members = work.stage(paired.select("node", "rep"), "members")
    sets = work.stage(full_sets(docs, id_column, text, width, members, ESTIMATE), "sets")
    postings = work.stage(postings_of(sets, LISTED, percent), "postings")
    roots = link(postings, sets, percent, ESTIMATE, SLACK, work)
    reps = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = reps.groupBy("root").agg(F.min("rep").alias("low"))
    least = reps.join(lowest, "root").select("node", F.col("low").alias("root"))
    linked = (F.col("size") > 0) & F.col("id").isNotNull()
    by_node = rows.drop("sketch").join(least, "node", "left")
    return by_node.select("id", "print", "size", F.when(linked, F.col("root")).otherwise(F.col("id")).alias("root"))


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose root is another document; runs jobs. All columns
    stay as they are. Rows without id and rows without words stay; repeated rows of a
    kept id and text are that document and stay."""
    work = options.pop("work", None) or session_work(docs.sparkSession)
    found = near_duplicates(docs, id_column, text, work=work, **options)
    key, mark = fresh(docs, "_id", "_print")
    gone = work.stage(found.where("id <> root").select(F.col("id").alias(key), F.col("print").alias(mark)).distinct(), "gone")
    here = (F.col(id_column) == F.col(key)) & (F.xxhash64(text) == F.col(mark))
    return semi_join(docs, gone, here, "left_anti")
