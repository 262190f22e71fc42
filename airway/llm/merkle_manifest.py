"""Merkle manifest of a table: a tree for each group of rows, their subroots under one root.

A level pivots: conditional aggregates spread the children of a parent into one column for
each slot. All columns together are what the parent hashes; all but a child's own are its
siblings. Several levels make a storey, whose subtrees lie in one partition each, so that a
storey takes one shuffle, and its rows carry the paths of the nodes below. Paths are then
put together from the top storey down, by joins of one row with one row.

Digests are SHA-256, kept as 32 bytes and hashed as lower-case hexadecimal text.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airway.sources.staging import Work, session_work

# Nodes that a storey gathers under one row, at most.
STOREY_NODES = 64

STEP = "struct<left: binary, right: binary>"


def leaf_hash(*values: Column) -> Column:
    """The hash of a row: of each value ``-`` if null, else its length in UTF-8 bytes, a
    colon and the value as text."""

    def part(value: Column) -> Column:
        shown = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(v) for v in values]), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_text(path: Column) -> Column:
    """The siblings of all levels, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda s: shown(F.concat(s["left"], s["right"]))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root, as text, that a leaf and its path give."""
    return F.aggregate(
        path, shown(leaf), lambda h, s: F.sha2(F.concat(shown(s["left"]), h, shown(s["right"])), 256)
    )


def _numbered(rows: DataFrame, order: list[str], work: Work) -> DataFrame:
    """``rows`` with ``pos`` in their ``group`` by ``order`` and ``n``, the rows of the group.
    Ranges of rows are sorted apart; only their counts are added up along a group."""
    sort = ["group", *order]
    spread = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    spread = work.stage(spread.withColumn("at", F.monotonically_increasing_id()), "ordered")
    spread = spread.withColumn("part", F.shiftright("at", 33))
    runs = spread.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    group = Window.partitionBy("group")
    before = F.sum("many").over(group.orderBy("part")) - F.col("many")
    runs = runs.select("group", "part", (before - F.col("first")).alias("shift"), F.sum("many").over(group).alias("n"))
    found = spread.join(runs, ["group", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
    return found.drop("part", "at", "shift")


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """One level up: ``group, top, pos, n, digest, below``. A group of one node stays as it is."""
    slot, held = F.col("pos") % fanout, F.struct("digest", "below")
    spread = [F.first(F.when(slot == s, held), ignorenulls=True).alias(f"slot{s}") for s in range(fanout)]
    pivot = nodes.groupBy("group", "top", F.floor(F.col("pos") / fanout).alias("pos")).agg(F.first("n").alias("width"), *spread)
    slots = [F.col(f"slot{s}") for s in range(fanout)]
    many, none = F.col("width") > 1, F.lit(b"")

    def joined(some: list[Column]) -> Column:
        return F.concat(none, *[F.coalesce(c["digest"], none) for c in some])

    def lifted(s: int) -> Column:
        step = F.struct(joined(slots[:s]).alias("left"), joined(slots[s + 1 :]).alias("right"))
        path = lambda x: F.when(many, F.array_append(x["path"], step)).otherwise(x["path"])
        return F.transform(slots[s]["below"], lambda x: F.struct(x["item"].alias("item"), path(x).alias("path")))

    return pivot.select(
        "group",
        "top",
        "pos",
        F.ceil(F.col("width") / fanout).alias("n"),
        F.when(many, F.unhex(F.sha2(shown(joined(slots)), 256))).otherwise(slots[0]["digest"]).alias("digest"),
        F.flatten(F.array_compact(F.array(*[lifted(s) for s in range(fanout)]))).alias("below"),
    )


def grow(leaves: DataFrame, order: list[str], fanout: int, work: Work) -> list[DataFrame]:
    """The storeys of the trees of all groups, lowest first, each staged as ``group, pos, n,
    digest, below``: a node with ``item, path`` of the nodes that the storey began with.
    ``leaves``: ``group, digest, item`` and the columns of ``order``. In the first storey
    items are those of the leaves, above it positions in the storey below."""
    levels = max(1, next(k for k in range(1, 99) if fanout ** (k + 1) > STOREY_NODES))
    nodes = work.stage(_numbered(leaves, order, work).select("group", "pos", "n", "digest", "item"), "nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    storeys: list[DataFrame] = []
    while not storeys or most > 1:
        alone = F.array(F.struct(F.col("item"), F.array().cast(f"array<{STEP}>").alias("path")))
        rows = nodes.select("group", F.floor(F.col("pos") / fanout**levels).alias("top"), "pos", "n", "digest", alone.alias("below"))
        rows = reduce(lambda df, _: _level(df, fanout), range(levels), rows.repartition("group", "top"))
        storeys.append(work.stage(rows.drop("top"), "storey"))
        nodes = storeys[-1].select("group", "pos", "n", "digest", F.col("pos").alias("item"))
        most = -(-most // fanout**levels)
    return storeys


def descend(storeys: list[DataFrame], above: DataFrame) -> DataFrame:
    """``group, item, path`` and the further columns of ``above`` for every leaf. ``above``:
    ``group, pos, path`` of the top storey's nodes, the path being what follows there."""
    more = [c for c in above.columns if c not in ("group", "pos", "path")]
    for storey in reversed(storeys):
        met = storey.select("group", "pos", "below").join(above, ["group", "pos"])
        found = met.select("group", F.col("path").alias("rest"), *more, F.inline("below"))
        above = found.select("group", F.col("item").alias("pos"), F.concat("path", "rest").alias("path"), *more)
    return above.withColumnRenamed("pos", "item")


def merkle_manifest(
    docs: DataFrame,
    columns: list[str],
    id_column: str = "doc_id",
    group: str = "lang",
    fanout: int = 2,
    carry: Mapping[str, Column] | None = None,
    work: Work | None = None,
) -> DataFrame:
    """One row per input row: ``id, leaf, path, subroot, root`` and the ``carry`` columns; runs jobs.

    The leaf hashes ``columns`` in their order. In a group, null being one, leaves ascend by id
    (null first; rows of one id by leaf, so repeated rows are leaves side by side); runs of
    ``fanout`` nodes, the last one perhaps shorter, become their hash until one node, the
    subroot, remains. Subroots by group (null first, bytewise) become the root likewise.
    ``path`` has ``left, right`` for each level: the digests of the siblings before and after
    the node. ``carry`` names further values of a row, such as the leaf of an altered one.
    Texts of any length are hashed whole; an empty table gives no rows. A hot group is many
    subtrees, and no group, level or path is gathered beyond ``STOREY_NODES`` nodes."""
    work = work or session_work(docs.sparkSession)
    carry = dict(carry or {})
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaf = leaf_hash(*[F.col(c) for c in columns])
    item = F.struct(F.col(id_column).alias("id"), *[value.alias(name) for name, value in carry.items()])
    leaves = docs.select(key.alias("group"), F.col(id_column).alias("key"), leaf.alias("digest"), item.alias("item"))
    leaves = leaves.withColumn("item", F.struct("item.*", F.col("digest").alias("leaf")))
    leaves = work.stage(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")

    trees = grow(leaves, ["key", "digest", "row"], fanout, work)
    tops = trees[-1].select("group", "digest")
    crown = grow(tops.select(F.lit("").alias("group"), "digest", F.col("group").alias("item")), ["item"], fanout, work)
    nothing = F.array().cast(f"array<{STEP}>").alias("path")
    root = crown[-1].select("group", "pos", nothing, F.col("digest").alias("root"))
    shared = descend(crown, root).select(F.col("item").alias("group"), "path", "root")
    above = trees[-1].select("group", "pos", F.col("digest").alias("subroot")).join(shared, "group")
    return descend(trees, above).select("item.id", "item.leaf", "path", "subroot", "root", *[f"item.{c}" for c in carry])
