"""Linking of similar sets through inverted lists, without forming all pairs of a list.

A list holds the nodes that share one retained value (or one band). Pairs are tried in
two passes. First every member meets a few leaders of its list; exact similarity links
them, and linked nodes become components. Then only lists that still hold more than one
component are opened, and only members of different components meet. So a list of
thousands of copies costs its length, and no pair that could join two components is
left out. Members and leaders are rows of joins; nothing is gathered per list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.sources.staging import Work

# A set of row keys up to this many rows (about 50 MB) is broadcast, beyond that joined by a shuffle.
BROADCAST_ROWS = 500_000


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str] | Column, how: str = "left_semi") -> DataFrame:
    """Join ``rows`` to a staged table of keys without shuffling ``rows`` while the keys'
    counted number allows it."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, how)


def similar(inter: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """``100 * intersection >= percent * union``, in whole numbers."""
    return F.lit(100) * inter >= F.lit(percent) * (size_a + size_b - inter)


def sizes_allow(size_a: Column, size_b: Column, percent: int) -> Column:
    """Sets whose sizes differ more than this cannot reach the similarity."""
    return F.lit(100) * F.least(size_a, size_b) >= F.lit(percent) * F.greatest(size_a, size_b)


def estimate_allows(a: str, b: str, percent: int, k: int, slack: float) -> Column:
    """Whether the sketches of sides ``a`` and ``b`` leave room for the similarity.

    The share of the k smallest values of both sketches' union that both sketches hold
    estimates the Jaccard similarity; it may fall ``slack`` standard errors short. Where
    both sketches are whole sets the share over the whole union is exact."""
    x, y = F.col(f"sketch_{a}"), F.col(f"sketch_{b}")
    whole = F.greatest(f"size_{a}", f"size_{b}") <= k
    both = F.slice(F.sort_array(F.array_union(x, y)), F.lit(1), F.when(whole, 2 * k).otherwise(k))
    share = F.size(F.array_intersect(both, F.array_intersect(x, y))) / F.size(both)
    p = percent / 100
    return share >= F.when(whole, p - 1e-9).otherwise(p - slack * (p * (1 - p) / k) ** 0.5)


def components(edges: DataFrame, work: Work) -> DataFrame:
    """``node, root`` of every node that has an edge (columns a, b); the root is the least
    node of the component. Large and small stars in turn, each a grouping and a join, so
    the number of rounds grows with the logarithm of a chain's length; edges are staged
    after each round."""

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        # Large: every greater neighbour of u points to the least of u's neighbourhood.
        # Small: u and its lesser neighbours point to the least of them.
        if large:
            sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            moved = sides.where("b > a").join(least, "a").select(F.col("b").alias("x"), "m")
        else:
            least = pairs.groupBy("b").agg(F.min("a").alias("m"))
            moved = pairs.join(least, "b").select(F.col("a").alias("x"), "m").unionByName(least.select(F.col("b").alias("x"), "m"))
        return moved.where("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()

    def mark(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    pairs = work.stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    before = mark(pairs)
    while before[0]:
        pairs = work.stage(stars(stars(pairs, True), False), "stars")
        after = mark(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return work.stage(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")


def link(postings: DataFrame, sets: DataFrame, percent: int, k: int, slack: float, work: Work) -> DataFrame:
    """Components of nodes whose sets reach ``percent`` similarity and share a list.

    ``postings``: staged ``bucket, node, size, own`` (``own``: how many values only this
    node has; the nodes with the fewest lie in the middle of their group and lead it).
    ``sets``: staged ``node, size, sketch, items``. Pairs whose sketches of ``k`` values
    rule the similarity out are dropped before the full sets are fetched. Returns ``node, root``.
    """

    def side(name: str, column: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col(column).alias(f"{column}_{name}"))

    def verified(pairs: DataFrame) -> DataFrame:
        full = pairs.join(side("b", "items"), "b").join(side("a", "items"), "a")
        inter = F.size(F.array_intersect("items_a", "items_b"))
        links = full.where(similar(inter, F.col("size_a"), F.col("size_b"), percent)).select("a", "b")
        return work.stage(links, "links")

    def pair(x: Column, y: Column) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    close = estimate_allows("a", "b", percent, k, slack)
    member = F.struct("node", "size")
    leaders = postings.groupBy("bucket").agg(
        F.min(F.struct("own", "node", "size")).alias("center"), F.min(member).alias("low"), F.max(member).alias("high")
    )
    ends = F.array_distinct(F.array(F.struct(F.col("center.node"), F.col("center.size")), F.col("low"), F.col("high")))
    led = postings.join(leaders.where("low.node <> high.node").select("bucket", ends.alias("ends")), "bucket")
    fitting = F.filter("ends", lambda e: (e["node"] != F.col("node")) & sizes_allow(e["size"], F.col("size"), percent))
    tries = led.select("node", F.explode(fitting).alias("leader")).select(*pair(F.col("node"), F.col("leader.node"))).distinct()
    near = tries.join(side("b", "sketch"), "b").join(side("a", "sketch"), "a").where(close).select("a", "b")
    first = verified(work.stage(near, "near"))
    roots = components(first, work)

    # Lists that still mix components. A pair meets in the first list it shares only.
    placed = work.stage(postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    open_rows = work.stage(placed.join(mixed, "bucket", "left_semi").select("bucket", "node", "root"), "open")
    lists = open_rows.groupBy("node").agg(F.collect_set("bucket").alias("lists"))
    known = sets.select("node", "size", "sketch").join(lists, "node")
    left = open_rows.join(known, "node").select([F.col(c).alias(f"{c}_a") for c in ("bucket", "node", "root", "size", "lists", "sketch")])
    right = left.select([F.col(c).alias(f"{c[:-1]}b") for c in left.columns])
    meet = (F.col("bucket_a") == F.col("bucket_b")) & (F.col("root_a") < F.col("root_b"))
    meet = meet & sizes_allow(F.col("size_a"), F.col("size_b"), percent)
    meet = meet & (F.array_min(F.array_intersect("lists_a", "lists_b")) == F.col("bucket_a")) & close
    rest = left.join(right, meet).select(*pair(F.col("node_a"), F.col("node_b")))
    second = verified(work.stage(rest, "near"))
    if second.isEmpty():
        return roots
    return components(first.unionByName(second), work)
