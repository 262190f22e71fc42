"""Exact duplicates by merging sorted runs of digests along a tree.

Every task turns its rows into sorted runs with one entry for each distinct text. The
partitions then exchange runs in rounds: in round r those whose numbers differ in digit r
only deal each other their entries by digit r of the digest's home partition, the radix
being the number of runs that meet. What arrives is merged by Spark's external sort, and
neighbours of one digest become one entry where SHA-256 and length agree as well; the
entry retains the least rank. After the last round each entry is at home. Copies shrink at
every level, so a group of any size costs one entry for each run that holds it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from airway.sources.staging import Work, session_work

# Rows that a task turns into one run, entries that a partition should hold, and runs that meet at most.
RUN_ROWS, PARTITION_ENTRIES, RADIX = 65_536, 500_000, 16

_RUN = "home int, digest long, sha binary, bytes long, best struct<no_id: boolean, rank: long, at: long>, ids array<struct<id: long, at: long>>"


def sorted_runs(docs: DataFrame, id_column: str, text: Column, largest: bool, digest: Callable, run_rows: int) -> DataFrame:
    """``home, digest, sha, bytes, best, ids``: the runs that the tasks hold, an entry for
    each distinct text of a run with the ids and row numbers of its rows. The rank of an id
    is the id, or its complement where the largest is to stay; no id ranks last."""
    shape = StructType.fromDDL(_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(shape)
        held: dict[tuple, list] = {}
        rows = 0

        def out() -> Iterator[pa.RecordBatch]:
            entries = [
                {
                    "home": ids[0][1] >> 33,
                    "digest": key[0],
                    "sha": key[1],
                    "bytes": key[2],
                    "best": dict(zip(("no_id", "rank", "at"), min(rank(i, at) for i, at in ids), strict=True)),
                    "ids": [{"id": i, "at": at} for i, at in ids],
                }
                for key, ids in sorted(held.items())
            ]
            yield from pa.Table.from_pylist(entries, kinds).to_batches()

        def rank(i: int | None, at: int) -> tuple:
            return (True, 0, at) if i is None else (False, ~i if largest else i, at)

        for batch in batches:
            for i, at, short, sha, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault((short, sha, size), []).append((i, at))
                rows += 1
                if rows == run_rows:
                    yield from out()
                    held, rows = {}, 0
        if held:
            yield from out()

    whole = F.coalesce(text, F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("at"),
        digest(whole).alias("digest"),
        F.unhex(F.sha2(whole, 256)).alias("sha"),
        F.octet_length(whole).cast("long").alias("bytes"),
    )
    return rows.mapInArrow(run, shape)


def merged_runs(entries: DataFrame, radix: int, rounds: int) -> DataFrame:
    """``digest, sha, bytes, best, n`` of every distinct text after ``rounds`` exchanges of
    ``radix`` runs each. Partitions are numbered in base ``radix``."""
    partitions = radix**rounds
    held = entries.withColumn("home", F.pmod("home", F.lit(partitions)))
    key = ["home", "digest", "sha", "bytes"]
    for r in range(rounds):
        step = radix**r

        def digit(number: Column, step: int = step) -> Column:
            return F.floor(number / step) % radix

        moved = F.col("home") + (digit(F.pmod("digest", F.lit(partitions))) - digit(F.col("home"))) * step
        held = held.withColumn("home", moved.cast("int")).repartitionById(partitions, "home")
        held = held.groupBy(*key).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return held.drop("home")


def shape_of_tree(entries: int, at_once: int, cores: int) -> tuple[int, int]:
    """Radix and rounds, two at least, for so many entries."""
    need = max(math.ceil(entries / at_once), cores, 2)
    rounds = max(2, math.ceil(round(math.log(need, RADIX), 9)))
    return max(2, math.ceil(round(need ** (1 / rounds), 9))), rounds


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    normal: Callable[[Column], Column] = lambda c: c,
    digest: Callable[[Column], Column] = F.xxhash64,
    run_rows: int = RUN_ROWS,
    at_once: int = PARTITION_ENTRIES,
    work: Work | None = None,
) -> DataFrame:
    """One row per input row: ``id, keep_id, n, kept, sha``; runs jobs.

    Texts are equal when they are identical after ``normal``; a null text counts as empty, and
    empty texts are equal. ``keep`` names the id that stays, ``smallest`` or ``largest``.
    Exactly one row of a group is kept: of repeated rows of that id, the one read first.
    Rows without id stay only where all rows of a group have none; ``keep_id`` is null then.
    ``digest`` orders and deals the runs; two texts become one entry only if SHA-256 and length
    agree too, so its collisions cost nothing but balance. Texts of any length travel as
    56 bytes. Ids are integers. Other columns are not read; an empty table gives no rows."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    spark, work = docs.sparkSession, work or session_work(docs.sparkSession)
    largest = keep == "largest"
    runs = work.stage(sorted_runs(docs, id_column, normal(F.col(text)), largest, digest, run_rows), "runs")
    radix, rounds = shape_of_tree(runs.count(), at_once, spark.sparkContext.defaultParallelism)
    entries = runs.select("home", "digest", "sha", "bytes", "best", F.size("ids").cast("long").alias("n"))
    texts = merged_runs(entries, radix, rounds)
    found = runs.select("digest", "sha", "bytes", "ids").join(texts, ["digest", "sha", "bytes"])
    rank = F.when(~F.col("best.no_id"), F.col("best.rank"))
    rows = found.select("sha", "best", "n", F.inline("ids"))
    return rows.select(
        "id",
        (F.bitwise_not(rank) if largest else rank).alias("keep_id"),
        "n",
        (F.col("at") == F.col("best.at")).alias("kept"),
        F.lower(F.hex("sha")).alias("sha"),
    )
