"""Where the keys of a partitioned dataset are stored: an index beside it.

The index has one row for each key with its partition, in buckets by the hash of the key, so
that looking up a batch reads the buckets that its keys fall into, and an upsert rewrites
these alone. It comes and goes with the data in one swap. A state row holds a sum over the
names of the data files that it describes; files that others wrote or removed change the
sum, and the index is then made from the key columns of the dataset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airway.operators.joining import lookup_join
from airway.sources.scans import read_partitioned, stored_or_none
from airway.sources.staging import Work
from airway.sources.swaps import Swap, listed_files, with_files

INDEX, STATE = "_keys", "_keys_state"
BUCKET = "_bucket"


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], partitions: tuple[str, ...], buckets: int):
        self.spark, self.root, self.keys, self.partitions, self.buckets = spark, root.rstrip("/"), keys, partitions, buckets

    def _entries(self, rows: DataFrame) -> DataFrame:
        """Keys and partition (under other names, as a column may be both) and the bucket."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        names = [F.col(k).alias(f"key_{k}") for k in self.keys] + [F.col(p).alias(f"part_{p}") for p in self.partitions]
        return rows.select(*names, bucket.alias(BUCKET))

    def _with_keys_of(self, entries: DataFrame, new: DataFrame, how: str) -> DataFrame:
        """Entries whose key ``new`` has (``left_semi``) or lacks (``left_anti``)."""
        named = new.select([F.col(k).alias(f"_new_{k}") for k in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(f"key_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in self.keys])
        return entries.join(named, same, how)

    def _met(self, new: DataFrame, known: DataFrame) -> DataFrame:
        """Entries of the buckets of new keys; other buckets are not read."""
        return lookup_join(known, self._entries(new).select(BUCKET).distinct(), BUCKET, "left_semi")

    def _mark(self, files: DataFrame) -> int:
        """A sum over the places of files below the dataset that does not depend on their order."""
        depth = len(self.partitions) + 1
        below = F.array_join(F.slice(F.split("_file", "/"), -depth, depth), "/")
        return files.agg(F.coalesce(F.bit_xor(F.xxhash64(below)), F.lit(0).cast("long")).alias("mark")).first()["mark"]

    def _stored(self, name: str) -> DataFrame | None:
        found = stored_or_none(self.spark, f"{self.root}/{name}")
        return None if found is None else with_files(found)

    def current(self, stored: DataFrame, owner: Work) -> DataFrame:
        """The entries with their ``_file``, which is null where they had to be made anew."""
        state = self._stored(STATE)
        row = state.first() if state is not None else None
        listed = listed_files(self.spark, self.root, self.partitions)
        if row and (row["mark"], row["buckets"]) == (self._mark(listed), self.buckets):
            return self._stored(INDEX)
        return owner.stage(self._entries(stored).withColumn("_file", F.lit(None).cast("string")), "index")

    def places_of(self, new: DataFrame, known: DataFrame) -> DataFrame:
        """The partitions where keys of ``new`` are stored."""
        found = self._with_keys_of(self._met(new, known), new, "left_semi")
        return found.select([F.col(f"part_{p}").alias(p) for p in self.partitions]).distinct()

    def write(self, swap: Swap, new: DataFrame, known: DataFrame | None, gone: DataFrame) -> DataFrame:
        """Stage the index as it is after a swap whose data are staged and remove the files
        of ``gone``; returns those and the ``_file`` of the index that go."""
        mark = self._mark(swap.added())
        entries = self._with_keys_of(self._entries(read_partitioned(self.spark, swap.data)), new, "left_semi")
        leaving = [gone, self._stored(STATE)]
        if known is not None:
            mark ^= self._mark(listed_files(self.spark, self.root, self.partitions)) ^ self._mark(gone)
            anew = not known.where("_file IS NULL").isEmpty()
            touched = known if anew else self._met(new, known)
            leaving.append(self._stored(INDEX) if anew else touched)
            entries = self._with_keys_of(touched.drop("_file"), new, "left_anti").unionByName(entries)
        entries.repartition(BUCKET).write.partitionBy(BUCKET).parquet(swap.hidden(INDEX))
        state = self.spark.createDataFrame([(mark, self.buckets)], "mark long, buckets int")
        state.coalesce(1).write.parquet(swap.hidden(STATE))
        return reduce(DataFrame.unionByName, [f.select("_file").distinct() for f in leaving if f is not None])
