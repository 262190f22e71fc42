"""Swaps by journal, merging of small files, keys that move, repeated inserts."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from airway.sources import scans, sinks, staging, swaps
from tests.helpers import rows

HOURS = ("publish_date", "hour")


def hourly(spark, n=600, value=0):
    hour = F.lpad((F.col("id") % 4).cast("string"), 2, "0")
    return spark.range(n).select("id", F.lit(value).alias("v"), F.lit("2024-01-01").alias("publish_date"), hour.alias("hour"))


def stored(spark, path):
    return scans.read_partitioned(spark, path)


def file_names(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


@pytest.fixture
def path(spark):
    return staging.staging_path(spark, "swapped")


@pytest.fixture
def dies(monkeypatch):
    """Let the replay of a journal stop after some file operations, as a lost driver would."""

    def at(step):
        real, calls = swaps._path, []

        def counted(spark, name):
            if "/data/" in name or "/hour=" in name:
                calls.append(name)
                if len(calls) > step:
                    raise InterruptedError
            return real(spark, name)

        monkeypatch.setattr(swaps, "_path", counted)
        return lambda: monkeypatch.setattr(swaps, "_path", real)

    return at


@pytest.mark.parametrize("step", [0, 1, 2, 5, 9])
def test_a_swap_cut_short_is_finished_by_the_next_run(spark, path, dies, step):
    sinks.write_partitions(hourly(spark), path)
    sinks.write_partitions(hourly(spark).withColumn("id", F.col("id") + 1000), path)
    before = rows(stored(spark, path))
    swap = swaps.Swap(spark, path)
    chosen = swaps.with_files(stored(spark, path))
    sinks.write_partitions(chosen.drop("_file"), swap.data)
    alive = dies(step)
    # The listing of what is staged is no step of the replay.
    with pytest.raises(InterruptedError):
        with swap:
            added = swap.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(swap.data).select(F.col("path").alias("_file"))
            swap.added = lambda: added
            swap.commit(chosen.select("_file"))
    alive()
    assert swaps.recover(spark, path) == 1
    assert rows(stored(spark, path)) == before
    assert swaps.recover(spark, path) == 0


def test_a_run_that_dies_before_its_journal_changed_nothing(spark, path, monkeypatch):
    sinks.write_partitions(hourly(spark), path)
    sinks.write_partitions(hourly(spark), path)
    before, files = rows(stored(spark, path)), file_names(stored(spark, path))

    def broken(*_):
        raise InterruptedError

    monkeypatch.setattr(swaps.Swap, "commit", broken)
    with pytest.raises(InterruptedError):
        sinks.compact(spark, path, path, lambda df: df)
    monkeypatch.undo()
    assert rows(stored(spark, path)) == before and file_names(stored(spark, path)) == files
    assert sinks.compact(spark, path, path, lambda df: df) == 1200
    assert rows(stored(spark, path)) == before


@pytest.mark.parametrize("work", ["compact", "merge", "upsert"])
def test_files_that_land_before_the_swap_stay(spark, path, monkeypatch, work):
    for _ in range(3):
        sinks.write_partitions(hourly(spark), path)
    real = swaps.Swap.commit

    def late(self, gone):
        sinks.write_partitions(hourly(spark, 40).withColumn("id", F.col("id") + 10_000), path)
        real(self, gone)

    monkeypatch.setattr(swaps.Swap, "commit", late)
    if work == "compact":
        assert sinks.compact(spark, path, path, lambda df: df) == 1800
    elif work == "merge":
        assert sinks.merge_small_files(spark, path) == 12
    else:
        sinks.upsert_partitions(hourly(spark, value=1), path, ["id"])
    monkeypatch.undo()
    found = stored(spark, path)
    assert found.where("id >= 10000").count() == 40
    assert found.where("id < 10000").count() == (600 if work == "upsert" else 1800)


def test_the_plan_picks_partitions_by_their_mean_file_and_fills_bins(spark):
    sizes = {"a": [10, 10, 10, 10, 10], "b": [200, 10], "c": [5], "d": [60, 60, 20], "e": [], "f": [49, 49, 49, 49, 1, 1]}
    listed = [(f"{p}/{i}", n, p) for p, many in sizes.items() for i, n in enumerate(many)]
    files = spark.createDataFrame(listed, "_file string, bytes long, p string")
    plan = sinks.merge_plan(files, ("p",), below=100, target_bytes=100)
    found = {}
    for r in plan.collect():
        found.setdefault((r["p"], r["_bin"]), []).append(r["bytes"])
    assert found == {("a", 0): [10] * 5, ("f", 0): [49, 49], ("f", 3): [1, 1]}


def test_only_small_files_are_merged_and_only_once(spark, path):
    pad = hourly(spark, 40_000).where("hour = '03'").withColumn("s", F.sha2(F.col("id").cast("string"), 512))
    small = hourly(spark).withColumn("s", F.lit("x"))
    for _ in range(3):
        sinks.write_partitions(small.where("hour < '02'"), path)
        sinks.write_partitions(pad, path)
    sinks.write_partitions(small.where("hour = '02'"), path)
    before, files = rows(stored(spark, path)), file_names(stored(spark, path))
    assert sinks.merge_small_files(spark, path, below=200_000, target_bytes=400_000) == 6
    assert rows(stored(spark, path)) == before
    now = file_names(stored(spark, path))
    untouched = {f for f in files if "hour=02" in f or "hour=03" in f}
    assert untouched <= now and len(now) == len(untouched) + 2
    assert sinks.merge_small_files(spark, path, below=200_000, target_bytes=400_000) == 0
    assert file_names(stored(spark, path)) == now


def test_merging_takes_odd_partition_names_and_a_picked_part(spark, path):
    names = ["a b", "c:d", "50%+1", None, "é"]
    df = spark.createDataFrame([(i, names[i % 5]) for i in range(100)], "id long, place string")
    for _ in range(2):
        sinks.write_partitions(df, path, ("place",))
    assert {r["place"] for r in swaps.listed_files(spark, path, ("place",)).collect()} == set(names)
    assert sinks.merge_small_files(spark, path, lambda f: f.where("place <> 'c:d'"), ("place",)) == 6
    assert rows(stored(spark, path).select("id", "place")) == rows(df.unionAll(df))
    assert len(file_names(stored(spark, path))) == 3 + 4
    assert sinks.compact(spark, path, path, lambda d: d, ("place",)) == 200
    assert len(file_names(stored(spark, path))) == 5
    assert rows(stored(spark, path).select("id", "place")) == rows(df.unionAll(df))


def test_merging_nothing(spark, path):
    assert sinks.merge_small_files(spark, path) == 0
    sinks.write_partitions(hourly(spark), path)
    assert sinks.merge_small_files(spark, path) == 0


def days(spark, data):
    return spark.createDataFrame(data, "k string, v int, day string")


def test_a_key_that_changes_its_day_occurs_once(spark, path):
    def upsert(data):
        sinks.upsert_partitions(days(spark, data), path, ["k"], ("day",), ["v"], key_buckets=4)
        return rows(stored(spark, path))

    assert upsert([("a", 1, "d1"), ("b", 1, "d1"), (None, 1, "d2"), ("c", 1, "d2")]) == sorted(
        [("a", 1, "d1"), ("b", 1, "d1"), (None, 1, "d2"), ("c", 1, "d2")], key=repr
    )
    untouched = file_names(stored(spark, path).where("day = 'd2'"))
    assert upsert([("a", 2, "d3")]) == sorted([("a", 2, "d3"), ("b", 1, "d1"), (None, 1, "d2"), ("c", 1, "d2")], key=repr)
    assert file_names(stored(spark, path).where("day = 'd2'")) == untouched
    # The last row of its day leaves; a null key is found again; versions within a batch.
    assert upsert([("b", 3, "d3"), (None, 3, "d1"), ("c", 3, "d9"), ("c", 4, "d2")]) == sorted(
        [("a", 2, "d3"), ("b", 3, "d3"), (None, 3, "d1"), ("c", 4, "d2")], key=repr
    )
    # Rows that another writer added are found as well.
    sinks.write_partitions(days(spark, [("z", 0, "d7")]), path, ("day",))
    assert ("z", 5, "d1") in upsert([("z", 5, "d1")]) and stored(spark, path).where("k = 'z'").count() == 1
    assert ("z", 6, "d2") in upsert([("z", 6, "d2")]) and stored(spark, path).where("k = 'z'").count() == 1


def test_the_index_is_read_by_bucket_and_rewritten_by_bucket(spark, path):
    many = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v"), (F.col("id") % 3).cast("string").alias("day"))
    sinks.upsert_partitions(many, path, ["k"], ("day",), key_buckets=16)
    index = f"{path}/_keys"
    before = file_names(spark.read.parquet(index))
    sinks.upsert_partitions(days(spark, [("7", 1, "2")]), path, ["k"], ("day",), key_buckets=16)
    after = file_names(spark.read.parquet(index))
    assert len(before - after) == 1 == len(after - before)
    assert stored(spark, path).count() == 2000 == spark.read.parquet(index).count()
    assert rows(stored(spark, path).where("k = '7'")) == [("7", 1, "2")]


def test_a_merged_object_stays_where_it_is_stored(spark, path):
    schema = "k int, data string, day string"
    sinks.upsert_partitions(spark.createDataFrame([(1, '{"a":1}', "d1")], schema), path, ["k"], ("day",), payload="data", key_buckets=2)
    for _ in range(2):
        new = spark.createDataFrame([(1, '{"a":9,"b":2}', "d2")], schema)
        sinks.upsert_partitions(new, path, ["k"], ("day",), payload="data", key_buckets=2)
    ((k, data, day),) = rows(stored(spark, path))
    assert (k, json.loads(data), day) == (1, {"a": 1, "b": 2}, "d1")


def test_a_repeated_insert_adds_nothing(spark):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_partitioned_table(spark, name, "k string, v int, day string", ("day",), staging.staging_path(spark, "table"))
    first = days(spark, [("a", 1, "d1"), ("a", 1, "d1"), (None, 2, "d1"), ("a", 1, "d2")])
    for _ in range(2):
        sinks.insert_missing(first, name, ["k", "v", "day"], ("day",), ["k"])
    assert rows(spark.table(name)) == [("a", 1, "d1"), ("a", 1, "d2"), (None, 2, "d1")]
    sinks.insert_missing(days(spark, [("a", 9, "d1"), ("b", 9, "d1"), ("a", 9, "d3")]), name, ["k", "v", "day"], ("day",), ["k"])
    assert rows(spark.table(name).where("v = 9")) == [("a", 9, "d3"), ("b", 9, "d1")]
