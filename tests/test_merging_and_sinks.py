import json

import pytest
from pyspark.sql import functions as F

from airway.operators.hours import HourRange, into_slots
from airway.operators.merging import assemble, difference, frequent_keys, latest_rows, latest_value, upsert, upsert_json
from airway.plans import portrait
from airway.sources import scans, sinks, staging, swaps
from tests.helpers import plan_of, rows


def test_difference_treats_nulls_as_equal(spark):
    new = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1), ("c", 2)], "k string, v int")
    old = spark.createDataFrame([("a", None), ("c", 3)], "k string, v int")
    assert rows(difference(new, old)) == [("b", 1), ("c", 2)] == rows(new.subtract(old))


@pytest.mark.parametrize("broadcast", [True, False])
def test_upsert_is_idempotent(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, seq int")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, seq int")
    once = upsert(new, old, ["k"], ["seq"])
    assert rows(once) == [(1, "a", 0), (2, "y", 2), (3, "z", 1)]
    assert rows(upsert(new, once, ["k"], ["seq"])) == rows(once)


def test_null_keys_are_found_again(spark):
    old = spark.createDataFrame([(None, "a", '{"x":1}'), (1, None, '{"x":2}')], "k int, l string, data string")
    new = spark.createDataFrame([(None, "a", '{"x":5}'), (None, None, '{"x":6}')], "k int, l string, data string")
    once = upsert(new, old, ["k", "l"])
    assert rows(once) == [(1, None, '{"x":2}'), (None, "a", '{"x":5}'), (None, None, '{"x":6}')]
    assert rows(upsert(new, once, ["k", "l"])) == rows(once)
    merged = upsert_json(new, old, ["k", "l"], "data")
    assert rows(merged) == [(1, None, '{"x":2}'), (None, "a", '{"x":1}'), (None, None, '{"x":6}')]


def test_json_upsert_keeps_stored_members(spark):
    old = spark.createDataFrame([(1, '{"a":1,"b":2}', "s")], "k int, data string, at string")
    new = spark.createDataFrame([(1, '{"a":9,"c":3}', "n"), (2, '{"a":5}', "n")], "k int, data string, at string")
    got = [(k, json.loads(data), at) for k, data, at in rows(upsert_json(new, old, ["k"], "data"))]
    assert got == [(1, {"a": 1, "b": 2, "c": 3}, "s"), (2, {"a": 5}, "n")]


def test_assemble_is_a_full_outer_join(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, b int")
    assert rows(assemble([a, b], ["k"])) == [(1, 10, None), (2, 20, 5), (3, None, 6)]
    with pytest.raises(ValueError):
        assemble([a, a], ["k"])


def test_frequent_keys_ignore_null(spark):
    df = spark.createDataFrame([(None,)] * 9 + [(1,)] * 3 + [(2,)] * 2, "k int")
    assert rows(frequent_keys(df, "k", 2)) == [(1,)]


def test_latest(spark):
    df = spark.createDataFrame([("d", "1", "5-x"), ("d", "2", None), ("d", "2", "3-x"), ("e", "1", None)], "day string, at string, v string")
    assert rows(latest_rows(df, "day", "at"), "day", "v") == [("d", "3-x"), ("d", None), ("e", None)]
    assert rows(latest_value(df, "day", "at", F.substring("v", 1, 1), "x")) == [("d", "3"), ("e", None)]


def test_slots_of_overlapping_windows(spark):
    df = spark.createDataFrame([("2024-01-01 01:30:00",), ("2024-01-01 03:00:00",)], "t string").select(F.col("t").cast("timestamp"))
    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 02:00:00", ahead=2, span=2)
    got = rows(into_slots(df, "t", hours).select(F.date_format("published_at", "HH").alias("h"), F.date_format("t", "HH:mm").alias("t")))
    assert got == [("02", "01:30"), ("03", "01:30"), ("04", "03:00")]


def table(spark, n=600):
    hour = F.when(F.col("id") % 3 == 0, "00").otherwise(F.lpad((F.col("id") % 24).cast("string"), 2, "0"))
    return spark.range(n).select("id", F.lit("2024-01-01").alias("publish_date"), hour.alias("hour"))


def test_partition_scan_prunes_and_tolerates_gaps(spark):
    path = staging.staging_path(spark, "t")
    sinks.write_partitions(table(spark).where(F.col("hour") != "05"), path)
    found = scans.read_hours(spark, path, HourRange("2024-01-01 00:00:00", "2024-01-01 06:00:00"))
    assert {r["hour"] for r in found.select("hour").distinct().collect()} <= {"00", "01", "02", "03", "04", "06"}
    plan = plan_of(found)
    assert "publish_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_typed_partition_columns_are_understood(spark):
    path = staging.staging_path(spark, "t")
    sinks.write_partitions(table(spark), path)
    inferred = spark.read.parquet(path)
    assert dict(inferred.dtypes)["hour"] == "int"
    resolved = scans.Tables(spark, {"t": path})("t")
    assert dict(resolved.dtypes)["hour"] == "string"
    picked = [scans.in_hours(df, "2024-01-01 01:00:00", "2024-01-01 08:00:00").count() for df in (inferred, resolved)]
    assert picked[0] == picked[1] > 0


def test_unreadable_files_can_be_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitions(table(spark), path)
    broken = tmp_path / "t" / "publish_date=2024-01-01" / "hour=23"
    broken.mkdir(exist_ok=True)
    (broken / "part-x.parquet").write_text("no parquet")
    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 23:00:00")
    assert scans.read_hours(spark, path, hours, skip_unreadable=True).count() == 600
    with pytest.raises(Exception, match="(?i)parquet"):
        scans.read_hours(spark, path, hours).select(F.sum("id")).collect()


def test_upsert_scan_is_pruned_by_touched_partitions(spark):
    path = staging.staging_path(spark, "t")
    sinks.write_partitions(table(spark), path)
    stored = scans.read_partitioned(spark, path)
    touched = staging.staged(table(spark).where("hour = '07'"), "n").agg(F.min("hour").alias("low"))
    plan = plan_of(stored.where(F.col("hour") >= touched.select("low").scalar()))
    assert "subquery" in plan.split("PartitionFilters: [")[1].split("]")[0].lower()


@pytest.fixture
def small_splits(spark):
    """Read small files with several tasks, as large files would be."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "300000",
        "spark.sql.files.openCostInBytes": "1000",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_compaction_keeps_rows_and_splits_a_large_partition(spark, small_splits):
    path = staging.staging_path(spark, "t")
    rows_in = table(spark, 60000).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    rows_in.repartition(6).write.partitionBy("publish_date", "hour").parquet(path)
    before = rows(scans.read_partitioned(spark, path).groupBy("hour").agg(F.sum("id"), F.count("*")))
    n = sinks.compact(spark, path, path, lambda df: df.where(F.col("hour") < "12"), target_bytes=500_000)
    copy = scans.read_partitioned(spark, path)
    assert n == copy.where(F.col("hour") < "12").count()
    assert rows(copy.groupBy("hour").agg(F.sum("id"), F.count("*"))) == before
    files = {r["hour"]: r["n"] for r in copy.groupBy("hour").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    small = [files[h] for h in files if "01" <= h < "12"]
    assert files["00"] > 1 and min(small) == 1 and sum(small) < 6 * len(small) / 2 and files["13"] == 6


def test_upsert_leaves_other_partitions_alone(spark):
    path = staging.staging_path(spark, "t")
    base = table(spark).withColumn("v", F.lit(0))
    sinks.write_partitions(base, path)
    other = lambda: {
        r[0] for r in scans.read_partitioned(spark, path).where("hour = '13'").select("_metadata.file_path").distinct().collect()
    }
    files = other()
    new = base.where("hour = '07'").withColumn("v", F.lit(1))
    for _ in range(2):
        sinks.upsert_partitions(new, path, ["id"])
    got = scans.read_partitioned(spark, path)
    assert other() == files and got.count() == 600
    assert rows(got.where("v = 1"), "id") == rows(new, "id")


def test_backfill_replaces_whole_hours_with_a_difference(spark):
    schema = "grid_id int, station_code string, station_name string, data string, published_at string"
    old = spark.createDataFrame([(1, "a", "A", '{"x":1.0}', "h1"), (1, "b", "B", '{"x":2}', "h1"), (1, "a", "A", '{"x":1}', "h2")], schema)
    new = spark.createDataFrame([(1, "a", "A", '{"x":1.0}', "h1"), (1, "b", "B", '{"x":3}', "h1"), (1, "a", "A", '{"x":1}', "h2")], schema)
    assert rows(portrait.portrait_diff(new, old)) == [("h1", "b", "B", "x", "3")]
    assert rows(portrait.backfill(new, old), "data", "published_at") == [('{"x":1.0}', "h1"), ('{"x":1}', "h2"), ('{"x":3}', "h1")]
    assert portrait.portrait_diff(new, new).isEmpty()


def test_json_upsert_into_partitions(spark):
    path = staging.staging_path(spark, "t")
    schema = "k int, data string, publish_date string, hour string"
    old = spark.createDataFrame([(1, '{"a":1}', "d", "01"), (2, '{"a":2}', "d", "02")], schema)
    new = spark.createDataFrame([(1, '{"a":9,"b":1}', "d", "01"), (3, "{}", "d", "01")], schema)
    sinks.upsert_partitions(old, path, ["k", "hour"])
    sinks.upsert_partitions(new, path, ["k", "hour"], payload="data")
    sinks.upsert_partitions(new.limit(0), path, ["k", "hour"])
    got = {r["k"]: json.loads(r["data"]) for r in scans.read_partitioned(spark, path).collect()}
    assert got == {1: {"a": 1, "b": 1}, 2: {"a": 2}, 3: {}}


def test_compacting_no_partition_changes_nothing(spark):
    path = staging.staging_path(spark, "t")
    sinks.write_partitions(table(spark), path)
    assert sinks.compact(spark, path, path, lambda df: df.where("publish_date = '1999-01-01'")) == 0
    assert scans.read_partitioned(spark, path).count() == 600


def test_files_that_come_during_a_compaction_stay(spark):
    path = staging.staging_path(spark, "t")
    sinks.write_partitions(table(spark), path)
    calls = []

    def pick(df):
        if not calls:  # rows land after the first listing
            sinks.write_partitions(table(spark, 10), path)
        calls.append(1)
        return df

    assert sinks.compact(spark, path, path, pick) == 600
    assert scans.read_partitioned(spark, path).count() == 610
    assert sinks.compact(spark, path, path, lambda df: df) == 610


def test_skipped_files_are_named(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitions(table(spark), path)
    assert scans.files_without_rows(spark, path).count() == 0
    (tmp_path / "t" / "publish_date=2024-01-01" / "hour=23" / "part-x.parquet").write_text("no parquet")
    found = [r["path"] for r in scans.files_without_rows(spark, path).collect()]
    assert [p.rsplit("/", 1)[1] for p in found] == ["part-x.parquet"]


def test_text_lines_all_stay_but_the_first_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("head\n1,\u0001 x\n\n  \nhead\n")
    (tmp_path / "b.csv").write_text("head\n2\n")
    (tmp_path / "c.csv").write_text("")
    found = sorted(r["value"] for r in scans.read_text_lines(spark, str(tmp_path)).collect())
    assert found == ["", "  ", "1,\u0001 x", "2", "head"]


def test_lookup_of_unknown_size_is_broadcast_at_run_time(spark, no_broadcast):
    from airway.operators.joining import lookup_join

    facts = spark.range(50_000).withColumn("k", F.col("id") % 5)
    lookup = spark.createDataFrame([(i, str(i)) for i in range(5)], "k long, name string").repartition(2)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760")
    try:
        joined = lookup_join(facts, lookup, "k")
        assert joined.count() == 50_000
        joined.collect()
        assert "BroadcastHashJoin" in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_one_per_key_takes_maps(spark):
    from airway.operators.cleaning import one_per_key

    df = spark.createDataFrame([(1, {"a": 2}), (1, {"a": 1}), (None, {}), (None, {})], "k int, m map<string,int>")
    assert sorted((r["k"] or 0, r["m"]) for r in one_per_key(df, ["k"]).collect()) == [(0, {}), (1, {"a": 1})]


def test_backfill_leaves_no_staged_tables(spark):
    owner = staging.Work(spark)
    kept = owner.stage(spark.range(5), "t")
    assert kept.count() == 5
    folder = owner.paths[0]
    owner.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def test_derived_columns_are_not_shuffled(spark):
    """Wide columns neither cross the exchange nor split a partition into more files."""
    path = staging.staging_path(spark, "wide")
    df = spark.range(0, 2000, 1, 4).select("id", F.lit("2024-01-01").alias("publish_date"), F.lit("05").alias("hour"))
    wide = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.sha2(F.concat(F.col("id"), i), 512)), "")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        sinks.write_partitions(df, path, derived={"pad": wide})
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = scans.read_partitioned(spark, path)
    assert stored.where("length(pad) = 5120").count() == 2000
    assert swaps.listed_files(spark, path, scans.HOUR_KEYS).count() == 1


def test_padding_of_good_files_takes_half_its_length_on_disk(spark, monkeypatch):
    """``small_files_merged`` pads 7,680 characters a row of hex text."""
    from airway.checks import load_checks, tables

    paths, fresh = [], tables._fresh
    monkeypatch.setattr(tables, "_fresh", lambda fx, name: (paths.append(fresh(fx, name)), paths[-1])[1])
    assert load_checks()["small_files_merged"].run(spark, "/root/testdata/sf0.01").agg(F.sum("n")).first()[0] == 10_000
    late = F.col("publish_date") >= "2024-01-10"
    padded = scans.read_partitioned(spark, paths[0]).where(late)
    bytes_of = swaps.listed_files(spark, paths[0], scans.HOUR_KEYS).where(late).agg(F.sum("bytes")).first()[0]
    assert padded.where("length(pad) = 7680").count() == padded.count() > 0
    assert bytes_of < 5000 * padded.count()
