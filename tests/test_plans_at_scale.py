"""Plans that decide what large inputs cost: one exchange, weights once, pruning, digests."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from airway.operators.hours import HourRange
from airway.operators.spatial import idw, idw_over_time, radius_join, sites_of, spot_weights
from airway.operators.trajectory import boundaries, chunk_bounds, neighbours, stays
from airway.plans import portrait
from airway.sources import scans, sinks, staging, swaps
from tests.helpers import metres, plan_of, rows


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_rows_inside_a_chunk_are_exchanged_once(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id")
    plan = final_plan(neighbours(events, "user_id", "ts", "event_id"))
    by_chunk = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_chunk" in line]
    assert len([line for line in by_chunk if "ReusedExchange" not in line]) == 1 == plan.count("ReusedExchange")
    # What is exchanged along the vehicle is narrowed to the edges of chunks first.
    (along,) = [i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(user_id" in line and "_chunk" not in line]
    assert "Filter (isnull(" in "".join(plan.splitlines()[along : along + 4])


@pytest.mark.parametrize("seconds", [1, 60, 10**9])
def test_neighbours_with_ties_keep_every_row(spark, seconds):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.randrange(300), rng.choice(["x", "y", None]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, t long, v string, i long").withColumn("t", F.timestamp_seconds("t"))
    found = neighbours(df.repartition(16), "k", "t", "v", chunk_seconds=seconds)
    assert sorted(r["i"] for r in found.collect()) == list(range(3000))
    ordered = sorted(data, key=lambda r: (r[0], r[1], (r[2] is not None, r[2] or ""), r[3]))
    want = {}
    for j, (k, _, _, i) in enumerate(ordered):
        before = ordered[j - 1][2] if j and ordered[j - 1][0] == k else None
        after = ordered[j + 1][2] if j + 1 < len(ordered) and ordered[j + 1][0] == k else None
        want[i] = (before, after)
    assert {r["i"]: (r["v_lag"], r["v_lead"]) for r in found.collect()} == want


def weather(spark, n=4000):
    rng = random.Random(2)
    data = [(rng.randrange(6) / 10, rng.randrange(4) / 10, rng.choice([1.0, 2.5, None]), f"2024-01-01 {rng.randrange(8):02d}:00:00") for _ in range(n)]
    data += [(None, 0.1, 5.0, "2024-01-01 01:00:00")]
    return spark.createDataFrame(data, "lon double, lat double, v double, published_at string").withColumn("published_at", F.to_timestamp("published_at"))


def test_weights_over_time_equal_the_mean_of_all_pairs(spark):
    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 09:00:00")
    sites = sites_of(spark.createDataFrame([(0.0, 0.0), (0.1, 0.1), (3.0, 2.0)], "lon double, lat double"))
    places = sites.columns
    samples = weather(spark)
    slots = sites.select("*", F.col(places[0]).alias("lon"), F.col(places[1]).alias("lat"), F.explode(hours.slots()).alias("published_at"))
    want = idw(slots, samples, ["published_at"], places, "v")
    found = idw_over_time(sites, hours.slots(), samples, "published_at", "v")
    names = [*places, "published_at", "v"]
    assert rows(found, *names) == rows(want, *names) and found.count() == 30
    plan = plan_of(found).lower()
    assert "asin" not in plan and "sin(" not in plan and "cartesian" not in plan and "nestedloop" not in plan


def test_weights_beyond_the_bound_stay_spread_by_location(spark, monkeypatch):
    from airway.operators import spatial

    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 09:00:00")
    sites = sites_of(spark.range(40).select((F.col("id") / 50).alias("lon"), F.lit(0.05).alias("lat")))
    want = rows(idw_over_time(sites, hours.slots(), weather(spark), "published_at", "v"))
    monkeypatch.setattr(spatial, "fits_broadcast", lambda df, copies=1: False)
    found = idw_over_time(sites, hours.slots(), weather(spark), "published_at", "v")
    assert rows(found) == want and len(want) == 400
    join, below = plan_of(found).split("BroadcastHashJoin", 1)
    streamed, _ = below.split("BroadcastExchange", 1)
    assert "BuildRight" in below.splitlines()[0] and "hashpartitioning(center_lon" in streamed and "_w#" in streamed


def stored_keys(spark, n):
    """A table of n keys, a few bytes each on disk."""
    path = staging.staging_path(spark, "keys")
    spark.range(0, n, 1, 4).select("id", F.lit('{"lon": 104.0, "lat": 30.0}').alias("center_coord")).write.parquet(path)
    return spark.read.parquet(path)


def test_a_large_table_of_keys_does_not_go_through_the_driver(spark):
    """1.5 million cells are a few MB on disk and more than 70 MB in a hash table."""
    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 09:00:00")
    sites = sites_of(spark.createDataFrame([(104.0, 30.0)], "lon double, lat double"))
    dust = spark.createDataFrame([(7, "[[1.6, 5]]", "2024-01-01 08:00:00"), (9, "[[2, 5]]", "2024-01-01 08:00:00")], "grid_id long, slag_truck_coords string, published_at string")
    plans = {}
    for n in (1_000, 1_500_000):
        found = portrait.dust_feature(dust, stored_keys(spark, n), sites, hours)
        assert [r["dust_index"] for r in found.collect()] == [4]
        plans[n] = plan_of(found)
    assert "BroadcastHashJoin" in plans[1_000] and "Broadcast" not in plans[1_500_000].split("Initial Plan")[0]


def test_many_differing_portraits_do_not_go_through_the_driver(spark):
    schema = "grid_id int, station_code string, station_name string, data string, published_at string"
    code = F.lpad(F.col("id").cast("string"), 9, "0")
    new = spark.range(0, 400_000, 1, 4).select(F.lit(1).alias("grid_id"), code.alias("station_code"), F.sha1(code).alias("station_name"), F.lit('{"x":1}').alias("data"), F.lit("h").alias("published_at"))
    stored = spark.createDataFrame([(1, "000000005", None, '{"x":1}', "h")], schema)
    found = portrait.portrait_diff(new, stored)
    assert "Broadcast" not in plan_of(found)
    assert found.count() == 400_000


def test_weights_leave_out_the_spot_itself(spark):
    sites = sites_of(spark.createDataFrame([(1.0, 1.0)], "lon double, lat double"))
    spots = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "_lon double, _lat double")
    ((_, lat, w),) = [(r["_lon"], r["_lat"], r["_w"]) for r in spot_weights(sites, spots).collect()]
    assert lat == 2.0 and 0 < w < 1e-9


def test_wanted_hours_prune_the_track_table_at_run_time(spark):
    name = f"t_{uuid.uuid4().hex}"
    schema = "plate_num string, sim_card string, speed double, up_time bigint, lon string, lat string, publish_date string, hour string"
    sinks.create_partitioned_table(spark, name, schema, scans.HOUR_KEYS, staging.staging_path(spark, "tracks"))
    moved = spark.range(2400).select(
        F.col("id").cast("string").alias("plate_num"), F.lit("s").alias("sim_card"), F.lit(1.0).alias("speed"), F.col("id").alias("up_time"),
        F.lit("104.0").alias("lon"), F.lit("30.0").alias("lat"), F.lit("2024-01-01").alias("publish_date"), F.lpad((F.col("id") % 24).cast("string"), 2, "0").alias("hour"),
    )
    sinks.insert_positional(moved, name, [c.split()[0] for c in schema.split(", ")], scans.HOUR_KEYS)
    wanted = staging.staged(spark.createDataFrame([("2024-01-01", "03")], "publish_date string, hour string"), "wanted")
    hours = HourRange("2024-01-01 00:00:00", "2024-01-01 23:00:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        found = portrait.gps_from_partitions(spark.table(name), hours, wanted)
        filters = plan_of(found).split("PartitionFilters: [")[1].split("PushedFilters")[0].lower()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert found.count() == 100 and "dynamicpruning" in filters


def test_only_portraits_with_another_digest_are_taken_apart(spark, monkeypatch):
    schema = "grid_id int, station_code string, station_name string, data string, published_at string"
    same = [(1, f"s{i}", None if i % 2 else "n", f'{{"x":{i}}}', "h1") for i in range(50)]
    new = spark.createDataFrame([*same, (1, "z", "Z", '{"x":1,"y":2}', "h2"), (1, "q", "Q", '{"x": 1}', "h2"), (2, None, None, '{"x":5}', "h3")], schema)
    old = spark.createDataFrame([*same, (1, "z", "Z", '{"x":1,"y":3}', "h2"), (9, "q", "Q", '{"x":1}', "h2")], schema)
    seen = []
    real = portrait.explode_payload
    monkeypatch.setattr(portrait, "explode_payload", lambda df, keep: (seen.append(df.count()), real(df, keep))[1])
    found = rows(portrait.portrait_diff(new, old), "published_at", "station_code", "key", "value")
    assert found == sorted([("h2", "z", "y", "2"), ("h3", None, "x", "5")], key=repr)
    assert seen == [3, 2]


def test_broken_files_are_reported_with_their_partition(spark):
    path = staging.staging_path(spark, "t")
    df = spark.range(100).select("id", F.lit("2024-01-01").alias("publish_date"), F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("hour"))
    sinks.write_partitions(df, path)
    found, report = scans.read_whole_partitions(spark, path)
    assert found.count() == 100 and report.count() == 0
    swaps.write_bytes(spark, f"{path}/publish_date=2024-01-01/hour=01/x.parquet", b"cut")
    swaps.write_bytes(spark, f"{path}/publish_date=2024-01-01/hour=02/y.parquet", b"")
    df.limit(0).select("id").coalesce(1).write.mode("append").parquet(f"{path}/publish_date=2024-01-01/hour=02")
    swaps.write_bytes(spark, f"{path}/publish_date=2024-01-01/hour=77/x.parquet", b"PAR1 and no footer PAR1")
    found, report = scans.read_whole_partitions(spark, path)
    assert {r["hour"] for r in found.select("hour").distinct().collect()} == {"00", "02"}
    assert sorted((r["hour"], r["path"].rsplit("/", 1)[1]) for r in report.collect()) == [("01", "x.parquet"), ("77", "x.parquet")]


def crowded(spark, n):
    """One vehicle with n rows in one hour and few others, places changing now and then."""
    rows_of = spark.range(n).select(
        F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 3_500 + 1_700_000_400_000_000).alias("t"), F.floor(F.col("id") / 777).cast("int").alias("place"), "id"
    )
    others = spark.range(200).select(
        F.concat(F.lit("v"), F.col("id") % 7).alias("k"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("t"), (F.col("id") % 3).cast("int").alias("place"), "id"
    )
    return rows_of.unionByName(others)


def test_an_hour_of_one_vehicle_is_worked_on_by_many_tasks(spark):
    df = crowded(spark, 1_000_000)
    bounds = chunk_bounds(df, "k", "t", rows=50_000)
    assert {r["key"] for r in bounds.collect()} == {"hot"}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = neighbours(df, "k", "t", "id", bounds=bounds).withColumn("_task", F.spark_partition_id())
        tasks = found.where("k = 'hot'").groupBy("_task").agg(F.count("*").alias("n")).orderBy(F.desc("n")).collect()
        wrong = found.where("k = 'hot' AND (NOT id_lag <=> nullif(id - 1, -1) OR NOT id_lead <=> nullif(id + 1, 1000000))").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert wrong == 0 and sum(r["n"] for r in tasks) == 1_000_000
    assert len(tasks) >= 12 and tasks[0]["n"] <= 250_000
    joined = stays(df, "k", "t", "place", bounds=bounds)
    assert joined.where("k = 'hot'").agg(F.count("*"), F.sum("points"), F.max("points")).first() == (1288, 1_000_000, 777)


@pytest.mark.parametrize("zone", ["timestamp", "timestamp_ntz", "string"])
def test_bounds_change_no_result(spark, zone):
    df = crowded(spark, 5_000).withColumn("t", F.col("t").cast(zone))
    df = df.unionByName(df.where("id % 10 = 0").withColumns({"place": F.lit(None).cast("int"), "id": F.col("id") + 100_000}))
    bounds = chunk_bounds(df, "k", "t", rows=100)
    assert bounds.where("k IS NULL OR size(cuts) < 10".replace("k ", "key ")).count() == 0
    for work in (neighbours, boundaries, stays):
        args = (df, "k", "t", "place", ["id"])
        assert rows(work(*args, bounds=bounds)) == rows(work(*args))
    assert chunk_bounds(df.limit(0), "k", "t").count() == 0


def test_a_local_warehouse_is_no_work_folder_on_a_cluster():
    from types import SimpleNamespace

    from airway.session import work_root

    def session(master, warehouse, folder=None):
        conf = SimpleNamespace(get=lambda key, default=None: warehouse if key == "spark.sql.warehouse.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: folder)))

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        work_root(session("yarn", "file:/home/x/warehouse"))
    assert work_root(session("local[2]", "file:/home/x/warehouse")) == "file:/home/x/warehouse/airway-work"
    assert work_root(session("yarn", "hdfs://n/warehouse")) == "hdfs://n/warehouse/airway-work"
    assert work_root(session("yarn", "file:/w", "file:///shared/")) == "file:///shared"


def test_a_crowded_cell_is_many_keys(spark, no_broadcast):
    """All points in one cell, no broadcast: the pairs are made by many tasks."""
    rng = random.Random(4)
    points = spark.createDataFrame([(i, 104.0 + rng.random() / 250, 30.0 + rng.random() / 250) for i in range(40_000)], "i long, lon double, lat double")
    centers = spark.createDataFrame([(c, 104.0 + rng.random() / 10, 30.0 + rng.random() / 10) for c in range(12)], "c long, center_lon double, center_lat double")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        plain = radius_join(points, centers)
        found = radius_join(points, centers, crowded_rows=1_000)
        counts = [
            [r["n"] for r in df.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()] for df in (plain, found)
        ]
        assert rows(found, "i", "c") == rows(plain, "i", "c")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    assert sum(counts[0]) == sum(counts[1]) > 50_000
    assert len(counts[0]) <= 4 and len(counts[1]) > 8 and max(counts[1]) < max(counts[0]) / 2
    assert rows(radius_join(points, centers, crowded_rows=10**9), "i", "c") == rows(plain, "i", "c")


def test_pairs_of_cells_and_stations_are_not_shuffled(spark, no_broadcast, tmp_path):
    """Stations meet their locations before the pairs are made; copies and null keys as ever."""
    from airway.checks import load_checks
    from airway.checks.fixtures import POINTS, SITES

    keys = [*range(60), 7, 7, None]
    stations = spark.createDataFrame([(k, f"s{k}", 1) for k in keys], "s_suppkey long, s_name string, s_nationkey int")
    stations.write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(k,) for k in [*range(200), 9, None]], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))

    def at(k, a, b, modulus, step):
        return 103.9 + k * a % modulus * step, 30.5 + k * b % modulus * step

    found = load_checks()["cells_of_stations"].run(spark, str(tmp_path))
    want = [(c, str(k)) for c in [*range(200), 9] for k in keys[:-1] if metres(*at(c, *POINTS), *at(k, *SITES)) < 5000]
    above, below = plan_of(found).split("SortMergeJoin", 1)
    assert "Exchange" not in above and "_cell" in below.splitlines()[0]
    assert rows(found, "cell", "station_code") == sorted(want, key=repr) and len(want) > 100
