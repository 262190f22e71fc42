"""Aggregates made tile by tile equal those of all pairs, and make none."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airway.operators import tiles
from airway.operators.hours import HourRange
from airway.operators.spatial import SITE, radius_join, radius_summary, rect_join, site_summary, site_totals
from airway.plans import portrait
from tests.helpers import plan_of, rows

HOURS = HourRange("2024-01-01 00:00:00", "2024-01-01 05:00:00")


def places(n, seed):
    rng = random.Random(seed)
    return [(104.0 + rng.uniform(0, 0.3), 30.5 + rng.uniform(0, 0.3)) for _ in range(n)]


def sites_frame(spark, n=30):
    return spark.createDataFrame(places(n, 1), ", ".join(f"{c} double" for c in SITE))


def tracks_frame(spark):
    rng = random.Random(2)
    data = [
        (x, y, rng.choice(["08", "09", None]), rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice([1.5, None, 2.0]))
        for x, y in places(900, 3)
    ]
    return spark.createDataFrame(data, "lon double, lat double, h string, plate string, card int, v double")


@pytest.mark.parametrize("by", [["h"], []])
def test_distinct_vehicles_equal_those_of_pairs(spark, by):
    points, sites = tracks_frame(spark), sites_frame(spark)
    found = site_totals(points, sites, {"n": F.lit(1), "v": F.col("v")}, by, distinct=("cars", ["plate", "card"]))
    plain = [F.count("*").alias("n"), F.sum("v").alias("v"), F.count_distinct("plate", "card").alias("cars")]
    names = [*SITE, *by, "n", "v", "cars"]
    assert found.schema.fieldNames() == names
    assert rows(found, *names) == rows(site_summary(points, sites, plain, by), *names)
    assert "Join" not in plan_of(found)


def test_a_vehicle_in_several_parts_counts_once(monkeypatch):
    monkeypatch.setattr(tiles, "PAIRS", 3)
    schema = pa.schema([("center_lon", pa.float64()), ("center_lat", pa.float64()), ("n", pa.int64()), ("cars", pa.int64())])
    points = pa.table({"lon": [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0], "lat": [0.0] * 7, "car": ["a", "a", "a", "b", None, "a", "b"], "one": [1] * 7})
    sites = pa.table({"center_lon": [0.0, 1.0, 5.0], "center_lat": [0.0] * 3})
    found = tiles.totals([], ["one"], ["car"], 5000, schema)(points, sites)
    assert found.to_pydict() == {"center_lon": [0.0, 1.0], "center_lat": [0.0, 0.0], "n": [5, 2], "cars": [2, 2]}


def test_values_that_are_not_finite_and_large_ones_stay_where_they_are(spark):
    sites = spark.createDataFrame([(104.0, 30.0), (104.02, 30.0), (104.5, 30.0)], ", ".join(f"{c} double" for c in SITE))
    big = 2**60 + 1
    data = [(104.0, 30.0, 1.0, big), (104.06, 30.0, float("nan"), 1), (104.5, 30.0, float("inf"), 3), (float("nan"), 30.0, 9.0, 9)]
    points = spark.createDataFrame(data, "lon double, lat double, v double, k long")
    found = site_totals(points, sites, {"v": F.col("v"), "k": F.col("k")}, [])
    got = {r[SITE[0]]: (str(r["v"]), r["k"]) for r in found.collect()}
    assert got == {104.0: ("1.0", big), 104.02: ("nan", big + 1), 104.5: ("inf", 3)}


def test_named_sums_of_centers_at_one_spot(spark):
    centers = spark.createDataFrame([(i, 104.0, 30.0) for i in range(5)], "k long, lon double, lat double")
    points = spark.createDataFrame([(i % 3, 104.0, 30.01) for i in range(9)], "v long, lon double, lat double")
    found = radius_summary(points, centers, ["k"], {"n": F.lit(1)}, distinct=("d", ["v"]))
    assert rows(found, "k", "n", "d") == [(i, 9, 3) for i in range(5)]


def test_hourly_features_of_cells_and_roads_make_no_pairs(spark):
    """Copies of cells count again, copies of a section do not; a section has several vertices."""
    rng, sites = random.Random(4), sites_frame(spark, 12)
    spots = places(40, 5)
    cells = [(i % 38, f'{{"lon":{x},"lat":{y}}}') for i, (x, y) in enumerate(spots)]
    cells = spark.createDataFrame(cells, "id long, center_coord string")
    work = [(rng.randrange(40), rng.randrange(9), f"2024-01-01 0{rng.randrange(4)}:00:00") for _ in range(300)]
    work = spark.createDataFrame(work, "grid_id long, truck_num long, published_at string")
    at = ["published_at", *SITE]
    stamped = work.withColumn("published_at", F.to_timestamp("published_at"))
    found = portrait.earth_feature(work, cells, sites, HOURS)
    near = stamped.join(portrait.cell_sites(cells, sites), "grid_id").groupBy(*at).agg(F.sum("truck_num").alias("earth_num"))
    assert rows(found, *at, "earth_num") == rows(near, *at, "earth_num") and found.count() > 20

    roads = [(i, f"r{i % 3}" if i % 7 else None, f"[[{spots[i][0]}, {spots[i][1]}],[{spots[i + 5][0]}, {spots[i + 5][1]}]]") for i in range(30)]
    roads = spark.createDataFrame([*roads, *roads[:9]], "id long, roadname string, section_gcj02_json string")
    flow = [(rng.randrange(15), rng.randrange(2), f'{{"large":{rng.randrange(50)}}}', f"2024-01-01 0{rng.randrange(4)}:00:00") for _ in range(300)]
    flow = spark.createDataFrame(flow, "edge_id long, driving_direction long, data string, published_at string")
    sections = spark.range(30).select((F.col("id") % 15).alias("edge_id"), F.floor(F.col("id") / 15).alias("driving_direction"), F.col("id").alias("road_congested_section_id"))
    found = portrait.flow_feature(flow, sections, roads, sites, HOURS)
    most = flow.join(sections, ["edge_id", "driving_direction"]).withColumnRenamed("road_congested_section_id", "id")
    most = most.withColumn("published_at", F.to_timestamp("published_at")).groupBy("id", "published_at").agg(F.max(F.get_json_object("data", "$.large").cast("double")).alias("f"))
    passed = radius_join(portrait.section_vertices(roads), sites).select("id", "roadname", *SITE).distinct()
    mean = most.join(passed, "id").groupBy("roadname", *at).agg(F.avg("f").alias("f"))
    want = mean.groupBy(*at).agg(F.round(F.sum("f"), 6).cast("int").alias("traffic_flow"))
    assert rows(found, *at, "traffic_flow") == rows(want, *at, "traffic_flow") and found.count() > 20


def test_centers_of_few_points_are_not_broadcast(spark):
    """Catalyst takes 60 centers for small, whatever the number of their cells."""
    points = spark.range(500).select("id", (104.0 + F.col("id") / 50_000).alias("lon"), F.lit(30.5).alias("lat"))
    centers = spark.range(60).select(F.col("id").alias("c"), (104.0 + F.col("id") / 5_000).alias("center_lon"), F.lit(30.5).alias("center_lat"))
    plain, dealt = radius_join(points, centers), radius_join(points, centers, crowded_rows=20)
    joins = [[line for line in plan_of(df).splitlines() if "Join" in line and "_cell" in line] for df in (plain, dealt)]
    assert "SortMergeJoin" in joins[0][0] and "SortMergeJoin" in joins[1][0]
    assert rows(dealt, "id", "c") == rows(plain, "id", "c") and plain.count() > 20_000


def test_cells_between_the_edges_of_a_rectangle_need_no_test(spark):
    names = ["bottom_left_lon", "bottom_left_lat", "top_right_lon", "top_right_lat"]
    rects = spark.createDataFrame([(1, -0.05, -0.05, 0.05, 0.05)], "g long, " + ", ".join(f"{n} double" for n in names))
    spots = [(0, 0.0, 0.0), (1, float("nan"), 0.0), (2, 0.05, 0.05), (3, -0.05, 0.0), (4, 0.01, -0.049), (5, None, 0.0)]
    found = rect_join(spark.createDataFrame(spots, "p long, lon double, lat double"), rects)
    assert rows(found, "p") == [(0,), (2,), (4,)]
    assert "_inside" in plan_of(found)
