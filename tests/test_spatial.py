import random

import pytest
from pyspark.sql import functions as F

from airway.functions.geo import haversine_m, wgs84_to_gcj02
from airway.operators.spatial import SITE, CellGrid, covering_cells, idw, radius_join, radius_summary, rect_join, site_summary, site_totals
from tests.helpers import metres, plan_of, rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def brute_pairs(points, centers, radius):
    return sorted(
        (p, c) for p, px, py in points for c, cx, cy in centers if metres(px, py, cx, cy) < radius
    )


REGIONS = {
    "city": ((103.9, 104.3), (30.5, 30.9), 5000),
    "antimeridian": ((179.9, 180.1), (-17.1, -16.9), 5000),
    "far north": ((10.0, 14.0), (84.9, 85.3), 9000),
    "pole": ((-180.0, 180.0), (89.93, 90.0), 6000),
}


@pytest.mark.parametrize("region", REGIONS)
@pytest.mark.parametrize("broadcast", [True, False])
def test_radius_join_equals_all_pairs(spark, request, region, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    (west, east), (south, north), radius = REGIONS[region]
    rng = random.Random(7)

    def place():
        lon = rng.uniform(west, east)
        return (lon - 360 if lon > 180 else lon), rng.uniform(south, north)

    points = [(i, *place()) for i in range(300)]
    centers = [(i, *place()) for i in range(40)]
    found = radius_join(
        frame(spark, points, "p long, lon double, lat double"),
        frame(spark, centers, "c long, center_lon double, center_lat double"),
        radius,
    )
    got = rows(found, "p", "c")
    want = brute_pairs(points, centers, radius)
    assert want and got == sorted(want, key=repr)


def test_cells_per_center_are_bounded_up_to_the_pole(spark):
    """The bound that the broadcast check relies on."""
    latitudes = [i / 2 for i in range(179)] + [89.5 + i * 0.005 for i in range(101)]
    centers = frame(spark, [(i, 10.123, y) for i, y in enumerate(latitudes)], "i int, x double, y double")
    cells = covering_cells(centers, CellGrid(5000 / 4), 5000, "x", "y")
    counts = cells.groupBy("i").agg(F.count("*").alias("n"), F.count_distinct("_cell").alias("d"))
    assert counts.where("n <> d").isEmpty()
    assert counts.agg(F.max("n")).first()[0] <= 3 * (2 * 4 + 2) ** 2


def test_radius_is_strict_in_whole_metres(spark):
    # 5000 m and 4999 m north of the center, and null coordinates.
    degree = 3.141592653589793 * 6371393 / 180
    points = [(1, 104.0, 30.0 + 5000.5 / degree), (2, 104.0, 30.0 + 4999.5 / degree), (3, None, 30.0)]
    found = radius_join(
        frame(spark, points, "p long, lon double, lat double"),
        frame(spark, [(1, 104.0, 30.0), (2, None, None)], "c long, center_lon double, center_lat double"),
    )
    assert rows(found, "p", "c") == [(2, 1)]


def test_shared_column_names_are_refused(spark):
    df = frame(spark, [(1, 1.0, 1.0)], "id long, lon double, lat double")
    with pytest.raises(ValueError):
        radius_join(df, df)


def test_centers_at_one_spot_all_get_the_result(spark):
    centers = frame(spark, [(i, 104.0, 30.0) for i in range(5)], "k long, lon double, lat double")
    points = frame(spark, [(i % 3, 104.0, 30.01) for i in range(9)], "v long, lon double, lat double")
    found = radius_summary(points, centers, ["k"], [F.count("*").alias("n"), F.count_distinct("v").alias("d")])
    assert rows(found, "k", "n", "d") == [(i, 9, 3) for i in range(5)]


def test_hot_cell_without_broadcast(spark, no_broadcast):
    """A third of the points share one spot."""
    points = spark.range(3000).select(
        F.col("id").alias("p"),
        F.when(F.col("id") % 3 == 0, 104.0).otherwise(103.9 + F.col("id") * 0.0001).alias("lon"),
        F.lit(30.0).alias("lat"),
    )
    centers = frame(spark, [(1, 104.0, 30.0), (2, 104.1, 30.0)], "c long, center_lon double, center_lat double")
    found = radius_join(points, centers)
    naive = points.join(centers, haversine_m("lon", "lat", "center_lon", "center_lat") < 5000)
    assert rows(found.groupBy("c").count()) == rows(naive.groupBy("c").count())


def test_hot_key_is_split_over_tasks(spark, no_broadcast):
    """Beyond the broadcast bound adaptive execution splits the hot cell."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        points = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("p"),
            F.when(F.col("id") % 3 == 0, 104.0).otherwise(60.0 + F.col("id") * 0.001).alias("lon"),
            F.lit(30.0).alias("lat"),
        )
        centers = frame(spark, [(i, 60.0 + i, 30.0) for i in range(50)], "c long, center_lon double, center_lat double")
        found = radius_join(points, centers)
        # 20000 points at the hot spot, the others within 5 km of a center each degree.
        assert found.where("c = 44").count() >= 20000
        found.write.format("noop").mode("overwrite").save()
        assert len(found.collect()) == found.count()
        assert "skewed" in plan_of(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_joins_are_equi_joins(spark, no_broadcast):
    points = frame(spark, [(1, 104.0, 30.0)], "p long, lon double, lat double")
    centers = frame(spark, [(1, 104.0, 30.0)], "c long, center_lon double, center_lat double")
    plan = plan_of(radius_join(points, centers))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


RECT = "g long, bottom_left_lon double, bottom_left_lat double, top_right_lon double, top_right_lat double"


def test_rectangle_edges(spark):
    rects = frame(spark, [(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0), (3, 5.0, 5.0, 5.0, 6.0)], RECT)
    points = [(1, 0.0, 0.5), (2, 1.0, 0.5), (3, 0.5, 0.0), (4, 0.5, 1.0), (5, 2.0, 1.0), (6, None, 0.5), (7, 5.0, 5.5)]
    found = rect_join(frame(spark, points, "p long, lon double, lat double"), rects)
    assert rows(found, "p", "g") == [(2, 1), (4, 1), (5, 2)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_rectangles_of_all_sizes(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(3)
    rects = []
    for i in range(60):
        x, y = rng.uniform(-2, 2), rng.uniform(-2, 2)
        rects.append((i, x, y, x + 2 ** rng.uniform(-10, 1), y + 2 ** rng.uniform(-10, 1)))
    points = [(i, rng.uniform(-2, 3), rng.uniform(-2, 3)) for i in range(400)]
    found = rect_join(frame(spark, points, "p long, lon double, lat double"), frame(spark, rects, RECT))
    want = [(p, g) for p, x, y in points for g, w, s, e, n in rects if w < x <= e and s < y <= n]
    assert want and rows(found, "p", "g") == sorted(want, key=repr)


def test_weighted_mean(spark):
    centers = frame(
        spark, [("a", 104.0, 30.0, 1), ("b", 104.1, 30.0, 1), ("a", 104.0, 30.0, 2)], "k string, lon double, lat double, h int"
    )
    samples = frame(
        spark,
        [(104.0, 30.0, 50.0, 1), (104.05, 30.0, 2.0, 1), (104.2, 30.0, 8.0, 1), (104.2, 30.0, None, 1)],
        "lon double, lat double, v double, h int",
    )

    def mean(lon):
        near = [(x, v) for x, v in [(104.0, 50.0), (104.05, 2.0), (104.2, 8.0), (104.2, 0.0)]]
        weights = [(v, metres(x, 30.0, lon, 30.0)) for x, v in near]
        weights = [(v, 1 / d**2) for v, d in weights if d]
        return round(sum(v * w for v, w in weights) / sum(w for _, w in weights), 2)

    found = rows(idw(centers, samples, ["h"], ["k"], "v"), "k", "h", "v")
    assert found == [("a", 1, mean(104.0)), ("a", 2, 0.0), ("b", 1, mean(104.1))]


def test_gcj_shift_leaves_outside_points(spark):
    df = frame(spark, [(2.35, 48.85), (104.06, 30.67)], "lon double, lat double")
    lon, lat = wgs84_to_gcj02("lon", "lat")
    got = rows(df.select(F.round(lon, 4).alias("x"), F.round(lat, 4).alias("y")))
    assert (2.35, 48.85) in got
    # Published example values of the shift at this point.
    moved = [r for r in got if r[0] > 100][0]
    assert 0.001 < moved[0] - 104.06 < 0.005 and -0.005 < moved[1] - 30.67 < 0


@pytest.mark.parametrize("region", REGIONS)
@pytest.mark.parametrize("cells_per_radius", [1, 8])
def test_totals_per_cell_equal_totals_of_pairs(spark, region, cells_per_radius):
    """Crowded points, null values, keys and positions; sums of whole numbers are exact."""
    (west, east), (south, north), radius = REGIONS[region]
    rng = random.Random(11)

    def place():
        lon = rng.uniform(west, east)
        return (lon - 360 if lon > 180 else lon), rng.uniform(south, north)

    spots = [place() for _ in range(60)] + [(None, 1.0), (1.0, None)]
    points = [
        (*rng.choice(spots), rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.0, 5.0])) for _ in range(1500)
    ]
    df = frame(spark, points, "lon double, lat double, h string, v double")
    sites = frame(spark, [place() for _ in range(25)], "center_lon double, center_lat double")
    found = site_totals(df, sites, {"n": F.lit(1), "s": F.col("v")}, ["h"], radius, cells_per_radius)
    plain = site_summary(df, sites, [F.count("*").alias("n"), F.sum("v").alias("s")], ["h"], radius)
    columns = [*SITE, "h", "n", "s"]
    got = rows(found, *columns)
    assert got and got == rows(plain, *columns)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_cells_beyond_the_circle_are_left_out(spark):
    """A box around the circle has about 4k^2 cells, the circle reaches about pi k^2 of them."""
    k = 16
    centers = frame(spark, [(104.0, 30.0)], "x double, y double")
    cells = covering_cells(centers, CellGrid(5000 / k), 5000, "x", "y")
    assert 3.1 * k * k < cells.count() < 3.9 * k * k
