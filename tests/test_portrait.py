import json

import pytest
from pyspark.sql import functions as F

from airway.operators.hours import HourRange
from airway.plans import portrait
from airway.sources import scans, staging
from tests.helpers import rows

HOURLY = {
    "congestion": "grid_center_coord string, data string, published_at string",
    "weather": "grid_center_coord string, data string, published_at string",
    "station_weather": "station_name string, station_coord string, data string, published_at string",
    "dust": "grid_id int, slag_truck_coords string, published_at string",
    "cells": "id int, center_coord string",
    "earthwork": "grid_id int, truck_num int, published_at string",
    "road_flow": "edge_id int, driving_direction int, data string, published_at string",
    "section_feature": "edge_id int, driving_direction int, road_congested_section_id int",
    "road_division": "id int, roadname string, section_gcj02_json string",
    "forecast": "forecast_date string, published_at string, diffusion_conditions string",
}
HERE = '{"lon": 104.0, "lat": 30.0}'
NEAR = '{"lon": 104.01, "lat": 30.0}'
FAR = '{"lon": 105.0, "lat": 30.0}'
H8 = "2024-01-01 08:00:00"
ONE_HOUR = HourRange(H8, H8)


def tables(spark, **data):
    stations = [
        (1, "a", "A", "city", HERE),
        (1, "a", "A", "city", HERE),
        (1, "twin", "T", "nation", HERE),
        (None, "b", "B", "city", HERE),
        (2, "c", "C", "county", HERE),
    ]
    schema = "grid_id int, station_code string, station_name string, station_level string, coord string"
    gps = data.pop("gps", [])
    gps_schema = "plate_num string, sim_card string, coord string, speed int, published_at string"
    frames = {name: spark.createDataFrame(data.get(name, []), columns) for name, columns in HOURLY.items()}
    return portrait.PortraitTables(
        stations=spark.createDataFrame(stations, schema), gps=spark.createDataFrame(gps, gps_schema), **frames
    )


def result(spark, hours=ONE_HOUR, **data):
    found = portrait.station_portrait(tables(spark, **data), hours)
    return [(r[1], r[4], json.loads(r[3])) for r in rows(found)]


def test_empty_inputs_give_zeros_and_no_other_members(spark):
    empty = {"wind_speed": 0.0, "diffusion_conditions": 0}
    assert result(spark) == [("a", H8, empty), ("twin", H8, empty)]


def test_all_features(spark):
    got = result(
        spark,
        gps=[
            ("p", "s", HERE, 5, "2024-01-01 08:00:00"),
            ("p", "s", NEAR, 5, "2024-01-01 08:59:59"),
            ("p", None, NEAR, 5, "2024-01-01 08:30:00"),
            ("q", "s", FAR, 5, "2024-01-01 08:30:00"),
            ("q", "s", HERE, 0, "2024-01-01 08:30:00"),
            ("q", "s", HERE, 5, "2024-01-01 09:00:00"),
        ],
        congestion=[(NEAR, '{"index": 1.5}', H8), (HERE, '{"index": "2"}', H8), (HERE, '{"index": "bad"}', H8), (FAR, '{"index": 9}', H8)],
        weather=[(NEAR, '{"rainfall": 1, "humidity": 50.005}', H8), (NEAR, '{"rainfall": 2}', "2024-01-01 09:00:00")],
        station_weather=[
            ("成都", FAR, '{"wind_speed": 2}', H8),
            ("温江", HERE, '{"wind_speed": 50}', H8),
            ("elsewhere", NEAR, '{"wind_speed": 99}', H8),
        ],
        cells=[(7, NEAR), (8, FAR), (None, HERE)],
        dust=[(7, "[[1.6, 5],[2.4, 5]]", H8), (7, "[[x, 1]]", H8), (7, "[]", H8), (8, "[[100, 1]]", H8), (7, None, H8)],
        earthwork=[(7, 3, H8), (7, 4, H8), (8, 100, H8)],
        road_flow=[(1, 0, '{"large": 3, "unknown": 4}', H8), (1, 0, '{"large": 1}', H8), (2, 0, '{"small": 5}', H8), (3, 1, '{"middle": 8}', H8)],
        section_feature=[(1, 0, 11), (2, 0, 12), (3, 1, 13)],
        road_division=[
            (11, "ring", "[[104.0, 30.0],[104.01,30.0]]"),
            (12, "ring", "[[104.0, 30.0],[105.0,30.0]]"),
            (13, "lane", "[[104.01, 30.0]]"),
        ],
        forecast=[
            ("2024-01-01", "2023-12-31 20:00:00", "9-x"),
            ("2024-01-01", "2024-01-01 06:00:00", "3-x"),
            ("2024-01-02", "2024-01-01 07:00:00", "7-x"),
        ],
    )
    want = {
        "truck_num": 1,
        "truck_trajectory": 3,
        "traffic_flow": 14,  # ring: mean of 7 and 5, lane: 8
        "traffic_index": 1.75,
        "rainfall": 1.0,
        "humidity": 50.01,
        "dust_index": 4,
        "wind_speed": 2.0,  # the site at the station itself has no weight
        "diffusion_conditions": 3,
        "earth_num": 7,
    }
    assert got == [("a", H8, want), ("twin", H8, want)]
    assert list(got[0][2]) == [f for f in portrait.FEATURES if f in want]


def test_look_ahead_publishes_later(spark):
    hours = HourRange(H8, H8, ahead=2, span=2)
    gps = [("p", "s", HERE, 5, "2024-01-01 08:10:00"), ("q", "s", HERE, 5, "2024-01-01 09:10:00")]
    [(_, at, data), _] = result(spark, hours, gps=gps)
    assert (at, data["truck_num"]) == ("2024-01-01 10:00:00", 2)


def test_backfill_writes_only_hours_that_differ(spark):
    path = staging.staging_path(spark, "portraits")
    hours = HourRange(H8, "2024-01-02 08:00:00")
    gps = [("p", "s", HERE, 5, "2024-01-01 08:10:00")]

    def files():
        found = scans.read_partitioned(spark, path).select("publish_date", "_metadata.file_path").distinct()
        return {(r[0], r[1]) for r in found.collect()}

    portrait.backfill_partitions(tables(spark, gps=gps), hours, path)
    first = files()
    assert {day for day, _ in first} == {"2024-01-01", "2024-01-02"}
    portrait.backfill_partitions(tables(spark, gps=gps), hours, path)
    assert files() == first
    late = [*gps, ("q", "s", HERE, 5, "2024-01-02 07:00:00")]
    portrait.backfill_partitions(tables(spark, gps=late), hours, path)
    assert {day for day, _ in files() - first} == {"2024-01-02"}
    stored = scans.read_partitioned(spark, path)
    assert stored.count() == 50 and stored.where(F.col("data").contains("truck_num")).count() == 4


@pytest.mark.parametrize("broadcast", [True, False])
def test_backfill_run_is_stable(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    t = tables(spark, gps=[("p", "s", HERE, 5, "2024-01-01 08:10:00")])
    first = portrait.station_portrait(t, ONE_HOUR)
    again = portrait.run_backfill(t, ONE_HOUR, first)
    assert rows(again) == rows(first)
    emptied = first.where("station_code = 'a'")
    assert rows(portrait.run_backfill(t, ONE_HOUR, emptied)) == rows(first)
