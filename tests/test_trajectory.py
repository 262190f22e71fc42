import random
from datetime import datetime, timedelta

import pytest

from airway.operators.trajectory import boundaries, neighbours, stays
from tests.helpers import rows

START = datetime(2024, 1, 1)


def track(seed, n=400, vehicles=3):
    rng = random.Random(seed)
    out, place = [], 1
    for i in range(n):
        if rng.random() < 0.3:
            place = rng.choice([None, 1, 2, 3])
        # A third of the rows belong to one vehicle; gaps skip whole chunks.
        vehicle = "hot" if rng.random() < 0.34 else f"v{rng.randrange(vehicles)}"
        out.append((vehicle, START + timedelta(seconds=i * 40 + (7200 if i > n // 2 else 0)), i, place))
    return out


def brute_stays(data):
    result = []
    for vehicle in sorted({r[0] for r in data}):
        run = None
        for _, at, _, place in sorted((r for r in data if r[0] == vehicle), key=lambda r: (r[1], r[2])):
            if run and run[1] == place:
                run = (vehicle, place, run[2], at, run[4] + 1)
                result[-1] = run
            else:
                run = (vehicle, place, at, at, 1)
                result.append(run)
    return sorted(result, key=repr)


SCHEMA = "car string, at timestamp_ntz, seq long, place int"


@pytest.mark.parametrize("chunk", [30, 600, 3600, 10**7])
def test_stays_do_not_depend_on_chunks(spark, chunk):
    data = track(1)
    found = stays(spark.createDataFrame(data, SCHEMA), "car", "at", "place", ["seq"], chunk)
    assert rows(found, "car", "place", "at_in", "at_out", "points") == brute_stays(data)


@pytest.mark.parametrize("chunk", [30, 900, 10**7])
def test_neighbours_do_not_depend_on_chunks(spark, chunk):
    data = track(2)
    found = neighbours(spark.createDataFrame(data, SCHEMA), "car", "at", "place", ["seq"], chunk)
    want = []
    for vehicle in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == vehicle), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            before = mine[i - 1][3] if i else None
            after = mine[i + 1][3] if i + 1 < len(mine) else None
            want.append((r[2], before, after))
    assert rows(found, "seq", "place_lag", "place_lead") == sorted(want, key=repr)


@pytest.mark.parametrize("chunk", [30, 3600])
def test_boundaries_are_the_ends_of_stays(spark, chunk):
    data = track(4)
    found = boundaries(spark.createDataFrame(data, SCHEMA), "car", "at", "place", ["seq"], chunk)
    stays_of = brute_stays(data)
    assert rows(found.where("enters"), "car", "place", "at") == sorted(((s[0], s[1], s[2]) for s in stays_of), key=repr)
    assert rows(found.where("leaves"), "car", "place", "at") == sorted(((s[0], s[1], s[3]) for s in stays_of), key=repr)


def test_single_point_enters_and_leaves(spark):
    df = spark.createDataFrame([("a", START, 1, 0), (None, START, 2, 0), ("b", None, 3, 0)], SCHEMA)
    assert rows(boundaries(df, "car", "at", "place"), "car", "enters", "leaves") == [("a", True, True)]
    assert rows(stays(df, "car", "at", "place"), "car", "place", "points") == [("a", 0, 1)]


def test_every_point_is_in_one_stay(spark):
    data = track(3, n=500)
    found = stays(spark.createDataFrame(data, SCHEMA), "car", "at", "place", ["seq"], 500)
    assert sum(r["points"] for r in found.collect()) == len(data)


def test_clock_change_of_the_session_zone_does_not_matter(spark):
    """Times around a spring gap, in chunks shorter than the gap."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = datetime(2024, 3, 10, 0, 30)
        data = [("a", start + timedelta(minutes=10 * i), i, i // 4 % 3) for i in range(40)]
        found = stays(spark.createDataFrame(data, SCHEMA), "car", "at", "place", ["seq"], 600)
        assert rows(found, "car", "place", "at_in", "at_out", "points") == brute_stays(data)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_as_text(spark):
    data = [("a", str(START + timedelta(seconds=i)), 7) for i in range(5)] + [("a", "never", 7)]
    found = stays(spark.createDataFrame(data, "car string, at string, place int"), "car", "at", "place", chunk_seconds=2)
    assert rows(found, "points") == [(5,)]
