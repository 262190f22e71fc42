"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. With
``BENCH_NAIVE=1`` the plain forms of three operators are timed as well.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.checks import load_checks
from airway.checks.fixtures import FIRST_HOUR, LAST_HOUR, WIND_SITES, Fixtures
from airway.functions.geo import haversine_m
from airway.operators.hours import HourRange
from airway.operators.merging import assemble
from airway.operators.spatial import idw, radius_summary
from airway.plans import portrait
from airway.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "trucks_near_stations",
    "weather_near_stations",
    "road_flow_near_stations",
    "wind_at_stations",
    "points_in_rectangles",
    "station_portrait_hourly",
    "portrait_backfill",
    "stays_per_vehicle",
    "grid_entry_and_exit",
    "active_devices_filter_first",
    "diagnostics_flattened",
    "regional_feed",
    "first_row_per_key",
    "shifted_coordinates",
    "compacted_partitions",
]
PLACE = ["grid_id", "station_code", "station_name"]


def seconds(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def pairs_of_forms(fx: Fixtures) -> dict[str, tuple]:
    """Name -> (plain form, our form) of the same result."""
    sites, hours = fx.sites(), HourRange(FIRST_HOUR, LAST_HOUR)
    points = fx.events().where(F.col("value") > 10).select("user_id", "lon", "lat")
    counted = [F.count_distinct("user_id").alias("cars"), F.count("*").alias("n")]

    def naive_radius() -> DataFrame:
        centers = sites.withColumnsRenamed({"lon": "center_lon", "lat": "center_lat"})
        near = haversine_m("lon", "lat", "center_lon", "center_lat") < 5000
        return points.join(centers, near).groupBy(*PLACE).agg(*counted)

    slots = sites.withColumn("published_at", F.explode(hours.slots()))
    wind = portrait.json_columns(
        portrait.at_point(fx.station_weather().where(F.col("station_name").isin(WIND_SITES)), "station_coord"),
        "data",
        {"wind_speed": "wind_speed"},
    ).withColumn("published_at", F.to_timestamp("published_at"))

    def naive_wind() -> DataFrame:
        """One query per station; ten stations, as all of them would take hours."""
        first = [r["station_code"] for r in sites.select("station_code").limit(10).collect()]
        each = [idw(slots.where(F.col("station_code") == c), wind, ["published_at"], PLACE, "wind_speed") for c in first]
        for df in each[:-1]:
            df.write.format("noop").mode("overwrite").save()
        return each[-1]

    events = fx.events().select("user_id", "hour_at", "k", "value", "event_id")
    keys = ["user_id", "hour_at"]
    sets = [events.groupBy(*keys).agg(F.sum(F.col("k") + i).alias(f"f{i}")) for i in range(7)]
    return {
        "radius join": (naive_radius, lambda: radius_summary(points, sites, PLACE, counted)),
        "wind (plain: 10 stations only)": (naive_wind, lambda: idw(slots, wind, ["published_at"], PLACE, "wind_speed")),
        "feature assembly": (lambda: reduce(lambda a, b: a.join(b, keys, "full"), sets), lambda: assemble(sets, keys)),
    }


def main() -> None:
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    checks = load_checks()
    seconds(lambda: checks["moving_rows"].run(spark, SF_DIR))
    timed = {name: seconds(lambda n=name: checks[n].run(spark, SF_DIR)) for name in HEADLINE}
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_NAIVE") == "1":
        forms = pairs_of_forms(Fixtures(spark, SF_DIR))
        result["forms"] = {n: {"plain": seconds(plain), "ours": seconds(ours)} for n, (plain, ours) in forms.items()}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
