"""Hourly station portraits: eleven features around each station as one JSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airway.functions.records import json_columns, json_sum, pair_item, pair_texts
from airway.functions.times import HOUR_START, leading_digit
from airway.operators import tiles
from airway.operators.cleaning import one_per_key
from airway.operators.hours import HourRange, into_slots
from airway.operators.joining import lookup_join
from airway.operators.merging import (
    assemble,
    difference,
    explode_payload,
    latest_value,
    same_key,
    upsert,
)
from airway.operators.spatial import RADIUS_M, SITE, by_tiles, idw_over_time, radius_join, site_totals, sites_of, spread_to_centers
from airway.sources.scans import HOUR_KEYS, in_hours, slot_text, stored_or_none
from airway.sources.sinks import upsert_partitions
from airway.sources.staging import Work, staged

# Station levels with a portrait, the wind sites, and the features
# in the order they are written.
LEVELS = ["nation", "province", "city"]
WIND_SITES = ["成都", "金牛", "青羊", "武侯", "锦江", "成华", "新都", "青白江", "郫都", "温江", "双流", "龙泉驿"]
VEHICLE_CLASSES = ["large", "middle", "small", "unknown"]
FEATURES = [
    "truck_num", "truck_trajectory", "traffic_flow", "traffic_index", "rainfall", "humidity",
    "solar_radiation", "dust_index", "wind_speed", "diffusion_conditions", "earth_num",
]

STATION_KEYS = ["grid_id", "station_code", "station_name"]
KEYS = [*STATION_KEYS, "published_at"]
# Vertices of a road section, as many as its join must have room for.
VERTICES = 8
SITE_KEYS = [*SITE, "published_at"]


@dataclass
class PortraitTables:
    """Input tables. ``gps`` has lon, lat, speed and either a time column
    ``published_at`` or the partition columns ``publish_date`` and ``hour``."""

    stations: DataFrame
    gps: DataFrame
    congestion: DataFrame
    weather: DataFrame
    station_weather: DataFrame
    dust: DataFrame
    cells: DataFrame
    earthwork: DataFrame
    road_flow: DataFrame
    section_feature: DataFrame
    road_division: DataFrame
    forecast: DataFrame


def at_point(df: DataFrame, coord: str) -> DataFrame:
    """Replace a JSON coordinate by double ``lon`` and ``lat``."""
    return json_columns(df, coord, {"lon": "lon", "lat": "lat"})


def stations_without_position(stations: DataFrame, levels: list[str] = LEVELS) -> DataFrame:
    """The stations of the levels that get no portrait, for want of a readable position."""
    known = portrait_stations(stations, levels)
    return known.where(F.col("lon").isNull() | F.col("lat").isNull()).select(*STATION_KEYS)


def portrait_stations(stations: DataFrame, levels: list[str] = LEVELS) -> DataFrame:
    """One row per station key with its position; stations without a grid cell are left
    out. Nothing is near a station without position: it gets no portrait and is named by
    :func:`stations_without_position`."""
    chosen = stations.where(F.col("grid_id").isNotNull() & F.col("station_level").isin(levels))
    return one_per_key(at_point(chosen.select(*STATION_KEYS, "coord"), "coord"), STATION_KEYS)


def gps_in_slots(gps: DataFrame, hours: HourRange) -> DataFrame:
    """Moving vehicles per publication hour of the time column."""
    moving = gps.where(F.col("speed") > 0)
    points = at_point(moving, "coord") if "coord" in moving.columns else moving
    return into_slots(points, "published_at", hours, "slot").select(
        "plate_num", "sim_card", "lon", "lat", F.col("slot").alias("published_at")
    )


def gps_from_partitions(gps: DataFrame, hours: HourRange, wanted: DataFrame | None = None) -> DataFrame:
    """Moving vehicles of the date/hour partitions of each publication hour, one
    row per vehicle and moment. ``wanted`` (``publish_date, hour``) narrows the hours by
    data: partitions that it lacks are pruned at run time."""
    moving = in_hours(gps, *hours.published).where(F.col("speed") > 0)
    if wanted is not None:
        moving = lookup_join(moving, wanted, list(HOUR_KEYS), "left_semi")
    columns = ["plate_num", "up_time", "publish_date", "hour", "sim_card", "lon", "lat"]
    single = one_per_key(moving.select(*columns), columns[:4])
    return single.select(
        "plate_num",
        "sim_card",
        F.col("lon").try_cast("double").alias("lon"),
        F.col("lat").try_cast("double").alias("lat"),
        F.to_timestamp(slot_text(), "yyyy-MM-dd HH").alias("published_at"),
    )


def _hourly(df: DataFrame, hours: HourRange) -> DataFrame:
    return df.where(hours.is_published("published_at")).withColumn(
        "published_at", F.col("published_at").cast("timestamp")
    )


def truck_features(points: DataFrame, sites: DataFrame, radius_m: float = RADIUS_M) -> DataFrame:
    """Distinct vehicles (plate and card known) and track points around each location."""
    vehicles = ("truck_num", ["plate_num", "sim_card"])
    found = site_totals(points, sites, {"truck_trajectory": F.lit(1)}, ["published_at"], radius_m, distinct=vehicles)
    return found.select(*SITE_KEYS, "truck_num", "truck_trajectory")


def mean_totals(points: DataFrame, sites: DataFrame, names: dict[str, str], kind: str) -> DataFrame:
    """Hourly means around each location, each as a ``kind``: ``names`` gives the column
    averaged for each result."""
    sums = {f"_sum_{n}": F.col(c) for n, c in names.items()}
    counts = {f"_n_{n}": F.col(c).isNotNull().cast("long") for n, c in names.items()}
    totals = site_totals(points, sites, sums | counts, ["published_at"])
    means = [F.try_divide(f"_sum_{n}", f"_n_{n}").try_cast(kind).alias(n) for n in names]
    return totals.select(*SITE_KEYS, *means)


def traffic_index(congestion: DataFrame, sites: DataFrame, hours: HourRange) -> DataFrame:
    points = json_columns(at_point(_hourly(congestion, hours), "grid_center_coord"), "data", {"index": "index"})
    return mean_totals(points, sites, {"traffic_index": "index"}, "decimal(10,6)")


def weather_features(weather: DataFrame, sites: DataFrame, hours: HourRange) -> DataFrame:
    names = ["rainfall", "humidity", "solar_radiation"]
    points = json_columns(at_point(_hourly(weather, hours), "grid_center_coord"), "data", {n: n for n in names})
    return mean_totals(points, sites, {n: n for n in names}, "decimal(8,2)")


def cell_centres(cells: DataFrame) -> DataFrame:
    """``grid_id, lon, lat`` of the grid cells."""
    centres = at_point(cells.select("id", "center_coord"), "center_coord").where(F.col("id").isNotNull())
    return centres.withColumnRenamed("id", "grid_id")


def cell_sites(cells: DataFrame, sites: DataFrame, radius_m: float = RADIUS_M) -> DataFrame:
    """Which locations each grid cell centre is near, with all columns of ``sites``. The hourly
    features do without these pairs, which are many times the cells."""
    of_site = {c: f"_site_{c}" for c in sites.columns if c not in SITE}
    pairs = radius_join(cell_centres(cells), sites.withColumnsRenamed(of_site), radius_m)
    return pairs.select("grid_id", *[F.col(of_site.get(c, c)).alias(c) for c in sites.columns])


def _per_cell_totals(per_cell: DataFrame, cells: DataFrame, sites: DataFrame, name: str) -> DataFrame:
    """Hourly sums over the cells around each location."""
    placed = lookup_join(per_cell, cell_centres(cells), "grid_id", as_read=True)
    return site_totals(placed, sites, {name: F.col(name)}, ["published_at"])


def dust_per_cell(dust: DataFrame) -> DataFrame:
    """Sum of the rounded first members of each cell's list, per hour."""
    listed = dust.select("grid_id", "published_at", F.explode(pair_texts("slag_truck_coords")).alias("_pair"))
    return listed.groupBy("grid_id", "published_at").agg(F.sum(F.round(pair_item(F.col("_pair"), 0))).alias("dust"))


def dust_feature(dust: DataFrame, cells: DataFrame, sites: DataFrame, hours: HourRange) -> DataFrame:
    totals = _per_cell_totals(dust_per_cell(_hourly(dust, hours)), cells, sites, "dust")
    return totals.select(*SITE_KEYS, F.col("dust").try_cast("int").alias("dust_index"))


def earth_feature(earthwork: DataFrame, cells: DataFrame, sites: DataFrame, hours: HourRange) -> DataFrame:
    rows = _hourly(earthwork, hours).select("grid_id", "truck_num", "published_at")
    per_cell = rows.groupBy("grid_id", "published_at").agg(F.sum("truck_num").alias("earth_num"))
    return _per_cell_totals(per_cell, cells, sites, "earth_num")


def section_vertices(road_division: DataFrame) -> DataFrame:
    """One row per vertex of each road section."""
    pair = F.col("_pair")
    return road_division.select(
        "id", "roadname", F.explode(pair_texts("section_gcj02_json")).alias("_pair")
    ).select("id", "roadname", pair_item(pair, 0).alias("lon"), pair_item(pair, 1).alias("lat"))


def flow_feature(
    road_flow: DataFrame,
    section_feature: DataFrame,
    road_division: DataFrame,
    sites: DataFrame,
    hours: HourRange,
    radius_m: float = RADIUS_M,
) -> DataFrame:
    """Greatest flow per section, mean per road name, summed per location over the
    sections with a vertex near it.

    The greatest flow of a section does not depend on which of its vertices is
    near, so it is taken per section and hour before any location is met. The
    sum is rounded to 1e-6 before it is cut to an integer, so that the order of
    addition cannot change the result."""
    flows = _hourly(road_flow, hours).withColumn("flow", json_sum("data", VEHICLE_CLASSES))
    edges = section_feature.select("edge_id", "driving_direction", F.col("road_congested_section_id").alias("id"))
    per_section = (
        lookup_join(flows, edges, ["edge_id", "driving_direction"], as_read=True)
        .groupBy("id", "published_at")
        .agg(F.max("flow").alias("flow"))
    )
    points = lookup_join(per_section, section_vertices(road_division), "id", copies=VERTICES, as_read=True)
    points = points.select("published_at", "id", "roadname", "flow", "lon", "lat")

    def make(schema):
        return tiles.sums_of_means(["published_at"], ["roadname"], ["id"], "flow", radius_m, schema)

    found = by_tiles(points, sites, ["published_at"], ["published_at"], make, [T.StructField("flow", T.DoubleType())], radius_m)
    return found.select(*SITE_KEYS, F.round("flow", 6).try_cast("int").alias("traffic_flow"))


def wind_feature(
    station_weather: DataFrame,
    sites: DataFrame,
    hours: HourRange,
    names: list[str] | None = None,
    work: Work | None = None,
) -> DataFrame:
    """Distance-weighted wind at each location and hour; 0 without data."""
    rows = _hourly(station_weather, hours).where(F.col("station_name").isin(names or WIND_SITES))
    samples = json_columns(at_point(rows, "station_coord"), "data", {"wind_speed": "wind_speed"})
    return idw_over_time(sites, hours.slots(), samples, "published_at", "wind_speed", work=work)


def daily_diffusion(forecast: DataFrame, day: str = "forecast_date") -> DataFrame:
    """Leading character of the latest forecast of each day."""
    digit = F.substring("diffusion_conditions", 1, 1)
    return latest_value(forecast, day, "published_at", digit, "diffusion")


def site_features(
    t: PortraitTables,
    stations: DataFrame,
    hours: HourRange,
    wind_sites: list[str] | None = None,
    work: Work | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """All eleven feature columns per station location and publication hour."""
    sites = sites_of(stations)
    from_partitions = "publish_date" in t.gps.columns
    points = gps_from_partitions(t.gps, hours, wanted) if from_partitions else gps_in_slots(t.gps, hours)
    joined = assemble(
        [
            truck_features(points, sites),
            flow_feature(t.road_flow, t.section_feature, t.road_division, sites, hours),
            traffic_index(t.congestion, sites, hours),
            weather_features(t.weather, sites, hours),
            dust_feature(t.dust, t.cells, sites, hours),
            wind_feature(t.station_weather, sites, hours, wind_sites, work),
            earth_feature(t.earthwork, t.cells, sites, hours),
        ],
        SITE_KEYS,
    )
    joined = joined.withColumn("_day", F.date_format("published_at", "yyyy-MM-dd"))
    first, last = hours.published
    day = F.substring(F.col("forecast_date").cast("string"), 1, 10)
    wanted = t.forecast.withColumn("_day", day).where(F.col("_day").between(first[:10], last[:10]))
    diffusion = leading_digit(F.coalesce("diffusion", F.lit("0")))
    return lookup_join(joined, daily_diffusion(wanted, "_day"), "_day", "left").withColumn(
        "diffusion_conditions", diffusion
    )


def feature_json() -> Column:
    return F.to_json(F.struct(*FEATURES), {"ignoreNullFields": "true"})


def station_portrait(
    t: PortraitTables,
    hours: HourRange,
    levels: list[str] = LEVELS,
    wind_sites: list[str] | None = None,
    work: Work | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """``grid_id, station_code, station_name, data, published_at`` for every
    station and hour of the range, in one job. ``wanted`` (``publish_date, hour`` as text)
    narrows the publication hours to those of a small table.

    Features are computed and written as JSON per location; stations that share
    one are told apart only at the end. Three small tables are staged while the frame is
    built; ``work`` (else the session) owns them."""
    stations = staged(portrait_stations(t.stations, levels), "stations", work)
    features = site_features(t, stations, hours, wind_sites, work, wanted)
    if wanted is not None:
        of_hour = [F.date_format("published_at", "yyyy-MM-dd"), F.date_format("published_at", "HH")]
        features = features.withColumns(dict(zip(HOUR_KEYS, of_hour, strict=True)))
        features = lookup_join(features, wanted, list(HOUR_KEYS), "left_semi")
    per_site = features.select(
        *SITE, feature_json().alias("data"), F.date_format("published_at", HOUR_START).alias("published_at")
    )
    return spread_to_centers(per_site, stations, STATION_KEYS)


def portrait_diff(new: DataFrame, stored: DataFrame, work: Work | None = None) -> DataFrame:
    """Feature values of ``new`` that ``stored`` lacks or has otherwise.

    Digests of whole portraits are compared first. Only stations and hours with a portrait
    whose digest is not stored have their members taken apart; which these are is staged, as
    both sides are narrowed to them."""
    keep = ["published_at", "station_code", "station_name"]

    def digests(df: DataFrame) -> DataFrame:
        return df.select(*keep, F.sha2("data", 256).alias("_digest"))

    other = difference(digests(new), digests(stored)).select(*[F.col(k).alias(f"_other_{k}") for k in keep]).distinct()
    other = staged(other, "differing", work)
    same = same_key(keep, "_other_")
    left, right = (lookup_join(df, other, same, "left_semi", as_read=True) for df in (new, stored))
    return difference(explode_payload(left, keep), explode_payload(right, keep))


def run_backfill(t: PortraitTables, hours: HourRange, stored: DataFrame, **options) -> DataFrame:
    """Compute the portraits of the hours once, then :func:`backfill`."""
    return backfill(staged(station_portrait(t, hours, **options), "portrait"), stored)


def backfill_partitions(t: PortraitTables, hours: HourRange, path: str, **options) -> None:
    """Compute the portraits of the hours and rewrite, in a dataset partitioned by
    ``publish_date``, those of the hours that differ from what is stored."""
    day = F.substring("published_at", 1, 10).alias("publish_date")
    with Work(t.stations.sparkSession) as work:
        new = staged(station_portrait(t, hours, work=work, **options).select("*", day), "portrait", work)
        stored = stored_or_none(new.sparkSession, path)
        if stored is not None:
            first, last = hours.published
            known = stored.where(F.col("publish_date").between(first[:10], last[:10]) & F.col("published_at").between(first, last))
            changed = portrait_diff(new, known, work).select("published_at").distinct()
            new = lookup_join(new, staged(changed, "changed", work), "published_at", "left_semi")
        upsert_partitions(new, path, KEYS, ("publish_date",))


def fill_missing_hours(t: PortraitTables, hours: HourRange, path: str, **options) -> int:
    """Compute the portraits of the hours that have none in a dataset partitioned by
    ``publish_date`` and add them; returns how many hours. The hours are found from the
    data, so partitions of the tracks are pruned by them at run time."""
    spark = t.stations.sparkSession
    with Work(spark) as work:
        slots = spark.range(1).select(F.explode(hours.slots()).alias("published_at"))
        slots = slots.withColumn("published_at", F.date_format("published_at", HOUR_START))
        stored = stored_or_none(spark, path)
        if stored is not None:
            first, last = hours.published
            known = stored.where(F.col("publish_date").between(first[:10], last[:10])).select("published_at").distinct()
            slots = slots.join(known, "published_at", "left_anti")
        parts = F.substring("published_at", 1, 10), F.substring("published_at", 12, 2)
        wanted = work.stage(slots.select(*[c.alias(k) for c, k in zip(parts, HOUR_KEYS, strict=True)]), "wanted")
        n = wanted.count()
        if n:
            new = station_portrait(t, hours, work=work, wanted=wanted, **options)
            upsert_partitions(new.withColumn("publish_date", F.substring("published_at", 1, 10)), path, KEYS, ("publish_date",))
    return n


def backfill(new: DataFrame, stored: DataFrame) -> DataFrame:
    """``stored`` after replacing every hour that has a difference by ``new``."""
    changed = portrait_diff(new, stored).select("published_at").distinct()
    replacing = lookup_join(new, changed, "published_at", "left_semi")
    return upsert(replacing, stored, KEYS)
