"""Vehicle tracks: grid entry and exit times, track import, window copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.functions.geo import six_decimals, wgs84_to_gcj02
from airway.functions.times import day_of_text, epoch_text
from airway.operators.cleaning import one_per_key, within
from airway.operators.spatial import rect_join
from airway.operators.trajectory import chunk_bounds, stays
from airway.sources.scans import HOUR_KEYS
from airway.sources.sinks import insert_missing


def grid_stays(stops: DataFrame, rects: DataFrame, start: str, end: str) -> DataFrame:
    """When each vehicle entered and left each grid rectangle.

    ``stops``: sim_card, lat, lon, published_at, published_at_raw. Copies are
    dropped first; the earliest raw time of a copy stays. A vehicle with very many stops
    in an hour is cut at bounds taken from the table itself, two columns of it."""
    seen = stops.where(within("published_at", start, end))
    bounds = chunk_bounds(seen, "sim_card", "published_at_raw")
    seen = one_per_key(seen, ["sim_card", "lat", "lon", "published_at"], ["published_at_raw"])
    placed = rect_join(seen.select("sim_card", "lat", "lon", "published_at_raw"), rects)
    return stays(placed, "sim_card", "published_at_raw", "grid_id", ["grid_id"], bounds=bounds).select(
        "sim_card",
        "grid_id",
        F.col("published_at_raw_in").alias("published_at_in"),
        F.col("published_at_raw_out").alias("published_at_out"),
    )


# Columns of the track table; inserts are positional.
TRACK = [
    "plate_num", "sim_card", "direction", "speed", "up_time", "raw_lon", "raw_lat", "lon", "lat",
    "publish_date", "hour",
]


def import_track(track: DataFrame, zone: str | None = None) -> DataFrame:
    """Raw track rows (point_x, point_y, epoch up_time) as track-table rows with
    shifted six-decimal coordinates and partition columns, on the clock of ``zone``."""
    single = one_per_key(track, ["plate_num", "up_time"]).withColumnsRenamed(
        {"point_x": "raw_lon", "point_y": "raw_lat"}
    )
    lon, lat = wgs84_to_gcj02("raw_lon", "raw_lat")
    stamp = epoch_text("up_time", zone)
    return single.withColumns(
        {
            "lon": six_decimals(lon),
            "lat": six_decimals(lat),
            "publish_date": day_of_text(stamp),
            "hour": F.substring(stamp, 12, 2),
        }
    ).select(*TRACK)


def import_into(track: DataFrame, table: str, zone: str | None = None) -> None:
    """:func:`import_track` into the partitioned track table. A vehicle's moment that the
    table has is not inserted again, so an import can be repeated or overlap another."""
    insert_missing(import_track(track, zone), table, TRACK, HOUR_KEYS, ["plate_num", "up_time"])


def window_import(table: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows of the half-open window with their day as partition column, last."""
    return table.where(within(time, start, end)).withColumn("publish_day", day_of_text(F.col(time).cast("string")))
