"""Station feeds normalised to one 19-column station-hour schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.functions.records import all_fields_json, restitch_csv
from airway.functions.times import day_of_text, dotnet_hour, iso_stamp, stamp_day
from airway.operators.cleaning import blank_marks, null_columns
from airway.operators.joining import lookup_join

# The station-hour columns. Inserts are positional, so the order counts.
STATION_HOUR = [
    "station_name", "coord", "no2", "o3", "pm2_5", "so2", "pm10", "aqi", "co", "grid_id",
    "station_code", "station_type", "published_at", "temperature", "humidity",
    "wind_direction", "wind_power", "pressure", "publish_date",
]
MEASURES = ["no2", "o3", "pm2_5", "so2", "pm10", "aqi", "co"]
WEATHER = ["temperature", "humidity", "wind_direction", "wind_power", "pressure"]


@dataclass(frozen=True)
class FeedSpec:
    """How one feed maps to the station-hour schema."""

    renames: dict[str, str]
    time: Callable[[str], Column] | None = None
    marked: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    code_prefix: str = ""
    station_type: str | None = None

    def in_zone(self, zone: str) -> FeedSpec:
        """The spec for a feed whose epoch times are read on the clock of ``zone``."""
        if self.time is not dotnet_hour:
            raise ValueError("this feed's times are text and carry no epoch")
        return replace(self, time=partial(dotnet_hour, zone=zone))


# Feed field names and the columns they become.
_GASES_AND_DUST = {"CO": "co", "O3": "o3", "PM2_5": "pm2_5", "NO2": "no2", "SO2": "so2", "PM10": "pm10"}

REGIONAL = FeedSpec(
    renames={"UniqueCode": "station_code", "TimePoint": "published_at", **_GASES_AND_DUST},
    time=dotnet_hour,
    marked=["co", "o3", "pm2_5", "no2", "so2", "pm10"],
    missing=["aqi", *WEATHER],
)
DISTRICT = FeedSpec(
    renames={"StationCode": "station_code", "TimePoint": "published_at", "AQI": "aqi", **_GASES_AND_DUST},
    time=iso_stamp,
    marked=MEASURES,
    missing=WEATHER,
)
# Fixed value: area code put before the station codes of one district.
PREFIXED_DISTRICT = FeedSpec(
    renames=DISTRICT.renames, time=iso_stamp, marked=MEASURES, missing=WEATHER, code_prefix="510116"
)
MICRO = FeedSpec(
    renames={
        "stationId": "station_code", "insTime": "published_at", "pm25": "pm2_5",
        "windDirection": "wind_direction", "windPower": "wind_power",
    },
    station_type="micro",
)


def station_dimension(stations: DataFrame, where: Column | None = None) -> DataFrame:
    """Station columns a feed is enriched with."""
    chosen = stations if where is None else stations.where(where)
    return chosen.select("station_name", "grid_id", "station_code", "station_level", "coord")


def normalize_feed(records: DataFrame, spec: FeedSpec, dimension: DataFrame) -> DataFrame:
    """Feed records as station-hour rows; unknown stations keep null names."""
    df = records.withColumnsRenamed(spec.renames)
    if spec.time:
        df = df.withColumn("published_at", spec.time("published_at"))
    df = null_columns(blank_marks(df, spec.marked), spec.missing)
    if spec.code_prefix:
        df = df.withColumn("station_code", F.concat(F.lit(spec.code_prefix), "station_code"))
    df = df.withColumn("publish_date", day_of_text("published_at"))
    df = lookup_join(df, dimension, "station_code", "left")
    kind = F.lit(spec.station_type) if spec.station_type else F.col("station_level")
    return df.withColumn("station_type", kind).select(*STATION_HOUR)


# Columns of the hourly weather feed.
WEATHER_FEED = [
    "STATION_ID_C", "STATION_NAME", "CITY", "CNTY", "DATETIME", "ADMIN_CODE_CHN", "PRE_1H", "PRS", "RHU",
    "TEM", "WIN_D_INST_MAX", "WIN_S_INST_MAX", "DUANXIN_STATION_NAME", "GONGFU_STATION_NAME",
    "HUITU_STATION_NAME",
]


def normalize_weather(records: DataFrame) -> DataFrame:
    return records.select(*WEATHER_FEED, day_of_text("DATETIME").alias("publish_date"))


def repair_csv(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Broken CSV lines as ``(good rows with publish_date, rejected lines)``.
    Rejected: too few fields, or a last field that is no time."""
    rows = lines.select("value", *restitch_csv("value")).withColumn("publish_date", stamp_day("published_at"))
    good = rows.where(F.col("publish_date").isNotNull()).drop("value")
    return good, rows.where(F.col("publish_date").isNull()).select("value")


def vehicle_registry(records: DataFrame, brand: str = "CarBrand") -> DataFrame:
    """Brand and the whole record as JSON text."""
    whole = records.select(all_fields_json(records.columns).alias("OtherInfo"))
    return whole.select(F.get_json_object("OtherInfo", f"$.{brand}").alias(brand), "OtherInfo")
