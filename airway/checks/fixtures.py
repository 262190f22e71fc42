"""The supplied tables shaped like the tables the jobs read, once for Spark and
once as SQL text. Positions are derived from keys by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = ["nation", "province", "city", "county"]
DISTRICTS = ["510115", "510107", "510106"]
KINDS = ["standard", "micro_station", "roadside"]
SITE_COUNT, WIND_SITE_COUNT = 25, 12
WIND_SITES = [f"NATION_{i}" for i in range(WIND_SITE_COUNT)]
ACTIVE_ROWS = 60
FIRST_HOUR, LAST_HOUR = "2024-01-01 00:00:00", "2024-01-30 23:00:00"


# Multipliers, prime modulus and step (in degrees) of positions: no two of fewer keys than
# the modulus share one, and all lie within 0.4 degrees.
POINTS = (91909, 72931, 99991, 0.000004)
SITES = (3637, 5309, 9973, 0.00004)


def _place(k: Column, a: int, b: int, modulus: int, step: float) -> tuple[Column, Column]:
    lon = F.lit(103.9) + ((k.cast("long") * a) % modulus).cast("double") * F.lit(step)
    lat = F.lit(30.5) + ((k.cast("long") * b) % modulus).cast("double") * F.lit(step)
    return lon, lat


def point_of(k: Column) -> tuple[Column, Column]:
    return _place(k, *POINTS)


def site_of(k: Column) -> tuple[Column, Column]:
    return _place(k, *SITES)


def coord(lon: Column, lat: Column) -> Column:
    return F.to_json(F.struct(lon.alias("lon"), lat.alias("lat")))


def pick(k: Column, options: list[str]) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), (k % len(options)).cast("int"))


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def events(self) -> DataFrame:
        """Events with their counter ``k``, hour and position."""
        if "placed events" not in self._read:
            lon, lat = point_of(F.col("event_id"))
            self._read["placed events"] = self.raw("events").withColumns(
                {
                    "k": F.get_json_object("props", "$.k").cast("int"),
                    "hour_at": F.date_format("ts", "yyyy-MM-dd HH:00:00"),
                    "lon": lon,
                    "lat": lat,
                }
            )
        return self._read["placed events"]

    def stations(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            k.cast("string").alias("station_code"),
            F.col("s_name").alias("station_name"),
            F.col("s_nationkey").alias("grid_id"),
            pick(k, LEVELS).alias("station_level"),
            pick(k, KINDS).alias("station_type"),
            pick(k, DISTRICTS).alias("district_code"),
            coord(*site_of(k)).alias("coord"),
        )

    def sites(self) -> DataFrame:
        lon, lat = site_of(F.col("s_suppkey"))
        return self.raw("supplier").select(
            F.col("s_nationkey").alias("grid_id"),
            F.col("s_suppkey").cast("string").alias("station_code"),
            F.col("s_name").alias("station_name"),
            lon.alias("lon"),
            lat.alias("lat"),
        )

    def trucks(self) -> DataFrame:
        return self.events().select(
            F.col("user_id").cast("string").alias("plate_num"),
            (F.col("user_id") % 50).cast("string").alias("sim_card"),
            coord(F.col("lon"), F.col("lat")).alias("coord"),
            (F.col("value") - F.lit(10.0)).alias("speed"),
            F.col("ts").alias("published_at"),
        )

    def trucks_partitioned(self) -> DataFrame:
        """Track rows with copies: every row twice, the second a little later in sim order."""
        rows = self.events().select(
            F.col("user_id").cast("string").alias("plate_num"),
            (F.col("user_id") % 50).cast("string").alias("sim_card"),
            (F.col("value") - F.lit(10.0)).alias("speed"),
            F.unix_timestamp("ts").alias("up_time"),
            F.format_string("%.6f", "lon").alias("lon"),
            F.format_string("%.6f", "lat").alias("lat"),
            F.date_format("ts", "yyyy-MM-dd").alias("publish_date"),
            F.date_format("ts", "HH").alias("hour"),
        )
        return rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")

    def congestion(self) -> DataFrame:
        return self.events().select(
            coord(F.col("lon"), F.col("lat")).alias("grid_center_coord"),
            F.to_json(F.struct(F.col("k").alias("index"))).alias("data"),
            F.col("hour_at").alias("published_at"),
        )

    def weather(self) -> DataFrame:
        data = F.struct(
            F.col("k").alias("rainfall"),
            (F.col("event_id") % 97).cast("string").alias("humidity"),
            (F.col("event_id") % 7).alias("solar_radiation"),
        )
        return self.events().select(
            coord(F.col("lon"), F.col("lat")).alias("grid_center_coord"),
            F.to_json(data).alias("data"),
            F.col("hour_at").alias("published_at"),
        )

    def station_weather(self) -> DataFrame:
        site = F.col("event_id") % SITE_COUNT
        return self.events().select(
            F.concat(F.lit("NATION_"), site.cast("string")).alias("station_name"),
            coord(*site_of(site)).alias("station_coord"),
            F.to_json(F.struct((F.col("k") % 13).alias("wind_speed"))).alias("data"),
            F.col("hour_at").alias("published_at"),
        )

    def cells(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), coord(*point_of(F.col("p_partkey"))).alias("center_coord")
        )

    def dust(self) -> DataFrame:
        text = F.concat(
            F.lit("[["), F.col("k").cast("string"), F.lit(".4, 1],["), (F.col("event_id") % 7).cast("string"), F.lit(", 2]]")
        )
        return self.events().select(
            F.floor(F.col("event_id") / 5).alias("grid_id"), text.alias("slag_truck_coords"), F.col("hour_at").alias("published_at")
        )

    def earthwork(self) -> DataFrame:
        return self.events().select(
            F.floor(F.col("event_id") / 5).alias("grid_id"), F.col("k").alias("truck_num"), F.col("hour_at").alias("published_at")
        )

    def road_flow(self) -> DataFrame:
        data = F.struct(
            F.col("k").alias("large"),
            F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 5).alias("middle"),
            (F.col("user_id") % 11).alias("small"),
        )
        return self.events().select(
            F.floor(F.col("event_id") / 14).alias("edge_id"),
            (F.col("event_id") % 2).alias("driving_direction"),
            F.to_json(data).alias("data"),
            F.col("hour_at").alias("published_at"),
        )

    def section_feature(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            F.floor(k / 2).alias("edge_id"), (k % 2).alias("driving_direction"), k.alias("road_congested_section_id")
        )

    def road_division(self) -> DataFrame:
        k = F.col("c_custkey")

        def vertex(key: Column) -> Column:
            lon, lat = point_of(key)
            return F.concat(F.lit("["), lon.cast("string"), F.lit(", "), lat.cast("string"), F.lit("]"))

        return self.raw("customer").select(
            k.alias("id"),
            F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("roadname"),
            F.concat(F.lit("["), vertex(k), F.lit(","), vertex(k + 7), F.lit("]")).alias("section_gcj02_json"),
        )

    def forecast(self) -> DataFrame:
        """Forecasts of each day; one in five has no condition."""
        return self.events().select(
            F.date_format("ts", "yyyy-MM-dd").alias("forecast_date"),
            F.col("hour_at").alias("published_at"),
            F.when(F.col("event_id") % 5 != 0, F.concat((F.col("event_id") % 6).cast("string"), F.lit("-LEVEL"))).alias(
                "diffusion_conditions"
            ),
        )

    def obd(self) -> DataFrame:
        """OBD rows: the second metric is quoted in some, the oil level missing in others."""
        k, n = F.col("k").cast("string"), F.col("event_id")
        second = F.when(n % 11 == 0, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(F.col("value").cast("string"))
        oil = F.when(n % 13 == 0, F.lit("null")).when(n % 2 == 0, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        payload = F.concat(
            F.lit('{"6413": '), k, F.lit(', "6415": '), second, F.lit(', "6411": '), (n % 7).cast("string"),
            F.lit(', "6420": '), F.coalesce(oil, F.col("value").cast("string")),
            F.lit(', "6422": '), F.col("lat").cast("string"), F.lit(', "6423": '), F.col("lon").cast("string"), F.lit("}"),
        )
        return self.events().select(
            "event_id",
            F.col("user_id").alias("device_id"),
            payload.alias("dynamic_data"),
            F.when(n % 10 != 0, F.col("event_type")).alias("error_data"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published_at"),
        )

    def rects(self) -> DataFrame:
        k = F.col("s_suppkey")
        west = F.lit(103.9) + (k % 10).cast("double") * F.lit(0.04)
        south = F.lit(30.5) + F.floor(k / 10).cast("double") * F.lit(0.04)
        return self.raw("supplier").select(
            (F.lit(1) + k).alias("grid_id"),
            west.alias("bottom_left_lon"),
            south.alias("bottom_left_lat"),
            (west + F.lit(0.04)).alias("top_right_lon"),
            (south + F.lit(0.04)).alias("top_right_lat"),
        )

    def stops(self) -> DataFrame:
        """Stop points with every row twice (same point and time)."""
        return self.events().select(
            F.col("user_id").alias("sim_card"),
            "lat",
            "lon",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
            F.col("ts").alias("published_at_raw"),
            F.explode(F.array(F.lit(0), F.lit(1))).alias("_copy"),
        ).drop("_copy")

    def track_points(self) -> DataFrame:
        return self.raw("events").select(
            (F.col("user_id") % 7).alias("sim_card"),
            F.col("ts").alias("published_at_raw"),
            "event_id",
            (F.lit(1) + F.floor(F.hour("ts") / 3) % 3).alias("grid_id"),
        )

    def portrait_tables(self, gps: DataFrame | None = None):
        from airway.plans.portrait import PortraitTables

        return PortraitTables(
            stations=self.stations(),
            gps=gps if gps is not None else self.trucks(),
            congestion=self.congestion(),
            weather=self.weather(),
            station_weather=self.station_weather(),
            dust=self.dust(),
            cells=self.cells(),
            earthwork=self.earthwork(),
            road_flow=self.road_flow(),
            section_feature=self.section_feature(),
            road_division=self.road_division(),
            forecast=self.forecast(),
        )


# ---- the same shapes as SQL -------------------------------------------------


def sql_place(k: str, a: int, b: int, modulus: int, step: str) -> tuple[str, str]:
    return (
        f"(103.9::DOUBLE + ((({k})::BIGINT * {a}) % {modulus})::DOUBLE * {step}::DOUBLE)",
        f"(30.5::DOUBLE + ((({k})::BIGINT * {b}) % {modulus})::DOUBLE * {step}::DOUBLE)",
    )


def sql_point(k: str) -> tuple[str, str]:
    return sql_place(k, *POINTS[:3], f"{POINTS[3]:f}")


def sql_site(k: str) -> tuple[str, str]:
    return sql_place(k, *SITES[:3], f"{SITES[3]:f}")


def sql_pick(k: str, options: list[str]) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"([{listed}])[({k}) % {len(options)} + 1]"


def sql_metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    chord = (
        f"pow(sin(({lat1} * pi() / 180.0 - {lat2} * pi() / 180.0) / 2.0), 2)"
        f" + cos({lat1} * pi() / 180.0) * cos({lat2} * pi() / 180.0)"
        f" * pow(sin(({lon1} * pi() / 180.0 - {lon2} * pi() / 180.0) / 2.0), 2)"
    )
    return f"CAST(floor(floor(2 * asin(sqrt({chord})) * 6371393.0::DOUBLE * 10000 + 0.5) / 10000) AS BIGINT)"


_LON, _LAT = sql_point("event_id")
_SLON, _SLAT = sql_site("s_suppkey")

FX = {
    "ev": f"""SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        strftime(ts, '%Y-%m-%d %H:00:00') AS hour_at, {_LON} AS lon, {_LAT} AS lat FROM events""",
    "st": f"""SELECT s_nationkey AS grid_id, CAST(s_suppkey AS VARCHAR) AS station_code, s_name AS station_name,
        {sql_pick('s_suppkey', LEVELS)} AS station_level, {sql_pick('s_suppkey', KINDS)} AS station_type,
        {sql_pick('s_suppkey', DISTRICTS)} AS district_code, {_SLON} AS lon, {_SLAT} AS lat FROM supplier""",
    "near": f"""SELECT a.*, s.grid_id AS g, s.station_code, s.station_name FROM ev a JOIN st s
        ON {sql_metres('a.lon', 'a.lat', 's.lon', 's.lat')} < 5000""",
    "obd": """SELECT event_id, user_id AS device_id, lon, lat, CASE WHEN event_id % 13 <> 0 THEN value END AS oil, k AS m6413,
        CASE WHEN event_id % 11 <> 0 THEN value END AS m6415, event_id % 7 AS m6411,
        CASE WHEN event_id % 10 <> 0 THEN event_type END AS error_data, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS published_at FROM ev""",
    "csv": """SELECT *, CASE WHEN event_id % 17 = 0 THEN 'short' WHEN event_id % 19 = 0 THEN 'no time' END AS fault FROM ev""",
    "cell": f"SELECT p_partkey AS id, {sql_point('p_partkey')[0]} AS lon, {sql_point('p_partkey')[1]} AS lat FROM part",
    "rect": """SELECT *, bl_lon + 0.04::DOUBLE AS tr_lon, bl_lat + 0.04::DOUBLE AS tr_lat FROM (SELECT 1 + s_suppkey AS grid_id,
        103.9::DOUBLE + (s_suppkey % 10)::DOUBLE * 0.04::DOUBLE AS bl_lon,
        30.5::DOUBLE + floor(s_suppkey / 10)::DOUBLE * 0.04::DOUBLE AS bl_lat FROM supplier)""",
}


# Stations with a portrait: ``allst`` before ``st`` narrows the latter.
FX["allst"] = FX["st"]
_PORTRAIT_ST = "SELECT * FROM allst WHERE station_level IN ('nation', 'province', 'city')"


def with_fx(names: str, body: str) -> str:
    """SQL text with the named fixtures in front, in order."""
    if "allst" in names.split():
        listed = {**FX, "st": _PORTRAIT_ST}
        return "WITH " + ",\n".join(f"{n} AS ({listed[n]})" for n in names.split()) + "\n" + body
    return "WITH " + ",\n".join(f"{n} AS ({FX[n]})" for n in names.split()) + "\n" + body


def sql_mean(total: str, n: str, digits: int) -> str:
    """Mean of non-negative integers, rounded half up by integer arithmetic."""
    scale = 10**digits
    return f"(CAST(({total}) * {2 * scale} + ({n}) AS BIGINT) // (2 * ({n})))::DOUBLE / {scale}"
