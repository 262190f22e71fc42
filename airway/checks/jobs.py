"""Whole jobs: portraits, diagnostics, feeds, tracks and upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.checks.fixtures import (
    ACTIVE_ROWS,
    FIRST_HOUR,
    LAST_HOUR,
    WIND_SITES,
    Fixtures,
    sql_mean,
    sql_metres,
    with_fx,
)
from airway.checks.joins import FLOW_BODY, PORTRAIT_NEW, WIND_BODY, WIND_VALUE, portraits_new, portraits_old
from airway.checks.registry import CHECKS, check
from airway.operators.hours import HourRange
from airway.operators.merging import upsert, upsert_json
from airway.plans import feeds, obd, portrait, tracks
from airway.sources.scans import HOUR_KEYS, inline_records, read_partitioned
from airway.sources.sinks import create_partitioned_table, insert_positional, upsert_partitions
from airway.sources.staging import staging_path

ALL_HOURS = HourRange(FIRST_HOUR, LAST_HOUR)

_K = "grid_id, station_code, station_name, hour_at"
_G = "g AS grid_id, station_code, station_name, hour_at"


def _portrait_sql(truck: str) -> str:
    stations = with_fx("ev allst st", "").rstrip()
    near = f"""near AS (SELECT a.*, s.grid_id AS g, s.station_code, s.station_name FROM ev a JOIN st s
        ON {sql_metres('a.lon', 'a.lat', 's.lon', 's.lat')} < 5000)"""
    cells = with_fx("cell", "").strip()[5:]
    members = [
        ("truck_num", "truck_num"), ("truck_trajectory", "truck_trajectory"), ("traffic_flow", "traffic_flow"),
        ("traffic_index", "traffic_index"), ("rainfall", "rainfall"), ("humidity", "humidity"),
        ("solar_radiation", "solar_radiation"), ("dust_index", "dust_index"), ("wind_speed", "wind_speed"),
        ("diffusion_conditions", "diffusion_conditions"), ("earth_num", "earth_num"),
    ]
    text = ", ".join(f"""'"{n}":' || CAST({c} AS VARCHAR)""" for n, c in members)
    return f"""{stations}, {near}, {cells}, {FLOW_BODY}, {WIND_BODY},
    seen AS ({truck}),
    f1 AS (SELECT {_G}, count(DISTINCT (user_id, user_id % 50)) AS truck_num, count(*) AS truck_trajectory FROM seen GROUP BY ALL),
    f2 AS (SELECT {_K}, CAST(trunc(round(sum(flow), 6)) AS INTEGER) AS traffic_flow FROM mean GROUP BY ALL),
    f3 AS (SELECT {_G}, CAST({sql_mean('sum(k)', 'count(*)', 6)} AS DECIMAL(10,6)) AS traffic_index,
        CAST({sql_mean('sum(k)', 'count(*)', 2)} AS DECIMAL(8,2)) AS rainfall,
        CAST({sql_mean('sum(event_id % 97)', 'count(*)', 2)} AS DECIMAL(8,2)) AS humidity,
        CAST({sql_mean('sum(event_id % 7)', 'count(*)', 2)} AS DECIMAL(8,2)) AS solar_radiation FROM near GROUP BY ALL),
    f5 AS (SELECT s.grid_id, s.station_code, s.station_name, e.hour_at, CAST(sum(e.k + e.event_id % 7) AS INTEGER) AS dust_index,
        sum(e.k)::BIGINT AS earth_num FROM ev e JOIN cell c ON c.id = e.event_id // 5
        JOIN st s ON {sql_metres('c.lon', 'c.lat', 's.lon', 's.lat')} < 5000 GROUP BY s.grid_id, s.station_code, s.station_name, e.hour_at),
    f6 AS (SELECT {_K}, {WIND_VALUE} AS wind_speed FROM weighed GROUP BY ALL),
    f7 AS (SELECT day, CAST(coalesce(max(digit), '0') AS INTEGER) AS diffusion_conditions FROM (
        SELECT substr(hour_at, 1, 10) AS day, hour_at, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 6 AS VARCHAR) END AS digit
        FROM ev QUALIFY hour_at = max(hour_at) OVER (PARTITION BY substr(hour_at, 1, 10))) GROUP BY day),
    every AS (SELECT f6.*, substr(hour_at, 1, 10) AS day FROM f6)
    SELECT grid_id, station_code, station_name, '{{' || concat_ws(',', {text}) || '}}' AS data, hour_at AS published_at FROM every
    LEFT JOIN f1 USING ({_K}) LEFT JOIN f2 USING ({_K}) LEFT JOIN f3 USING ({_K}) LEFT JOIN f5 USING ({_K})
    LEFT JOIN f7 USING (day)"""


@check(
    "C1 J1 J3 J4 J6 J8 A1 A2 A3 A4 A5 A6 A7 A9 F6 P5 P6 P14 P15 P16",
    _portrait_sql("SELECT * FROM near WHERE value > 10"),
)
def station_portrait_hourly(fx: Fixtures) -> DataFrame:
    """Eleven features of every station and hour in one job."""
    return portrait.station_portrait(fx.portrait_tables(), ALL_HOURS, wind_sites=WIND_SITES)


@check(
    "C2 S4 P12 P7",
    _portrait_sql("""SELECT * FROM near WHERE value > 10 QUALIFY row_number() OVER (
        PARTITION BY station_code, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY user_id % 50,
        printf('%.6f', lon), printf('%.6f', lat)) = 1"""),
)
def station_portrait_from_partitions(fx: Fixtures) -> DataFrame:
    """The same with tracks from date/hour partitions that hold copies."""
    tables = fx.portrait_tables(fx.trucks_partitioned())
    return portrait.station_portrait(tables, ALL_HOURS, wind_sites=WIND_SITES)


NOON = "1970-01-01 12:00:00"
_EARLY = f"published_at < '{NOON}'"
_TEXT = """'{"a":' || a || ',"b":"' || b || '","c":' || c || '}'"""
_OLD_TEXT = _TEXT.replace("|| a ||", "|| old_a ||")


@check(
    "C3 U2 A11 F5 K6",
    f"""WITH p AS ({PORTRAIT_NEW}),
    changed AS (SELECT DISTINCT published_at FROM p WHERE grid_id < 4 OR id % 5 = 0)
    SELECT grid_id, station_code, station_name, {_TEXT} AS data, published_at FROM p WHERE published_at IN (SELECT * FROM changed)
    UNION ALL SELECT grid_id, station_code, station_name, {_OLD_TEXT}, published_at FROM p
        WHERE published_at NOT IN (SELECT * FROM changed) AND grid_id >= 4""",
)
def portrait_backfill(fx: Fixtures) -> DataFrame:
    """Hours with any difference are replaced, the others stay as stored."""
    return portrait.backfill(portraits_new(fx), portraits_old(fx))


# Two hours a slot, published two hours later; the result of a run is filled in by a second.
AHEAD = HourRange("2024-01-05 00:00:00", "2024-01-08 21:00:00", ahead=2, span=2)
_AHEAD_TRUCKS = f"""SELECT * REPLACE (strftime(slot + INTERVAL 2 HOUR, '%Y-%m-%d %H:00:00') AS hour_at) FROM (
        SELECT near.*, date_trunc('hour', ts) - back * INTERVAL 1 HOUR AS slot FROM near, (VALUES (0), (1)) b(back) WHERE value > 10)
    WHERE slot BETWEEN TIMESTAMP '{AHEAD.first}' AND TIMESTAMP '{AHEAD.last}'"""


@check(
    "C3 U2 A11 F5 K6 T2",
    f"""SELECT *, substr(published_at, 1, 10) AS publish_date FROM ({_portrait_sql(_AHEAD_TRUCKS)})
        WHERE published_at BETWEEN '{AHEAD.published[0]}' AND '{AHEAD.published[1]}'
    UNION ALL SELECT s_nationkey, CAST(s_suppkey AS VARCHAR), s_name, '{{"old":1}}', '2024-01-01 05:00:00', '2024-01-01' FROM supplier""",
)
def portraits_backfilled_by_digest(fx: Fixtures) -> DataFrame:
    """Real portraits with look-ahead: some stored hours differ, some lack stations, some are
    written otherwise but say the same, some lie outside and stay."""
    path = staging_path(fx.spark, "portraits")
    tables, first = fx.portrait_tables(), HourRange(AHEAD.first, "2024-01-06 23:00:00", 2, 2)
    portrait.backfill_partitions(tables, first, path, wind_sites=WIND_SITES)
    stored = read_partitioned(fx.spark, path)
    key, hour = F.col("station_code").cast("bigint"), F.substring("published_at", 12, 2)
    spoiled = stored.where((key % 4 == 0) & (hour == "07")).withColumn("data", F.lit('{"truck_num":-1}'))
    stations = fx.sites().select("grid_id", "station_code", "station_name")
    old = stations.select("*", F.lit('{"old":1}').alias("data"), F.lit("2024-01-01 05:00:00").alias("published_at"), F.lit("2024-01-01").alias("publish_date"))
    upsert_partitions(spoiled.unionByName(old), path, portrait.KEYS, ("publish_date",))
    # The same said otherwise is no difference.
    stored = read_partitioned(fx.spark, path)
    spaced = stored.where(hour == "09").withColumn("data", F.regexp_replace("data", ",", ", "))
    alike = portrait.portrait_diff(spaced, stored).isEmpty()
    portrait.backfill_partitions(tables, AHEAD, path, wind_sites=WIND_SITES)
    return read_partitioned(fx.spark, path).where(F.lit(alike))


_FROM_PARTITIONS = """SELECT * FROM near WHERE value > 10 QUALIFY row_number() OVER (
        PARTITION BY station_code, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY user_id % 50,
        printf('%.6f', lon), printf('%.6f', lat)) = 1"""
MISSING = HourRange("2024-01-10 00:00:00", "2024-01-11 23:00:00")


@check(
    "C2 S4 S3 K3",
    f"""SELECT grid_id, station_code, station_name, CASE WHEN substr(published_at, 12, 2) BETWEEN '03' AND '08' THEN '{{}}' ELSE data END AS data,
        published_at, substr(published_at, 1, 10) AS publish_date FROM ({_portrait_sql(_FROM_PARTITIONS)})
        WHERE published_at BETWEEN '{MISSING.first}' AND '{MISSING.last}'""",
)
def portraits_of_missing_hours(fx: Fixtures) -> DataFrame:
    """Tracks in a partitioned catalog table; some hours are stored already. Which are not
    prunes the partitions of the tracks at run time."""
    name, path = f"airway_tracks_{uuid.uuid4().hex}", staging_path(fx.spark, "portraits")
    schema = "plate_num string, sim_card string, speed double, up_time bigint, lon string, lat string, publish_date string, hour string"
    create_partitioned_table(fx.spark, name, schema, HOUR_KEYS, staging_path(fx.spark, "tracks"))
    insert_positional(fx.trucks_partitioned(), name, [c.split()[0] for c in schema.split(", ")], HOUR_KEYS)
    tables = fx.portrait_tables(fx.spark.table(name))
    known = portrait.portrait_stations(tables.stations).select(*portrait.STATION_KEYS)
    known = known.select("*", F.lit("{}").alias("data"), F.explode(MISSING.slots()).alias("published_at"))
    known = known.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))
    known = known.where(F.substring("published_at", 12, 2).between("03", "08")).withColumn("publish_date", F.substring("published_at", 1, 10))
    upsert_partitions(known, path, portrait.KEYS, ("publish_date",))
    portrait.fill_missing_hours(tables, MISSING, path, wind_sites=WIND_SITES)
    return read_partitioned(fx.spark, path)


@check(
    "K6",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT grid_id, station_code, station_name, published_at,
        CASE WHEN {_EARLY} THEN {_TEXT} ELSE {_OLD_TEXT} END AS data FROM p WHERE grid_id >= 4 OR {_EARLY}""",
)
def keyed_upsert(fx: Fixtures) -> DataFrame:
    """New rows come in two versions per key; the later one stays."""
    some = portraits_new(fx).where(F.col("published_at") < NOON)
    versions = some.withColumn("data", F.lit("{}")).withColumn("seq", F.lit(1)).unionByName(some.withColumn("seq", F.lit(2)))
    stored = portraits_old(fx).withColumn("seq", F.lit(0))
    return upsert(versions, stored, portrait.KEYS, ["seq"]).drop("seq")


@check(
    "K7 J10",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT grid_id, station_code, station_name, published_at, CAST(old_a AS INTEGER) AS a, b,
        CAST(c AS INTEGER) AS c, CASE WHEN {_EARLY} THEN 1 END AS e FROM p WHERE grid_id >= 4
    UNION ALL SELECT grid_id, station_code, station_name, published_at, 0, NULL, NULL, 1 FROM p WHERE grid_id < 4 AND {_EARLY}""",
)
def json_merging_upsert(fx: Fixtures) -> DataFrame:
    """On a key conflict stored members win and new ones are added."""
    new = portraits_new(fx).where(F.col("published_at") < NOON).withColumn("data", F.lit('{"a":0,"e":1}'))
    merged = upsert_json(new, portraits_old(fx), portrait.KEYS, "data")
    return merged.withColumn("_d", F.from_json("data", "a int, b string, c int, e int")).select(*portrait.KEYS, "_d.*")


@check(
    "C4 S2 P8 P12 J2 W3 O1",
    with_fx("ev rect", """SELECT sim_card, grid_id, min(ts) AS published_at_in, max(ts) AS published_at_out FROM (
        SELECT *, sum(CASE WHEN prev = grid_id THEN 0 ELSE 1 END) OVER (PARTITION BY sim_card ORDER BY ts, grid_id) AS run FROM (
            SELECT *, lag(grid_id) OVER (PARTITION BY sim_card ORDER BY ts, grid_id) AS prev FROM (
                SELECT e.user_id AS sim_card, e.ts, r.grid_id FROM ev e JOIN rect r
                ON e.lat > bl_lat AND e.lon > bl_lon AND e.lat <= tr_lat AND e.lon <= tr_lon
                WHERE e.ts >= TIMESTAMP '2024-01-03' AND e.ts < TIMESTAMP '2024-01-28')))
       GROUP BY sim_card, grid_id, run ORDER BY published_at_in, sim_card"""),
)
def grid_entry_and_exit(fx: Fixtures) -> DataFrame:
    found = tracks.grid_stays(fx.stops(), fx.rects(), "2024-01-03 00:00:00", "2024-01-28 00:00:00")
    return found.orderBy("published_at_in", "sim_card")


_RUNNING = "m6413 <> 0 AND m6415 <> 0 AND m6411 <> 0 AND error_data IS NOT NULL"
_OBD = "device_id, error_data, published_at"


@check(
    "C5 P10 P11 A8 J7 F4",
    with_fx("ev obd", f"""SELECT {_OBD} FROM obd WHERE {_RUNNING} AND device_id IN
        (SELECT device_id FROM obd WHERE {_RUNNING} GROUP BY device_id HAVING count(*) > {ACTIVE_ROWS - 15})"""),
)
def active_devices_filter_first(fx: Fixtures) -> DataFrame:
    return obd.active_filter_first(fx.obd(), ACTIVE_ROWS - 15).drop("dynamic_data")


@check(
    "C6 A8 J7 P10 P11",
    with_fx("ev obd", f"""SELECT {_OBD} FROM obd WHERE {_RUNNING} AND device_id IN
        (SELECT device_id FROM obd GROUP BY device_id HAVING count(*) > {ACTIVE_ROWS})"""),
)
def active_devices_count_first(fx: Fixtures) -> DataFrame:
    return obd.active_count_first(fx.obd(), ACTIVE_ROWS).drop("dynamic_data")


@check(
    "C7 F3 F27 P11 S5",
    with_fx("ev obd", """SELECT device_id, lon, lat, oil, published_at FROM obd WHERE oil IS NOT NULL AND error_data IS NOT NULL"""),
)
def diagnostics_flattened(fx: Fixtures) -> DataFrame:
    return obd.flatten(fx.obd())


# ---- station feeds: landed documents, each a JSON array of records -----------

_METRICS = ["CO", "O3", "PM2_5", "NO2", "SO2", "PM10"]


def _documents(fx: Fixtures, *fields) -> DataFrame:
    """One document per event holding its record."""
    return fx.events().select(F.to_json(F.array(F.struct(*fields))).alias("body"))


def _value(offset: int):
    amount = ((F.col("event_id") + offset) % 100).cast("string")
    return F.when(F.col("event_type") == "error", F.lit("—")).otherwise(amount)


def _code():
    return (F.col("user_id") % 150).cast("string")


def _sql_value(offset: int) -> str:
    return f"CASE WHEN event_type <> 'error' THEN CAST((event_id + {offset}) % 100 AS VARCHAR) END"


_COORD = """'{"lon":' || s.lon || ',"lat":' || s.lat || '}'"""
_NULL = "CAST(NULL AS VARCHAR)"


def _feed_sql(time: str, aqi: str, kind: str = "s.station_level", code: str = "CAST(user_id % 150 AS VARCHAR)", rows: str = "ev",
              dim: str = "st", weather: str | None = None) -> str:
    values = ", ".join(f"{_sql_value(i)} AS {n.lower()}" for i, n in enumerate(_METRICS))
    weather = weather or ", ".join(f"{_NULL} AS {n}" for n in feeds.WEATHER)
    return f"""SELECT s.station_name, {_COORD} AS coord, {values}, {aqi} AS aqi, s.grid_id, {code} AS station_code, {kind} AS station_type,
        {time} AS published_at, {weather}, strftime(ts, '%Y-%m-%d') AS publish_date
        FROM {rows} e LEFT JOIN {dim} s ON s.station_code = {code}"""


@check("C8 S8 P2 P4 P17 F16 F11 J5 P1", with_fx("ev st", _feed_sql("hour_at", _NULL)))
def regional_feed(fx: Fixtures) -> DataFrame:
    time = F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(")/"))
    fields = [_code().alias("UniqueCode"), time.alias("TimePoint"), *[_value(i).alias(n) for i, n in enumerate(_METRICS)]]
    records = inline_records(_documents(fx, *fields), "body", ["UniqueCode", "TimePoint", *_METRICS])
    return feeds.normalize_feed(records, feeds.REGIONAL, feeds.station_dimension(fx.stations()))


_DISTRICT_NAMES = ["StationCode", "TimePoint", "AQI", *_METRICS]


def _district_records(fx: Fixtures, code=None) -> DataFrame:
    fields = [
        (code if code is not None else _code()).alias("StationCode"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("TimePoint"),
        _value(50).alias("AQI"),
        *[_value(i).alias(n) for i, n in enumerate(_METRICS)],
    ]
    return inline_records(_documents(fx, *fields), "body", _DISTRICT_NAMES)


_SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


@check(
    "C9 S9 P2 P4 P17 F17 J5 U1",
    with_fx("ev st", _feed_sql(_SECOND, _sql_value(50)) + "\nUNION ALL " + _feed_sql(_SECOND, _sql_value(50), code="CAST(event_id % 90 AS VARCHAR)")),
)
def district_feeds(fx: Fixtures) -> DataFrame:
    dimension = feeds.station_dimension(fx.stations())
    first = feeds.normalize_feed(_district_records(fx), feeds.DISTRICT, dimension)
    second = feeds.normalize_feed(_district_records(fx, (F.col("event_id") % 90).cast("string")), feeds.DISTRICT, dimension)
    return first.unionByName(second)


@check(
    "C10 P18",
    with_fx("ev st", _feed_sql(_SECOND, _sql_value(50), code="'510116' || (user_id % 150)",
        dim="(SELECT * REPLACE ('510116' || station_code AS station_code) FROM st)")),
)
def prefixed_district_feed(fx: Fixtures) -> DataFrame:
    stations = fx.stations().withColumn("station_code", F.concat(F.lit("510116"), "station_code"))
    return feeds.normalize_feed(_district_records(fx), feeds.PREFIXED_DISTRICT, feeds.station_dimension(stations))


_MICRO = ["stationId", "insTime", "pm25", "pm10", "no2", "o3", "so2", "co", "aqi", "temperature", "humidity", "windDirection", "windPower", "pressure"]


@check(
    "C11 P3 P9",
    with_fx("ev st", """SELECT s.station_name, """ + _COORD + """ AS coord, CAST(k AS VARCHAR) AS no2, CAST(k AS VARCHAR) AS o3, CAST(k AS VARCHAR) AS pm2_5,
        CAST(k AS VARCHAR) AS so2, CAST(k AS VARCHAR) AS pm10, CAST(k AS VARCHAR) AS aqi, CAST(k AS VARCHAR) AS co, s.grid_id,
        CAST(user_id % 150 AS VARCHAR) AS station_code, 'micro' AS station_type, """ + _SECOND + """ AS published_at, CAST(k AS VARCHAR) AS temperature,
        CAST(k AS VARCHAR) AS humidity, CAST(k AS VARCHAR) AS wind_direction, CAST(k AS VARCHAR) AS wind_power, CAST(k AS VARCHAR) AS pressure,
        strftime(ts, '%Y-%m-%d') AS publish_date FROM ev e
        LEFT JOIN (SELECT * FROM st WHERE district_code = '510107' AND station_type = 'micro_station') s
        ON s.station_code = CAST(user_id % 150 AS VARCHAR)"""),
)
def micro_station_feed(fx: Fixtures) -> DataFrame:
    fields = [_code().alias("stationId"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("insTime")]
    fields += [F.col("k").cast("string").alias(n) for n in _MICRO[2:]]
    records = inline_records(_documents(fx, *fields), "body", _MICRO)
    wanted = (F.col("district_code") == "510107") & (F.col("station_type") == "micro_station")
    return feeds.normalize_feed(records, feeds.MICRO, feeds.station_dimension(fx.stations(), wanted))


_WEATHER_SQL = ", ".join(f"CAST(k + {i} AS VARCHAR) AS {n}" for i, n in enumerate(feeds.WEATHER_FEED) if n != "DATETIME")


@check("C12 S8 P1 F11", with_fx("ev", f"SELECT {_WEATHER_SQL}, {_SECOND} AS DATETIME, strftime(ts, '%Y-%m-%d') AS publish_date FROM ev"))
def weather_feed(fx: Fixtures) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    fields = [
        (stamp if n == "DATETIME" else (F.col("k") + i).cast("string")).alias(n) for i, n in enumerate(feeds.WEATHER_FEED)
    ]
    return feeds.normalize_weather(inline_records(_documents(fx, *fields), "body", feeds.WEATHER_FEED))


def _shift_sql() -> tuple[str, str]:
    from airway.checks.scalars import _GCJ

    head = _GCJ.split("SELECT event_id,\n        round")[0].replace(
        "CASE WHEN event_id % 9 = 0", "CASE WHEN false"
    )
    lon = "lon + dx * 180.0 / (6378245.0 / sqrt(m) * cos(lat * pi() / 180.0) * pi())"
    lat = "lat + dy * 180.0 / (6378245.0 * (1 - 0.00669342162296594323) / (m * sqrt(m)) * pi())"
    return head, f"printf('%.6f', {lon}) AS lon, printf('%.6f', {lat}) AS lat"


_HEAD, _SHIFTED = _shift_sql()


@check(
    "C15 P12 P2 F25 F11 F12 F14",
    f"""{_HEAD} SELECT CAST(e.user_id AS VARCHAR) AS plate_num, CAST(e.user_id % 50 AS VARCHAR) AS sim_card, e.event_id % 360 AS direction,
        e.value AS speed, epoch(date_trunc('second', ts))::BIGINT AS up_time, r.lon AS raw_lon, r.lat AS raw_lat, {_SHIFTED.replace('lon + dx', 'r.lon + dx').replace('lat + dy', 'r.lat + dy')},
        strftime(ts, '%Y-%m-%d') AS publish_date, strftime(ts, '%H') AS hour FROM events e JOIN r USING (event_id)
    QUALIFY row_number() OVER (PARTITION BY e.user_id, date_trunc('second', ts) ORDER BY e.user_id % 50, e.event_id % 360, e.value) = 1""",
)
def track_import(fx: Fixtures) -> DataFrame:
    """Every track row is there twice."""
    return tracks.import_track(_raw_tracks(fx))


def _raw_tracks(fx: Fixtures) -> DataFrame:
    rows = fx.events().select(
        F.col("user_id").cast("string").alias("plate_num"),
        (F.col("user_id") % 50).cast("string").alias("sim_card"),
        (F.col("event_id") % 360).alias("direction"),
        F.col("value").alias("speed"),
        F.unix_timestamp("ts").alias("up_time"),
        F.col("lon").alias("point_x"),
        F.col("lat").alias("point_y"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("_copy"),
    )
    return rows.drop("_copy")


@check("C15 K3 P12 S12", CHECKS["track_import"].sql)
def track_import_repeated(fx: Fixtures) -> DataFrame:
    """The import into the partitioned track table, run for the first days and then for all:
    rows that are there are not inserted again."""
    name = f"airway_tracks_{uuid.uuid4().hex}"
    schema = """plate_num string, sim_card string, direction bigint, speed double, up_time bigint, raw_lon double, raw_lat double,
        lon string, lat string, publish_date string, hour string"""
    create_partitioned_table(fx.spark, name, schema, HOUR_KEYS, staging_path(fx.spark, "tracks"))
    rows = _raw_tracks(fx)
    for part in (rows.where(F.col("up_time") < 1704700000), rows):
        tracks.import_into(part, name)
    return fx.spark.table(name)
