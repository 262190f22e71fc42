"""Joins, aggregations, set operations and windows."""

from __future__ import annotations

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
    sql_point,
    sql_site,
    with_fx,
)
from airway.checks.registry import check
from airway.functions.records import json_columns, json_merge, json_merge_patch
from airway.operators.hours import HourRange
from airway.operators.joining import lookup_join
from airway.operators.merging import (
    assemble,
    difference,
    explode_payload,
    frequent_keys,
    latest_rows,
    merge_payloads,
    rows_of_frequent_keys,
)
from airway.operators.spatial import CellGrid, idw, radius_join, radius_summary, rect_join, sites_of, spread_to_centers
from airway.operators.trajectory import boundaries, neighbours, stays
from airway.plans import portrait as P

ALL_HOURS = HourRange(FIRST_HOUR, LAST_HOUR)
PLACE = ["grid_id", "station_code", "station_name"]
GROUP = "g AS grid_id, station_code, station_name"


def hourly(per_site: DataFrame, stations: DataFrame) -> DataFrame:
    spread = spread_to_centers(per_site, stations, PLACE)
    return spread.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


def moving(fx: Fixtures) -> DataFrame:
    return fx.events().where(F.col("value") > 10).select("user_id", "event_id", "lon", "lat", "ts", "k")


@check(
    "J1 F23 P5",
    with_fx("ev st", f"""SELECT a.event_id, s.station_code, {sql_metres('a.lon', 'a.lat', 's.lon', 's.lat')} AS metres
        FROM ev a JOIN st s ON {sql_metres('a.lon', 'a.lat', 's.lon', 's.lat')} < 5000 WHERE a.value > 10"""),
)
def radius_pairs(fx: Fixtures) -> DataFrame:
    from airway.functions.geo import haversine_m

    centers = fx.sites().select("station_code", F.col("lon").alias("center_lon"), F.col("lat").alias("center_lat"))
    pairs = radius_join(moving(fx), centers)
    return pairs.select("event_id", "station_code", haversine_m("lon", "lat", "center_lon", "center_lat").alias("metres"))


@check(
    "J1 F23",
    with_fx("ev st", f"""SELECT a.event_id, s.station_code FROM ev a JOIN st s
        ON {sql_metres('a.lon', 'a.lat', 's.lon', 's.lat')} < 5000 WHERE a.value > 10"""),
)
def radius_pairs_of_crowded_cells(fx: Fixtures) -> DataFrame:
    """The same where the points of crowded cells (here: more than the mean) are dealt into parts."""
    points, cell = moving(fx), CellGrid(5000 / 4)
    mean = cell.place(points, "lon", "lat").groupBy("_cell").agg(F.count("*").alias("n")).agg(F.avg("n")).first()[0]
    centers = fx.sites().select("station_code", F.col("lon").alias("center_lon"), F.col("lat").alias("center_lat"))
    return radius_join(points, centers, crowded_rows=int(mean)).select("event_id", "station_code")


@check(
    "A1 A2 J1 P5",
    with_fx("ev st near", f"""SELECT {GROUP}, count(DISTINCT (user_id, user_id % 50)) AS truck_num,
        count(*) AS truck_trajectory FROM near WHERE value > 10 GROUP BY ALL"""),
)
def trucks_near_stations(fx: Fixtures) -> DataFrame:
    points = moving(fx).withColumn("sim", F.col("user_id") % 50)
    found = radius_summary(points, fx.sites(), PLACE, {"truck_trajectory": F.lit(1)}, distinct=("truck_num", ["user_id", "sim"]))
    return found.select(*PLACE, "truck_num", "truck_trajectory")


@check(
    "A1 A2 J1",
    with_fx("ev st near", f"""SELECT {GROUP}, hour_at AS published_at, count(DISTINCT (user_id, user_id % 50)) AS truck_num,
        count(*) AS truck_trajectory FROM near WHERE value > 10 GROUP BY ALL"""),
)
def truck_features_hourly(fx: Fixtures) -> DataFrame:
    """The truck features as portraits have them: vehicles summed per cell first."""
    sites = fx.sites()
    return hourly(P.truck_features(P.gps_in_slots(fx.trucks(), ALL_HOURS), sites_of(sites)), sites)


@check(
    "A3 J1",
    with_fx("ev st near", f"""SELECT {GROUP}, hour_at AS published_at,
        CAST({sql_mean('sum(k)', 'count(k)', 6)} AS DECIMAL(10,6)) AS traffic_index FROM near GROUP BY ALL"""),
)
def traffic_index_hourly(fx: Fixtures) -> DataFrame:
    """The traffic index as portraits have it."""
    sites = fx.sites()
    return hourly(P.traffic_index(fx.congestion(), sites_of(sites), ALL_HOURS), sites)


@check(
    "A1",
    """SELECT event_type, count(DISTINCT CASE WHEN event_id % 3 <> 0 AND event_id % 5 <> 0 THEN (user_id % 20, event_id % 5) END)
        AS pairs FROM events GROUP BY event_type""",
)
def distinct_pairs_skip_nulls(fx: Fixtures) -> DataFrame:
    n = F.col("event_id")
    rows = fx.raw("events").select(
        "event_type",
        F.when(n % 3 != 0, F.col("user_id") % 20).alias("a"),
        F.when(n % 5 != 0, n % 5).alias("b"),
    )
    return rows.groupBy("event_type").agg(F.count_distinct("a", "b").alias("pairs"))


@check(
    "A3",
    with_fx("ev st near", f"""SELECT {GROUP}, CAST({sql_mean('sum(k)', 'count(k)', 6)} AS DECIMAL(10,6)) AS traffic_index
        FROM near GROUP BY ALL"""),
)
def congestion_near_stations(fx: Fixtures) -> DataFrame:
    """Mean of a numeric text, malformed text counting as null."""
    points = json_columns(P.at_point(fx.congestion(), "grid_center_coord"), "data", {"index": "index"})
    sums = {"total": F.col("index"), "n": F.col("index").isNotNull().cast("long")}
    found = radius_summary(points.drop("published_at"), fx.sites(), PLACE, sums)
    return found.select(*PLACE, F.try_divide("total", "n").try_cast("decimal(10,6)").alias("traffic_index"))


@check(
    "A4",
    with_fx("ev st near", f"""SELECT {GROUP}, CAST({sql_mean('sum(k)', 'count(*)', 2)} AS DECIMAL(8,2)) AS rainfall,
        CAST({sql_mean('sum(event_id % 97)', 'count(*)', 2)} AS DECIMAL(8,2)) AS humidity,
        CAST({sql_mean('sum(event_id % 7)', 'count(*)', 2)} AS DECIMAL(8,2)) AS solar_radiation,
        hour_at AS published_at FROM near GROUP BY ALL"""),
)
def weather_near_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    return hourly(P.weather_features(fx.weather(), sites_of(sites), ALL_HOURS), sites)


DUST_SQL = with_fx("ev st cell", f"""
    SELECT s.grid_id, s.station_code, s.station_name, CAST(sum(t.dust) AS INTEGER) AS dust_index, t.hour_at AS published_at
    FROM (SELECT event_id // 5 AS cell, hour_at, sum(k + event_id % 7) AS dust FROM ev GROUP BY ALL) t
    JOIN cell c ON c.id = t.cell JOIN st s ON {sql_metres('c.lon', 'c.lat', 's.lon', 's.lat')} < 5000
    GROUP BY s.grid_id, s.station_code, s.station_name, t.hour_at""")


@check("A5 J3 F9 F26", DUST_SQL)
def dust_near_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    return hourly(P.dust_feature(fx.dust(), fx.cells(), sites_of(sites), ALL_HOURS), sites)


_V1, _V2 = sql_point("c_custkey"), sql_point("c_custkey + 7")
FLOW_BODY = f"""road AS (SELECT c_custkey AS id, c_mktsegment || '-' || c_nationkey AS roadname,
        {_V1[0]} AS lon1, {_V1[1]} AS lat1, {_V2[0]} AS lon2, {_V2[1]} AS lat2 FROM customer),
    hop AS (SELECT r.id, r.roadname, s.grid_id, s.station_code, s.station_name FROM road r JOIN st s
        ON {sql_metres('r.lon1', 'r.lat1', 's.lon', 's.lat')} < 5000 OR {sql_metres('r.lon2', 'r.lat2', 's.lon', 's.lat')} < 5000),
    flow AS (SELECT event_id // 14 * 2 + event_id % 2 AS id, hour_at,
        k + CASE WHEN event_id % 3 <> 0 THEN event_id % 5 ELSE 0 END + user_id % 11 AS flow FROM ev),
    best AS (SELECT h.id, h.roadname, h.grid_id, h.station_code, h.station_name, f.hour_at, max(f.flow) AS flow
        FROM flow f JOIN hop h ON f.id = h.id GROUP BY ALL),
    mean AS (SELECT roadname, grid_id, station_code, station_name, hour_at, avg(flow) AS flow FROM best GROUP BY ALL)"""


@check(
    "A6 J4 F2 F9",
    with_fx("ev st", "").rstrip() + ", " + FLOW_BODY + """
    SELECT grid_id, station_code, station_name, hour_at AS published_at, CAST(trunc(round(sum(flow), 6)) AS INTEGER) AS traffic_flow
    FROM mean GROUP BY ALL""",
)
def road_flow_near_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    return hourly(P.flow_feature(fx.road_flow(), fx.section_feature(), fx.road_division(), sites_of(sites), ALL_HOURS), sites)


@check(
    "A7 J4 J3",
    with_fx("ev st cell", f"""SELECT s.grid_id, s.station_code, s.station_name, e.hour_at AS published_at, sum(e.k)::BIGINT AS earth_num
        FROM ev e JOIN cell c ON c.id = e.event_id // 5 JOIN st s ON {sql_metres('c.lon', 'c.lat', 's.lon', 's.lat')} < 5000
        GROUP BY ALL"""),
)
def earthwork_near_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    return hourly(P.earth_feature(fx.earthwork(), fx.cells(), sites_of(sites), ALL_HOURS), sites)


_WLON, _WLAT = sql_site("event_id % 25")
WIND_BODY = f"""wind AS (SELECT hour_at, {_WLON} AS lon, {_WLAT} AS lat, k % 13 AS v FROM ev
        WHERE 'NATION_' || (event_id % 25) IN ({", ".join(f"'{n}'" for n in WIND_SITES)})),
    hours AS (SELECT strftime(unnest(generate_series(TIMESTAMP '{FIRST_HOUR}', TIMESTAMP '{LAST_HOUR}', INTERVAL 1 HOUR)),
        '%Y-%m-%d %H:%M:%S') AS hour_at),
    slot AS (SELECT s.*, h.hour_at FROM st s, hours h),
    weighed AS (SELECT s.grid_id, s.station_code, s.station_name, s.hour_at, w.v,
        {sql_metres('w.lon', 'w.lat', 's.lon', 's.lat')}::DOUBLE AS d FROM slot s LEFT JOIN wind w ON w.hour_at = s.hour_at)"""
WIND_VALUE = """coalesce(CAST(CAST(sum(v / nullif(d * d, 0)) / sum(1.0::DOUBLE / nullif(d * d, 0)) AS DECIMAL(8,2)) AS DOUBLE), 0.0)"""


@check(
    "J8 A9 F24 T1",
    with_fx("ev st", "").rstrip() + ", " + WIND_BODY + f"""
    SELECT grid_id, station_code, station_name, hour_at AS published_at, {WIND_VALUE} AS wind_speed FROM weighed GROUP BY ALL""",
)
def wind_at_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    return hourly(P.wind_feature(fx.station_weather(), sites_of(sites), ALL_HOURS, WIND_SITES), sites)


_NLON, _NLAT = sql_site("n_nationkey")


@check(
    "J8 A9",
    with_fx("st", f"""SELECT s.grid_id, s.station_code, s.station_name, s.station_level AS zone,
        coalesce(CAST(CAST(sum(v / nullif(d * d, 0)) / sum(1.0::DOUBLE / nullif(d * d, 0)) AS DECIMAL(8,2)) AS DOUBLE), 0.0) AS wind_speed
        FROM (SELECT s.*, n.v, {sql_metres('n.lon', 'n.lat', 's.lon', 's.lat')}::DOUBLE AS d FROM st s LEFT JOIN
            (SELECT {_NLON} AS lon, {_NLAT} AS lat, n_nationkey % 7 AS v,
                (['nation', 'province', 'city', 'county'])[n_nationkey % 4 + 1] AS station_level
             FROM nation) n ON n.station_level = s.station_level) s GROUP BY ALL"""),
)
def weighted_mean_by_zone(fx: Fixtures) -> DataFrame:
    """Weighted mean over the samples of the same zone, exact hits ignored."""
    from airway.checks.fixtures import LEVELS, pick, site_of

    key = F.col("n_nationkey")
    lon, lat = site_of(key)
    samples = fx.raw("nation").select(
        pick(key, LEVELS).alias("zone"), lon.alias("lon"), lat.alias("lat"), (key % 7).cast("double").alias("wind_speed")
    )
    centers = P.at_point(fx.stations(), "coord").withColumnRenamed("station_level", "zone")
    return idw(centers.select(*PLACE, "lon", "lat", "zone"), samples, ["zone"], PLACE, "wind_speed")


@check(
    "J2",
    with_fx("ev rect", """SELECT e.event_id, r.grid_id FROM ev e JOIN rect r
        ON e.lat > bl_lat AND e.lon > bl_lon AND e.lat <= tr_lat AND e.lon <= tr_lon"""),
)
def points_in_rectangles(fx: Fixtures) -> DataFrame:
    return rect_join(fx.events().select("event_id", "lon", "lat"), fx.rects()).select("event_id", "grid_id")


@check(
    "J2",
    with_fx("ev", """SELECT e.event_id, r.grid_id FROM ev e JOIN (SELECT s_suppkey AS grid_id,
            103.9::DOUBLE + (s_suppkey % 13)::DOUBLE * 0.03::DOUBLE AS bl_lon, 30.5::DOUBLE + (s_suppkey % 17)::DOUBLE * 0.02::DOUBLE AS bl_lat,
            0.002::DOUBLE * (1 + s_suppkey % 29) AS w, 0.003::DOUBLE * (1 + s_suppkey % 11) AS h FROM supplier) r
        ON e.lat > bl_lat AND e.lon > bl_lon AND e.lat <= bl_lat + h AND e.lon <= bl_lon + w"""),
)
def points_in_uneven_rectangles(fx: Fixtures) -> DataFrame:
    """Overlapping rectangles of many sizes and shapes."""
    k = F.col("s_suppkey")
    west = F.lit(103.9) + (k % 13).cast("double") * F.lit(0.03)
    south = F.lit(30.5) + (k % 17).cast("double") * F.lit(0.02)
    rects = fx.raw("supplier").select(
        k.alias("grid_id"),
        west.alias("bottom_left_lon"),
        south.alias("bottom_left_lat"),
        (west + F.lit(0.002) * (k % 29 + 1)).alias("top_right_lon"),
        (south + F.lit(0.003) * (k % 11 + 1)).alias("top_right_lat"),
    )
    return rect_join(fx.events().select("event_id", "lon", "lat"), rects).select("event_id", "grid_id")


@check(
    "J3",
    """SELECT o_custkey, c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def join_on_renamed_key(fx: Fixtures) -> DataFrame:
    customers = fx.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    counted = fx.raw("orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return lookup_join(counted, customers, "o_custkey")


@check(
    "J4",
    with_fx("ev", """SELECT e.event_id, c.c_custkey AS section, e.hour_at FROM ev e JOIN customer c
        ON e.event_id // 14 = c.c_custkey // 2 AND e.event_id % 2 = c.c_custkey % 2 AND substr(e.hour_at, 12, 2) = '08'"""),
)
def join_on_several_keys(fx: Fixtures) -> DataFrame:
    n = F.col("event_id")
    flow = fx.events().select(
        n, "hour_at", F.floor(n / 14).alias("edge_id"), (n % 2).alias("driving_direction")
    ).where(F.substring("hour_at", 12, 2) == "08")
    sections = fx.section_feature().withColumnRenamed("road_congested_section_id", "section")
    return lookup_join(flow, sections, ["edge_id", "driving_direction"]).select("event_id", "section", "hour_at")


@check(
    "J5",
    with_fx("st", """SELECT e.event_id, CAST(e.user_id % 150 AS VARCHAR) AS station_code, s.station_name, s.grid_id
        FROM events e LEFT JOIN st s ON s.station_code = CAST(e.user_id % 150 AS VARCHAR)"""),
)
def enrich_with_dimension(fx: Fixtures) -> DataFrame:
    rows = fx.raw("events").select("event_id", (F.col("user_id") % 150).cast("string").alias("station_code"))
    return lookup_join(rows, fx.stations().select("station_code", "station_name", "grid_id"), "station_code", "left")


@check(
    "J6 A2 A7",
    with_fx("ev st near", f"""
        SELECT grid_id, station_code, station_name, a.trucks, b.load, c.seen FROM
        (SELECT {GROUP}, count(*) AS trucks FROM near WHERE value > 60 GROUP BY ALL) a
        FULL JOIN (SELECT {GROUP}, sum(k)::BIGINT AS load FROM near WHERE k > 97 GROUP BY ALL) b USING (grid_id, station_code, station_name)
        FULL JOIN (SELECT {GROUP}, count(DISTINCT user_id) AS seen FROM near WHERE event_type = 'error' GROUP BY ALL) c
        USING (grid_id, station_code, station_name)"""),
)
def feature_sets_outer_joined(fx: Fixtures) -> DataFrame:
    """Feature sets of different stations side by side; all rows of the events
    enter, each set by its own condition."""
    events, sites = fx.events(), fx.sites()
    points = events.select("lon", "lat", "k", "user_id", "value", "event_type")
    return assemble(
        [
            radius_summary(points.where(F.col("value") > 60), sites, PLACE, {"trucks": F.lit(1)}),
            radius_summary(points.where(F.col("k") > 97), sites, PLACE, {"load": F.col("k")}),
            radius_summary(
                points.where(F.col("event_type") == "error"), sites, PLACE, {}, distinct=("seen", ["user_id"])
            ),
        ],
        PLACE,
    )


@check(
    "J7 A8",
    f"SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(user_id) > {ACTIVE_ROWS})",
)
def rows_of_active_keys(fx: Fixtures) -> DataFrame:
    return rows_of_frequent_keys(fx.raw("events").select("event_id", "user_id"), "user_id", ACTIVE_ROWS)


@check(
    "A8",
    f"SELECT CASE WHEN event_id % 4 <> 0 THEN user_id END AS device FROM events GROUP BY 1 HAVING count(CASE WHEN event_id % 4 <> 0 THEN user_id END) > {ACTIVE_ROWS - 15}",
)
def keys_with_many_rows(fx: Fixtures) -> DataFrame:
    """A null key has many rows but never counts."""
    rows = fx.raw("events").select(F.when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("device"))
    return frequent_keys(rows, "device", ACTIVE_ROWS - 15)


@check(
    "J9 W3 W4",
    """SELECT sim_card, grid_id, min(ts) AS published_at_in, max(ts) AS published_at_out, count(*) AS points FROM (
        SELECT *, sum(CASE WHEN prev = grid_id THEN 0 ELSE 1 END) OVER (PARTITION BY sim_card ORDER BY ts, event_id) AS run FROM (
            SELECT *, lag(grid_id) OVER (PARTITION BY sim_card ORDER BY ts, event_id) AS prev FROM (
                SELECT user_id % 7 AS sim_card, ts, event_id, 1 + (hour(ts) // 3) % 3 AS grid_id FROM events)))
       GROUP BY sim_card, grid_id, run""",
)
def stays_per_vehicle(fx: Fixtures) -> DataFrame:
    """One row per unbroken stay. Few vehicles, so stays run across many chunks."""
    found = stays(fx.track_points(), "sim_card", "published_at_raw", "grid_id", ["event_id"])
    return found.withColumnsRenamed({"published_at_raw_in": "published_at_in", "published_at_raw_out": "published_at_out"})


@check(
    "W1 W2",
    """SELECT event_id, lag(grid_id) OVER w AS grid_id_lag, lead(grid_id) OVER w AS grid_id_lead FROM (
        SELECT user_id % 7 AS sim_card, ts, event_id, 1 + (hour(ts) // 3) % 3 AS grid_id FROM events)
       WINDOW w AS (PARTITION BY sim_card ORDER BY ts, event_id)""",
)
def place_before_and_after(fx: Fixtures) -> DataFrame:
    near = neighbours(fx.track_points(), "sim_card", "published_at_raw", "grid_id", ["event_id"])
    return near.select("event_id", "grid_id_lag", "grid_id_lead")


@check(
    "W3",
    """SELECT event_id, prev IS DISTINCT FROM grid_id AS enters, next IS DISTINCT FROM grid_id AS leaves FROM (
        SELECT event_id, grid_id, lag(grid_id) OVER w AS prev, lead(grid_id) OVER w AS next FROM (
            SELECT user_id % 7 AS sim_card, ts, event_id, 1 + (hour(ts) // 3) % 3 AS grid_id FROM events)
        WINDOW w AS (PARTITION BY sim_card ORDER BY ts, event_id))
       WHERE prev IS DISTINCT FROM grid_id OR next IS DISTINCT FROM grid_id""",
)
def stay_boundaries(fx: Fixtures) -> DataFrame:
    found = boundaries(fx.track_points(), "sim_card", "published_at_raw", "grid_id", ["event_id"])
    return found.select("event_id", "enters", "leaves")


@check("O1", "SELECT event_id, value FROM events ORDER BY value, event_id")
def rows_in_order(fx: Fixtures) -> DataFrame:
    return fx.raw("events").select("event_id", "value").orderBy("value", "event_id")


@check("A10", "SELECT max(ts) AS newest, max(value) AS greatest FROM events WHERE event_type = 'error'")
def newest_under_a_filter(fx: Fixtures) -> DataFrame:
    return fx.raw("events").where(F.col("event_type") == "error").agg(F.max("ts").alias("newest"), F.max("value").alias("greatest"))


@check(
    "W1 W2",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 11 > 0 THEN user_id % 7 END AS car,
            CASE WHEN event_id % 13 > 0 THEN ts END AS seen, 1 + (hour(ts) // 3) % 3 AS place FROM events)
       SELECT event_id, lag(place) OVER w AS place_lag, lead(place) OVER w AS place_lead FROM t
       WHERE car IS NOT NULL AND seen IS NOT NULL WINDOW w AS (PARTITION BY car ORDER BY seen, event_id)
       UNION ALL SELECT event_id, NULL, NULL FROM t WHERE car IS NULL OR seen IS NULL""",
)
def neighbours_with_rows_on_no_track(fx: Fixtures) -> DataFrame:
    """Rows without vehicle, and rows whose time text is none, stay without neighbours."""
    rows = fx.track_points().select(
        "event_id",
        F.when(F.col("event_id") % 11 > 0, F.col("sim_card")).alias("car"),
        F.when(F.col("event_id") % 13 > 0, F.col("published_at_raw").cast("string")).otherwise("no time").alias("at"),
        F.col("grid_id").alias("place"),
    )
    return neighbours(rows, "car", "at", "place", ["event_id"]).select("event_id", "place_lag", "place_lead")


@check(
    "U1",
    """SELECT station_code, n_chars FROM (SELECT source AS station_code, n_chars FROM documents WHERE lang = 'en'
        UNION ALL SELECT source, n_chars FROM documents)""",
)
def union_keeps_copies(fx: Fixtures) -> DataFrame:
    docs = fx.raw("documents").select("lang", F.col("source").alias("station_code"), "n_chars")
    return docs.where(F.col("lang") == "en").drop("lang").unionByName(docs.drop("lang"))


def portraits_new(fx: Fixtures) -> DataFrame:
    key = F.col("s_suppkey")
    return fx.raw("supplier").select(
        F.col("s_nationkey").alias("grid_id"),
        key.cast("string").alias("station_code"),
        F.col("s_name").alias("station_name"),
        F.to_json(F.struct(F.col("s_nationkey").alias("a"), F.col("s_name").alias("b"), (key % 3).alias("c"))).alias("data"),
        F.date_format(F.timestamp_seconds(key % 24 * 3600), "yyyy-MM-dd HH:mm:ss").alias("published_at"),
    )


def portraits_old(fx: Fixtures) -> DataFrame:
    """Stored portraits: every fifth has another value, those of the first grid
    cells are absent."""
    key = F.col("station_code").cast("bigint")
    other = F.when(key % 5 == 0, F.regexp_replace("data", '"a":', '"a":9')).otherwise(F.col("data"))
    return portraits_new(fx).where(F.col("grid_id") >= 4).withColumn("data", other)


PORTRAIT_NEW = """SELECT s_nationkey AS grid_id, CAST(s_suppkey AS VARCHAR) AS station_code, s_name AS station_name, s_suppkey AS id,
    strftime(make_timestamp((s_suppkey % 24) * 3600000000), '%Y-%m-%d %H:%M:%S') AS published_at,
    CAST(s_nationkey AS VARCHAR) AS a, CASE WHEN s_suppkey % 5 = 0 THEN '9' ELSE '' END || s_nationkey AS old_a,
    s_name AS b, CAST(s_suppkey % 3 AS VARCHAR) AS c FROM supplier"""


@check(
    "U2 F5 A11",
    f"""WITH p AS ({PORTRAIT_NEW}),
    n AS (SELECT station_code, station_name, unnest(['a','b','c']) AS key, unnest([a, b, c]) AS value FROM p),
    o AS (SELECT station_code, station_name, unnest(['a','b','c']) AS key, unnest([old_a, b, c]) AS value FROM p WHERE grid_id >= 4)
    SELECT * FROM n EXCEPT SELECT * FROM o""",
)
def values_missing_from_store(fx: Fixtures) -> DataFrame:
    keep = ["station_code", "station_name"]
    return difference(explode_payload(portraits_new(fx), keep), explode_payload(portraits_old(fx), keep))


@check(
    "U2",
    """SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
       EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 200000""",
)
def distinct_difference(fx: Fixtures) -> DataFrame:
    orders, pair = fx.raw("orders"), ["o_custkey", "o_orderstatus"]
    return difference(
        orders.where(F.col("o_orderpriority") == "1-URGENT").select(*pair),
        orders.where(F.col("o_totalprice") > 200000).select(*pair),
    )


@check(
    "A11",
    """SELECT count(*) = 0 AS same FROM (SELECT o_custkey, o_orderstatus FROM orders
       EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey > 0)""",
)
def difference_is_empty(fx: Fixtures) -> DataFrame:
    pairs = fx.raw("orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    left = difference(pairs.drop("o_orderkey"), pairs.where(F.col("o_orderkey") > 0).drop("o_orderkey"))
    return left.agg((F.count("*") == 0).alias("same"))


@check(
    "A12",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT count(*) AS stations, (3 * count(*))::BIGINT AS members FROM p WHERE grid_id >= 4""",
)
def member_counts(fx: Fixtures) -> DataFrame:
    per_station = explode_payload(portraits_old(fx), ["station_code"]).groupBy("station_code").agg(F.count("key").alias("n"))
    return per_station.agg(F.count("*").alias("stations"), F.sum("n").alias("members"))


@check(
    "J10 F7",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT grid_id, station_code, station_name, published_at, CAST(a AS INTEGER) AS a,
        CAST(c AS INTEGER) AS c, b, CAST(id % 4 AS INTEGER) AS d FROM p""",
)
def payloads_merged(fx: Fixtures) -> DataFrame:
    """Stored and new members in one object; the new value of ``a`` wins."""
    new = portraits_new(fx)
    code = F.col("station_code").cast("bigint")
    stored = new.withColumn("data", F.to_json(F.struct((code % 4).alias("d"), F.lit(-1).alias("a"))))
    merged = merge_payloads(stored, new, P.KEYS, "data", json_merge)
    parsed = F.from_json("data", "a int, b string, c int, d int")
    return merged.withColumn("_d", parsed).select(*P.KEYS, "_d.*")


@check(
    "F7 K7",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT station_code, -1 AS a, CAST(id % 3 AS INTEGER) AS c, CAST(id % 4 AS INTEGER) AS d FROM p""",
)
def payload_patch(fx: Fixtures) -> DataFrame:
    """Merge patch: stored ``a`` and ``d`` win, a stored null removes ``b``."""
    code = F.col("station_code").cast("bigint")
    stored = F.concat(F.lit('{"b": null, "a": -1, "d": '), (code % 4).cast("string"), F.lit("}"))
    merged = portraits_new(fx).select("station_code", json_merge_patch("data", stored).alias("data"))
    parsed = F.from_json("data", "a int, c int, d int")
    return merged.where(~F.array_contains(F.json_object_keys("data"), "b")).withColumn("_d", parsed).select("station_code", "_d.*")


_LATEST = """SELECT o_orderstatus, o_orderkey, o_orderdate FROM orders QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_orderstatus)"""


@check("P15 A10", _LATEST)
def latest_of_each_group(fx: Fixtures) -> DataFrame:
    orders = fx.raw("orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    return latest_rows(orders, "o_orderstatus", "o_orderdate")


@check(
    "P16 P15 F13 O2",
    with_fx("ev", """SELECT day AS forecast_date, CAST(coalesce(max(digit), '0') AS INTEGER) AS diffusion_conditions FROM (
        SELECT substr(hour_at, 1, 10) AS day, hour_at, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 6 AS VARCHAR) END AS digit
        FROM ev QUALIFY hour_at = max(hour_at) OVER (PARTITION BY substr(hour_at, 1, 10))) GROUP BY day"""),
)
def latest_forecast_digit(fx: Fixtures) -> DataFrame:
    daily = P.daily_diffusion(fx.forecast())
    return daily.select("forecast_date", F.coalesce("diffusion", F.lit("0")).cast("int").alias("diffusion_conditions"))


@check(
    "J1 J3",
    with_fx("st cell", f"""SELECT c.id AS cell, s.station_code FROM cell c JOIN st s
        ON {sql_metres('c.lon', 'c.lat', 's.lon', 's.lat')} < 5000"""),
)
def cells_of_stations(fx: Fixtures) -> DataFrame:
    sites = fx.sites()
    placed = spread_to_centers(sites_of(sites), sites, ["station_code"], keep_site=True)
    return P.cell_sites(fx.cells(), placed).select(F.col("grid_id").alias("cell"), "station_code")
