"""Scalar functions and hour grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.checks.fixtures import Fixtures, sql_metres, sql_point, sql_site, with_fx
from airway.checks.registry import check
from airway.functions import geo, records, times
from airway.operators.hours import HourRange, day_grid, day_hour_grid, hour_grid, into_slots

_ELON, _ELAT = sql_point("event_id")
_TLON, _TLAT = sql_site("user_id")


@check(
    "F1 F3",
    with_fx("ev", """SELECT event_id, lon, lat, CASE WHEN event_id % 13 <> 0 THEN value END AS oil FROM ev"""),
)
def json_members_as_numbers(fx: Fixtures) -> DataFrame:
    """Members read as numbers, quoted or not; a JSON null is null."""
    members = {"lon": "6423", "lat": "6422", "oil": "6420"}
    return records.json_columns(fx.obd(), "dynamic_data", members).select("event_id", *members)


@check(
    "F2",
    """SELECT event_id, (CAST(json_extract_string(props, '$.k') AS INTEGER) + CASE WHEN event_id % 3 <> 0 THEN event_id % 5 ELSE 0 END
        + user_id % 11)::DOUBLE AS flow FROM events""",
)
def json_sum_with_defaults(fx: Fixtures) -> DataFrame:
    data = F.to_json(
        F.struct(
            "event_id",
            F.col("k").alias("large"),
            F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 5).alias("middle"),
            (F.col("user_id") % 11).alias("small"),
        )
    )
    flow = records.json_sum("data", ["large", "middle", "small", "unknown"])
    return fx.events().withColumn("data", data).select("event_id", flow.alias("flow"))


@check(
    "F4 P10",
    with_fx("ev", """SELECT event_id, CAST(k AS DOUBLE) AS first, CASE WHEN event_id % 11 <> 0 THEN value END AS second FROM ev"""),
)
def json_typed_struct(fx: Fixtures) -> DataFrame:
    """A number in quotes is no number for a typed field."""
    n = F.col("event_id")
    second = F.when(n % 11 == 0, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(
        F.col("value").cast("string")
    )
    text = F.concat(F.lit('{"6413": '), F.col("k").cast("string"), F.lit(', "6415": '), second, F.lit("}"))
    parsed = records.json_doubles("text", ["6413", "6415"])
    rows = fx.events().withColumn("text", text).withColumn("p", parsed)
    return rows.select("event_id", F.col("p.6413").alias("first"), F.col("p.6415").alias("second"))


@check("F5", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events")
def json_members_as_rows(fx: Fixtures) -> DataFrame:
    return fx.raw("events").select("event_id", F.explode(records.json_map("props")).alias("key", "value"))


@check(
    "F6",
    """SELECT c_custkey, '{"id":' || c_custkey || CASE WHEN c_custkey % 3 <> 0 THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END
        || ',"nation":' || c_nationkey || '}' AS data FROM customer""",
)
def record_to_json(fx: Fixtures) -> DataFrame:
    """Fields in order, null ones left out."""
    rows = fx.raw("customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    return rows.select(F.col("id").alias("c_custkey"), records.all_fields_json(rows.columns).alias("data"))


@check(
    "F9",
    with_fx("ev", """SELECT event_id, unnest([0, 1]) AS position, unnest([CAST(k AS DOUBLE), CAST(event_id % 7 AS DOUBLE)]) AS a,
        unnest([value, NULL]) AS b FROM ev"""),
)
def pairs_text_to_rows(fx: Fixtures) -> DataFrame:
    """Second list has one member only."""
    text = F.concat(
        F.lit("[["), F.col("k").cast("string"), F.lit(", "), F.col("value").cast("string"), F.lit("],["),
        (F.col("event_id") % 7).cast("string"), F.lit("]]"),
    )
    rows = fx.events().select("event_id", F.posexplode(records.pair_texts(text)).alias("position", "pair"))
    return rows.select(
        "event_id", "position", records.pair_item(F.col("pair"), 0).alias("a"), records.pair_item(F.col("pair"), 1).alias("b")
    )


@check(
    "F8",
    """SELECT p_partkey, p_brand AS CarBrand, json_extract_string(j, '$.p_type') AS kind, json_extract_string(j, '$.p_size') AS size
       FROM (SELECT *, json_object('p_type', p_type, 'p_size', p_size) AS j FROM part)""",
)
def brand_from_record(fx: Fixtures) -> DataFrame:
    from airway.plans.feeds import vehicle_registry

    part = fx.raw("part").select("p_partkey", F.col("p_brand").alias("CarBrand"), "p_type", "p_size")
    info = vehicle_registry(part)
    member = lambda n: F.get_json_object("OtherInfo", f"$.{n}")
    return info.select(
        member("p_partkey").cast("bigint").alias("p_partkey"), "CarBrand", member("p_type").alias("kind"), member("p_size").alias("size")
    )


@check(
    "F11 F12 F15 F27",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, CAST(value AS DECIMAL(8,2)) AS amount,
        CAST(trunc(value) AS INTEGER) AS whole, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') END AS checked_day FROM events""",
)
def day_and_hour_of_text(fx: Fixtures) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    rows = fx.raw("events").withColumn("text", stamp)
    odd = F.when(F.col("event_id") % 2 == 0, F.col("text")).otherwise(F.lit("no time"))
    return rows.select(
        "event_id",
        times.day_of_text("text").alias("day"),
        F.substring("text", 12, 2).alias("hour"),
        F.col("value").cast("decimal(8,2)").alias("amount"),
        F.col("value").cast("int").alias("whole"),
        times.stamp_day(odd).alias("checked_day"),
    )


@check("F13", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, CAST(NULL AS INTEGER) AS none FROM orders")
def leading_digit_of_text(fx: Fixtures) -> DataFrame:
    return fx.raw("orders").select(
        "o_orderkey", times.leading_digit("o_orderpriority").alias("level"), times.leading_digit("o_orderstatus").alias("none")
    )


@check("F14 F12", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%H') AS hour FROM events")
def epoch_to_text(fx: Fixtures) -> DataFrame:
    rows = fx.raw("events").withColumn("epoch", F.unix_timestamp("ts"))
    return rows.select("event_id", times.epoch_text("epoch").alias("stamp"), times.hour_of(times.epoch_seconds("epoch")).alias("hour"))


@check("F16", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_at FROM events")
def dotnet_date_to_hour(fx: Fixtures) -> DataFrame:
    text = F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(")/"))
    return fx.raw("events").select("event_id", times.dotnet_hour(text).alias("hour_at"))


@check(
    "F14 F16",
    """SELECT event_id, strftime(ts - INTERVAL 60 YEAR + INTERVAL 8 HOUR, '%Y-%m-%d %H:00:00') AS hour_at,
        strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp FROM events""",
)
def epochs_of_an_eastern_feed(fx: Fixtures) -> DataFrame:
    """Epochs, some before 1970, on a clock eight hours east of the session's."""
    old = F.unix_timestamp(F.date_trunc("second", F.col("ts") - F.expr("INTERVAL 60 YEAR"))) * 1000
    text = F.concat(F.lit("/Date("), old.cast("string"), F.lit(")/"))
    rows = fx.raw("events").select("event_id", text.alias("at"), F.unix_timestamp("ts").alias("epoch"))
    return rows.select(
        "event_id", times.dotnet_hour("at", "+08:00").alias("hour_at"), times.epoch_text("epoch", "+08:00").alias("stamp")
    )


@check("F17", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def iso_to_stamp(fx: Fixtures) -> DataFrame:
    return fx.raw("events").select("event_id", times.iso_stamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("stamp"))


@check(
    "F18 F19",
    """SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS slashed, strftime(ts, '%Y-%m-%d %H:%M:%S') AS loose,
        CAST(NULL AS VARCHAR) AS broken FROM events""",
)
def loose_times_to_stamp(fx: Fixtures) -> DataFrame:
    return fx.raw("events").select(
        "event_id",
        times.slash_stamp(F.date_format("ts", "yyyy/MM/d HH:mm")).alias("slashed"),
        times.loose_stamp(F.date_format("ts", "yyyy-M-d H:m:s")).alias("loose"),
        times.loose_stamp("event_type").alias("broken"),
    )


@check(
    "F20 F21 F22",
    """SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:00:00') AS later, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:00:00') AS earlier,
        strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:59:59') AS later_end, strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:59:59') AS earlier_end,
        strftime(ts + INTERVAL 4 DAY, '%Y-%m-%d') AS next_days FROM events""",
)
def shifted_hours_and_days(fx: Fixtures) -> DataFrame:
    return fx.raw("events").select(
        "event_id",
        times.shift_hour_start("ts", 2).alias("later"),
        times.shift_hour_start("ts", -3).alias("earlier"),
        times.shift_hour_end("ts", 5).alias("later_end"),
        times.shift_hour_end("ts", -1).alias("earlier_end"),
        times.shift_day("ts", 4).alias("next_days"),
    )


@check(
    "F23 F24",
    f"""SELECT event_id, {sql_metres(_ELON, _ELAT, _TLON, _TLAT)} AS metres,
        {sql_metres(_ELON, _ELAT, _TLON, _TLAT)} * {sql_metres(_ELON, _ELAT, _TLON, _TLAT)} AS squared FROM events""",
)
def distances(fx: Fixtures) -> DataFrame:
    from airway.checks.fixtures import site_of

    lon, lat = site_of(F.col("user_id"))
    rows = fx.events().withColumns({"lon2": lon, "lat2": lat})
    return rows.select(
        "event_id",
        geo.haversine_m("lon", "lat", "lon2", "lat2").alias("metres"),
        geo.haversine_sq_m("lon", "lat", "lon2", "lat2").alias("squared"),
    )


@check(
    "F23 F24 J1",
    with_fx("ev st", f"""SELECT s.station_code, count(*) AS points FROM ev e JOIN st s
        ON {sql_metres('e.lon', 'e.lat', 's.lon', 's.lat')} < 2000 GROUP BY ALL"""),
)
def distance_in_sql_text(fx: Fixtures) -> DataFrame:
    """The distance function called from SQL on joined rows."""
    from airway.operators.spatial import SITE, radius_join, sites_of, spread_to_centers

    geo.register_sql_functions(fx.spark)
    sites, points = fx.sites(), fx.events().select("event_id", "lon", "lat")
    pairs = radius_join(points, sites_of(sites), 5000)
    close = pairs.where(F.expr("distance(lon, lat, center_lon, center_lat) < 2000 AND dis2(lon, lat, center_lon, center_lat) < 4000000"))
    counted = spread_to_centers(close.groupBy(*SITE).agg(F.count("*").alias("points")), sites, ["station_code"])
    return counted.groupBy("station_code").agg(F.sum("points").alias("points"))


_GX, _GY = f"({_ELON} - 105.0)", f"({_ELAT} - 35.0)"
_GCJ = f"""WITH p AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN {_ELON} - 60.0 ELSE {_ELON} END AS lon, {_ELAT} AS lat FROM events),
    q AS (SELECT *, lon - 105.0 AS x, lat - 35.0 AS y, 1 - 0.00669342162296594323 * pow(sin(lat * pi() / 180.0), 2) AS m FROM p),
    r AS (SELECT *,
        -100.0 + 2.0*x + 3.0*y + 0.2*y*y + 0.1*x*y + 0.2*sqrt(abs(x)) + (20.0*sin(6.0*x*pi()) + 20.0*sin(2.0*x*pi()))*2.0/3.0
          + (20.0*sin(y*pi()) + 40.0*sin(y/3.0*pi()))*2.0/3.0 + (160.0*sin(y/12.0*pi()) + 320.0*sin(y*pi()/30.0))*2.0/3.0 AS dy,
        300.0 + x + 2.0*y + 0.1*x*x + 0.1*x*y + 0.1*sqrt(abs(x)) + (20.0*sin(6.0*x*pi()) + 20.0*sin(2.0*x*pi()))*2.0/3.0
          + (20.0*sin(x*pi()) + 40.0*sin(x/3.0*pi()))*2.0/3.0 + (150.0*sin(x/12.0*pi()) + 300.0*sin(x/30.0*pi()))*2.0/3.0 AS dx FROM q)
    SELECT event_id,
        round(CASE WHEN lon < 72.004 THEN lon ELSE lon + dx * 180.0 / (6378245.0 / sqrt(m) * cos(lat * pi() / 180.0) * pi()) END, 5) AS lon,
        round(CASE WHEN lon < 72.004 THEN lat ELSE lat + dy * 180.0 / (6378245.0 * (1 - 0.00669342162296594323) / (m * sqrt(m)) * pi()) END, 5) AS lat
    FROM r"""


@check("F25", _GCJ)
def shifted_coordinates(fx: Fixtures) -> DataFrame:
    """One point in nine lies outside the box and stays."""
    out = F.when(F.col("event_id") % 9 == 0, F.col("lon") - 60).otherwise(F.col("lon"))
    rows = fx.events().withColumn("lon", out)
    lon, lat = geo.wgs84_to_gcj02("lon", "lat")
    return rows.select("event_id", F.round(lon, 5).alias("lon"), F.round(lat, 5).alias("lat"))


@check("F28", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, '00' || strftime(ts, '%y-%m-%d %H:%M:%S') AS literal FROM events")
def time_parts_to_stamp(fx: Fixtures) -> DataFrame:
    """A two-digit year is a year of the first century unless told otherwise."""
    parts = F.array(F.year("ts") % 100, F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts"), F.floor(F.second("ts")).cast("int"))
    rows = fx.raw("events").withColumn("time_list", parts)
    return rows.select("event_id", times.parts_stamp("time_list", 2000).alias("stamp"), times.parts_stamp("time_list").alias("literal"))


_HOURS = """SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS h FROM events"""


@check(
    "T1 F20 F21",
    f"""SELECT g.*, coalesce(n, 0) AS events FROM (SELECT strftime(h, '%Y-%m-%d %H:00:00') AS published_at, strftime(h, '%Y-%m-%d %H:00:00') AS start,
        strftime(h, '%Y-%m-%d %H:59:59') AS "end", strftime(h, '%Y-%m-%d') AS published_date, strftime(h, '%H') AS hour FROM ({_HOURS})) g
        LEFT JOIN (SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS published_at, count(*) AS n FROM events GROUP BY 1) e USING (published_at)""",
)
def hours_with_event_counts(fx: Fixtures) -> DataFrame:
    """Every hour between the first and last event, empty ones included."""
    events = fx.raw("events")
    grid = hour_grid(events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")), "a", "b")
    counted = events.groupBy(F.date_format("ts", times.HOUR_START).alias("published_at")).agg(F.count("*").alias("events"))
    return grid.join(counted, "published_at", "left").na.fill(0, ["events"])


@check(
    "T2",
    f"""SELECT strftime(h + INTERVAL 2 HOUR, '%Y-%m-%d %H:00:00') AS published_at, strftime(h, '%Y-%m-%d %H:00:00') AS start,
        strftime(h + INTERVAL 2 HOUR, '%Y-%m-%d %H:59:59') AS "end", strftime(h + INTERVAL 2 HOUR, '%Y-%m-%d') AS published_date,
        strftime(h, '%H') AS hour FROM ({_HOURS})""",
)
def hours_with_look_ahead(fx: Fixtures) -> DataFrame:
    bounds = fx.raw("events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return hour_grid(bounds, "a", "b", ahead=2, span=3)


@check(
    "T2 P7",
    """SELECT strftime(h + INTERVAL 2 HOUR, '%Y-%m-%d %H:00:00') AS published_at, count(*) AS points, count(DISTINCT user_id) AS users
       FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS h) g
       JOIN events ON ts BETWEEN h AND h + INTERVAL '2 hours 59 minutes 59.999999 seconds' GROUP BY 1""",
)
def events_in_overlapping_slots(fx: Fixtures) -> DataFrame:
    """Three-hour windows published two hours after their start."""
    hours = HourRange("2024-01-01 00:00:00", "2024-01-30 23:00:00", ahead=2, span=3)
    slotted = into_slots(fx.raw("events"), "ts", hours)
    grouped = slotted.groupBy("published_at").agg(F.count("*").alias("points"), F.count_distinct("user_id").alias("users"))
    return grouped.withColumn("published_at", F.date_format("published_at", times.STAMP))


@check(
    "T3 F22",
    """SELECT strftime(d, '%Y-%m-%d') AS day, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day FROM (SELECT
        unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders)""",
)
def days_between_orders(fx: Fixtures) -> DataFrame:
    return day_grid(fx.raw("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")), "a", "b")


@check(
    "T4",
    """SELECT strftime(d, '%Y-%m-%d') AS publish_date, lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM (SELECT
        unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS d FROM events),
        (SELECT unnest(generate_series(0, 23)) AS h)""",
)
def hours_of_every_day(fx: Fixtures) -> DataFrame:
    return day_hour_grid(fx.raw("events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")), "a", "b")
