"""Projections, filters and row-level cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.checks.fixtures import Fixtures, with_fx
from airway.checks.registry import check
from airway.functions.records import json_doubles
from airway.operators.cleaning import all_nonzero, blank_marks, null_columns, one_per_key, within
from airway.plans import obd
from airway.plans.feeds import station_dimension


@check("P1 P2 P3 P4 P13", """SELECT c_custkey AS station_code, c_name AS station_name, 'micro' AS station_type, CAST(NULL AS VARCHAR) AS humidity,
    CAST(NULL AS VARCHAR) AS pressure FROM customer""")
def renamed_and_filled(fx: Fixtures) -> DataFrame:
    """Rename, constant, typed nulls, dropped helpers; names match in any case."""
    renamed = fx.raw("customer").withColumnsRenamed({"C_CUSTKEY": "station_code", "c_name": "station_name"})
    filled = null_columns(renamed.withColumn("station_type", F.lit("micro")), ["humidity", "pressure"])
    return filled.drop("c_nationkey", "c_acctbal", "c_mktsegment").select(
        "station_code", "station_name", "station_type", "humidity", "pressure"
    )


@check("P5 P14", "SELECT event_id, value - 10 AS speed FROM events WHERE value - 10 > 0 AND event_id IS NOT NULL")
def moving_rows(fx: Fixtures) -> DataFrame:
    rows = fx.raw("events").select("event_id", (F.col("value") - 10).alias("speed"))
    return rows.where((F.col("speed") > 0) & F.col("event_id").isNotNull())


@check("P6 P14", with_fx("st", "SELECT station_code, station_level FROM st WHERE station_level IN ('nation', 'province', 'city') AND grid_id IS NOT NULL"))
def stations_of_levels(fx: Fixtures) -> DataFrame:
    rows = fx.stations()
    kept = rows.where(F.col("station_level").isin("nation", "province", "city") & F.col("grid_id").isNotNull())
    return kept.select("station_code", "station_level")


@check("P7", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-06-30'")
def closed_window(fx: Fixtures) -> DataFrame:
    return fx.raw("orders").where(within("o_orderdate", "1995-01-01 00:00:00", "1995-06-30 00:00:00", closed=True)).select("o_orderkey")


@check("P8 S12", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-06-30'")
def half_open_window(fx: Fixtures) -> DataFrame:
    return fx.raw("orders").where(within("o_orderdate", "1995-01-01 00:00:00", "1995-06-30 00:00:00")).select("o_orderkey")


@check("P9", with_fx("st", """SELECT station_name, grid_id, station_code, station_level, lon, lat FROM st
    WHERE district_code = '510107' AND station_type = 'micro_station'"""))
def dimension_filtered_by_hidden_columns(fx: Fixtures) -> DataFrame:
    chosen = station_dimension(fx.stations(), (F.col("district_code") == "510107") & (F.col("station_type") == "micro_station"))
    point = F.from_json("coord", "lon double, lat double")
    return chosen.withColumn("p", point).select("station_name", "grid_id", "station_code", "station_level", "p.lon", "p.lat")


@check("P10", with_fx("ev obd", "SELECT event_id FROM obd WHERE m6413 <> 0 AND m6415 <> 0 AND m6411 <> 0"))
def rows_with_nonzero_metrics(fx: Fixtures) -> DataFrame:
    """A quoted metric is no number and drops the row."""
    return fx.obd().where(all_nonzero(json_doubles("dynamic_data", obd.ACTIVITY_CODES), obd.ACTIVITY_CODES)).select("event_id")


@check("P11", """SELECT event_id, event_type FROM (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 4 <> 0 THEN event_id END AS hidden FROM events) WHERE event_type IS NOT NULL AND hidden IS NOT NULL""")
def rows_without_nulls(fx: Fixtures) -> DataFrame:
    """Every column counts, also one that is not kept."""
    n = F.col("event_id")
    rows = fx.raw("events").select(n, F.when(n % 10 != 0, F.col("event_type")).alias("event_type"), F.when(n % 4 != 0, n).alias("hidden"))
    return rows.na.drop().select("event_id", "event_type")


@check("P12", """SELECT user_id AS plate_num, hour_at, arg_min(event_id, ts) AS event_id, min(ts) AS ts FROM
    (SELECT *, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_at FROM events) GROUP BY 1, 2""")
def first_row_per_key(fx: Fixtures) -> DataFrame:
    rows = fx.raw("events").select(F.col("user_id").alias("plate_num"), F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("hour_at"), "ts", "event_id")
    return one_per_key(rows, ["plate_num", "hour_at"], ["ts"])


@check("P12", "SELECT source, lang, max(doc_id) AS doc_id, arg_max(n_chars, doc_id) AS n_chars FROM documents GROUP BY source, lang")
def last_row_per_key(fx: Fixtures) -> DataFrame:
    """Few keys hold nearly all rows."""
    return one_per_key(fx.raw("documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], ["doc_id"], last=True)


@check("P17", "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 9 AS VARCHAR) END AS co, event_type AS so2 FROM events")
def marks_to_null(fx: Fixtures) -> DataFrame:
    mark = F.when(F.col("event_type") == "error", F.lit("—")).otherwise((F.col("event_id") % 9).cast("string"))
    return blank_marks(fx.raw("events").select("event_id", mark.alias("co"), F.col("event_type").alias("so2")), ["co", "so2"])


@check("P18", "SELECT s_suppkey, '510116' || s_suppkey AS station_code FROM supplier")
def prefixed_codes(fx: Fixtures) -> DataFrame:
    return fx.raw("supplier").select("s_suppkey", F.concat(F.lit("510116"), F.col("s_suppkey").cast("string")).alias("station_code"))


@check("C19 P1", with_fx("ev", """SELECT user_id AS device_id, k AS scr_6413, value AS enter_air_6415, event_id % 7 AS ef_6411,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS published_at FROM ev"""))
def diagnostic_projection(fx: Fixtures) -> DataFrame:
    table = fx.events().select(
        F.col("user_id").alias("device_id"),
        F.col("k").alias("scr_6413"),
        F.col("value").alias("enter_air_6415"),
        (F.col("event_id") % 7).alias("ef_6411"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
        "props",
    )
    return obd.metric_projection(table)
