"""Readers and writers: written to the shared work folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airway.checks.fixtures import Fixtures, with_fx
from airway.checks.joins import PORTRAIT_NEW, portraits_new, portraits_old
from airway.checks.registry import check
from airway.operators.hours import HourRange
from airway.plans import feeds, portrait, tracks
from airway.sources import scans, sinks, staging, swaps

_SIX = "lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0')"


def _six_hourly(fx: Fixtures) -> DataFrame:
    """Events with a date and a six-hour partition."""
    block = F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0")
    return fx.raw("events").select(
        "event_id", "user_id", "value", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("publish_date"), block.alias("hour")
    )


def _fresh(fx: Fixtures, name: str) -> str:
    return staging.staging_path(fx.spark, name)


def _table(fx: Fixtures, schema: str, keys: tuple[str, ...]) -> str:
    name = f"airway_{uuid.uuid4().hex}"
    sinks.create_partitioned_table(fx.spark, name, schema, keys, _fresh(fx, "table"))
    return name


@check("S1 P1", with_fx("st", "SELECT station_name, grid_id, station_code, station_level FROM st"))
def dimension_scan(fx: Fixtures) -> DataFrame:
    """Whole table through the resolver, projected to fixed columns."""
    load = scans.Tables(fx.spark, {"supplier": f"{fx.sf_dir}/supplier.parquet"})
    level = F.get(F.array(*[F.lit(x) for x in ["nation", "province", "city", "county"]]), (F.col("s_suppkey") % 4).cast("int"))
    return load("supplier").select(
        F.col("s_name").alias("station_name"),
        F.col("s_nationkey").alias("grid_id"),
        F.col("s_suppkey").cast("string").alias("station_code"),
        level.alias("station_level"),
    )


@check(
    "S2 F1",
    """SELECT user_id AS plate_num, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND value > 10""",
)
def filtered_scan(fx: Fixtures) -> DataFrame:
    """What the source database was asked for as a subquery: filter, projection
    and JSON member, left to Catalyst to push down."""
    from airway.functions.records import json_number
    from airway.operators.cleaning import within

    load = scans.Tables(fx.spark, {"events": f"{fx.sf_dir}/events.parquet"})
    rows = load("events").where(within("ts", "2024-01-05 00:00:00", "2024-01-20 00:00:00", closed=True) & (F.col("value") > 10))
    return rows.select(F.col("user_id").alias("plate_num"), json_number("props", "k").alias("k"))


@check("S3", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def catalog_scan(fx: Fixtures) -> DataFrame:
    name = f"airway_events_{uuid.uuid4().hex}"
    fx.raw("events").createOrReplaceTempView(name)
    return scans.Tables(fx.spark)(name).groupBy("event_type").agg(F.count("*").alias("n"))


@check(
    "S3 S4 K3",
    f"""SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour FROM events
        WHERE ts >= TIMESTAMP '2024-01-04 06:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
)
def catalog_partitions_in_range(fx: Fixtures) -> DataFrame:
    """A partitioned catalog table, filled by position and read by hours."""
    columns = ["event_id", "value", *scans.HOUR_KEYS]
    name = _table(fx, "event_id bigint, value double, publish_date string, hour string", scans.HOUR_KEYS)
    sinks.insert_positional(_six_hourly(fx), name, columns, scans.HOUR_KEYS)
    return scans.in_hours(scans.Tables(fx.spark)(name), "2024-01-04 06:00:00", "2024-01-20 11:00:00")


@check("S12 P8", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1994-03-01' AND o_orderdate < TIMESTAMP '1996-03-01'")
def window_scan(fx: Fixtures) -> DataFrame:
    load = scans.Tables(fx.spark, {"orders": f"{fx.sf_dir}/orders.parquet"})
    return load.window("orders", "o_orderdate", "1994-03-01 00:00:00", "1996-03-01 00:00:00").select("o_orderkey", "o_totalprice")


@check(
    "S4 S5 S6 K1",
    f"""SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour FROM events
        WHERE ts >= TIMESTAMP '2024-01-04 06:00:00'""",
)
def partitions_in_range(fx: Fixtures) -> DataFrame:
    """Range runs past the last partition and over hours that have none."""
    path = _fresh(fx, "partitions")
    sinks.write_partitions(_six_hourly(fx), path)
    found = scans.read_hours(fx.spark, path, HourRange("2024-01-04 05:00:00", "2024-03-01 00:00:00"))
    return found.select("event_id", "value", "publish_date", "hour")


@check("K1", f"SELECT strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour, 2 * count(*) AS n FROM events GROUP BY 1, 2")
def appended_partitions(fx: Fixtures) -> DataFrame:
    """The same rows appended twice are there twice."""
    path = _fresh(fx, "append")
    for _ in range(2):
        sinks.write_partitions(_six_hourly(fx), path)
    return scans.read_partitioned(fx.spark, path).groupBy("publish_date", "hour").agg(F.count("*").alias("n"))


@check(
    "K2",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour,
        CASE WHEN {_SIX} = '06' THEN -1.0 ELSE value END AS value FROM events""",
)
def replaced_partitions(fx: Fixtures) -> DataFrame:
    """Overwriting touches the partitions that are written and no others."""
    path = _fresh(fx, "replace")
    rows = _six_hourly(fx).drop("user_id")
    sinks.write_partitions(rows, path)
    sinks.write_partitions(rows.where(F.col("hour") == "06").withColumn("value", F.lit(-1.0)), path, overwrite=True)
    return scans.read_partitioned(fx.spark, path).select("event_id", "publish_date", "hour", "value")


_TRACK_SCHEMA = "event_id bigint, user_id bigint, value double, publish_date string, hour string"


@check("K3 K4", f"SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour FROM events UNION ALL SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d'), {_SIX} FROM events WHERE event_type = 'error'")
def positional_insert(fx: Fixtures) -> DataFrame:
    table = _table(fx, _TRACK_SCHEMA, ("publish_date", "hour"))
    rows = _six_hourly(fx)
    columns = ["event_id", "user_id", "value", "publish_date", "hour"]
    sinks.insert_positional(rows, table, columns, scans.HOUR_KEYS)
    sinks.insert_positional(rows.where(F.col("event_type") == "error"), table, columns, scans.HOUR_KEYS)
    return fx.spark.table(table)


@check("K5 C18", "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS publish_month FROM orders WHERE o_orderstatus <> 'F'")
def full_overwrite(fx: Fixtures) -> DataFrame:
    """A full load replaces the whole table."""
    table = _table(fx, "o_orderkey bigint, o_totalprice double, publish_month string", ("publish_month",))
    rows = fx.raw("orders").withColumn("publish_month", F.date_format("o_orderdate", "yyyy-MM"))
    columns = ["o_orderkey", "o_totalprice", "publish_month"]
    sinks.insert_positional(rows, table, columns, ("publish_month",))
    sinks.insert_positional(rows.where(F.col("o_orderstatus") != "F"), table, columns, ("publish_month",), overwrite=True)
    return fx.spark.table(table)


_TEXT = """'{"a":' || a || ',"b":"' || b || '","c":' || c || '}'"""
_OLD_TEXT = _TEXT.replace("|| a ||", "|| old_a ||")


@check(
    "K6 C17 S12",
    f"""WITH p AS ({PORTRAIT_NEW}) SELECT grid_id, station_code, station_name, published_at, substr(published_at, 12, 2) AS hour,
        CASE WHEN published_at >= '1970-01-01 06:00:00' AND published_at < '1970-01-01 15:00:00' THEN {_TEXT} ELSE {_OLD_TEXT} END AS data
        FROM p WHERE grid_id >= 4 OR (published_at >= '1970-01-01 06:00:00' AND published_at < '1970-01-01 15:00:00')""",
)
def window_copied_by_upsert(fx: Fixtures) -> DataFrame:
    """Rows of a time window copied into a stored dataset by key."""
    from airway.operators.cleaning import within

    path = _fresh(fx, "portraits")
    hour = F.substring("published_at", 12, 2)
    sinks.write_partitions(portraits_old(fx).withColumn("hour", hour), path, ("hour",))
    window = portraits_new(fx).where(within("published_at", "1970-01-01 06:00:00", "1970-01-01 15:00:00"))
    sinks.upsert_partitions(window.withColumn("hour", hour), path, portrait.KEYS, ("hour",))
    return scans.read_partitioned(fx.spark, path)


@check(
    "C18 S12 F11 K3",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS publish_day FROM orders
       WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-05-01'""",
)
def window_import_by_day(fx: Fixtures) -> DataFrame:
    table = _table(fx, "o_orderkey bigint, o_totalprice double, publish_day string", ("publish_day",))
    rows = tracks.window_import(fx.raw("orders"), "o_orderdate", "1995-01-01 00:00:00", "1995-05-01 00:00:00")
    sinks.insert_positional(rows, table, ["o_orderkey", "o_totalprice", "publish_day"], ("publish_day",))
    return fx.spark.table(table)


@check(
    "C14 S5 S6 K1 K2 T1",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour, count(*) AS n, sum(event_id)::BIGINT AS total,
        CASE WHEN ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-30' THEN 1::BIGINT END AS files
        FROM events GROUP BY 1, 2, 5""",
)
def compacted_partitions(fx: Fixtures) -> DataFrame:
    """Small files of a date range merged in place; one file per partition is left
    there, other dates keep theirs."""
    path = _fresh(fx, "small")
    rows = _six_hourly(fx).withColumn("_spread", F.col("event_id") % 3).repartition(3, "_spread").drop("_spread")
    rows.write.partitionBy(*scans.HOUR_KEYS).parquet(path)
    sinks.compact(fx.spark, path, path, lambda df: df.where(F.col("publish_date").between("2024-01-02", "2024-01-29")))
    counted = (
        scans.read_partitioned(fx.spark, path)
        .groupBy("publish_date", "hour")
        .agg(F.count("*").alias("n"), F.sum("event_id").alias("total"), F.count_distinct("_metadata.file_path").alias("_files"))
    )
    merged = F.col("publish_date").between("2024-01-02", "2024-01-29")
    return counted.withColumn("files", F.when(merged, F.col("_files"))).drop("_files")


@check(
    "C14 S5 K1",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour, count(*) AS n, sum(event_id)::BIGINT AS total,
        CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1::BIGINT ELSE 2::BIGINT END AS files,
        CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0::BIGINT ELSE 2::BIGINT END AS untouched FROM events GROUP BY 1, 2, 5, 6""",
)
def small_files_merged(fx: Fixtures) -> DataFrame:
    """Partitions of early dates have small files, the others files of a good size (here: the
    mean of theirs is above the bound that the early ones' largest file sets). Which to merge
    is planned from the listing; ``untouched`` counts files that were there before."""
    path = _fresh(fx, "sizes")
    rows = _six_hourly(fx).withColumn("pad", F.lit(""))
    early = F.col("publish_date") < "2024-01-10"
    wide = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat(F.col("event_id"), i), 512)), "")
    for part in range(2):
        mine = rows.where(F.col("event_id") % 2 == part)
        sinks.write_partitions(mine.where(early), path)
        # Padding is hex text: half its bytes say nothing, and snappy keeps them.
        sinks.write_partitions(mine.where(~early).drop("pad"), path, derived={"pad": wide}, compression="zstd")
    # Both parts are there in every partition.
    sinks.write_partitions(rows.where(early).limit(0), path)
    listed = staging.staged(swaps.listed_files(fx.spark, path, scans.HOUR_KEYS), "listed")
    largest = listed.where(early).agg(F.max("bytes")).first()[0]
    sinks.merge_small_files(fx.spark, path, below=largest + 1, target_bytes=1_000 * largest)
    found = swaps.with_files(scans.read_partitioned(fx.spark, path))
    before = listed.select(swaps.same_form(F.col("_file")).alias("_before"))
    marked = found.join(before, swaps.same_form(F.col("_file")) == F.col("_before"), "left")
    return marked.groupBy("publish_date", "hour").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("total"), F.count_distinct("_file").alias("files"), F.count_distinct("_before").alias("untouched")
    )


@check(
    "C14 K6",
    f"SELECT event_id, value + 1 AS value, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour FROM events WHERE ts < TIMESTAMP '2024-01-15' "
    f"UNION ALL SELECT event_id, value, strftime(ts, '%Y-%m-%d'), {_SIX} FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
)
def swap_finished_by_the_next_run(fx: Fixtures) -> DataFrame:
    """A run promised its swap and died, files landed afterwards; the next run finishes the
    swap first and loses neither."""
    path = _fresh(fx, "promised")
    rows = _six_hourly(fx).select("event_id", "value", *scans.HOUR_KEYS)
    first, late = rows.where("publish_date < '2024-01-15'"), rows.where("publish_date >= '2024-01-15'")
    sinks.write_partitions(first, path)
    swap = swaps.Swap(fx.spark, path)
    stored = swaps.with_files(scans.read_partitioned(fx.spark, path))
    sinks.write_partitions(stored.drop("_file").withColumn("value", F.col("value") + 1), swap.data)
    swap.promise(stored.select("_file"))
    sinks.write_partitions(late, path)
    sinks.compact(fx.spark, path, path, lambda df: df)
    return scans.read_partitioned(fx.spark, path).select("event_id", "value", *scans.HOUR_KEYS)


@check(
    "K6 C17",
    """SELECT s_suppkey AS station, s_name AS name, CASE WHEN s_suppkey % 7 = 0 THEN 'moved' ELSE 'stayed' END AS state,
        CASE WHEN s_suppkey % 7 = 0 THEN '2024-02-0' || (s_suppkey % 3 + 1) ELSE '2024-01-0' || (s_suppkey % 5 + 1) END AS publish_date FROM supplier""",
)
def keys_that_moved(fx: Fixtures) -> DataFrame:
    """Keys stored under one day come again under another: each is there once."""
    path, key = _fresh(fx, "moved"), F.col("station")

    def day(month: str, days: int):
        return F.concat(F.lit(f"2024-{month}-0"), (key % days + 1).cast("string")).alias("publish_date")

    every = fx.raw("supplier").select(F.col("s_suppkey").alias("station"), F.col("s_name").alias("name"))
    for state, rows, month, days in (("stayed", every, "01", 5), ("moved", every.where(key % 7 == 0), "02", 3)):
        batch = rows.select("station", "name", F.lit(state).alias("state"), day(month, days))
        sinks.upsert_partitions(batch, path, ["station"], ("publish_date",), key_buckets=8)
    return scans.read_partitioned(fx.spark, path)


@check(
    "S6 S4",
    f"""SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS publish_date, {_SIX} AS hour FROM events
        WHERE NOT (strftime(ts, '%d') IN ('05', '17') AND {_SIX} = '06')""",
)
def whole_partitions_only(fx: Fixtures) -> DataFrame:
    """Two partitions hold a broken file beside good ones and are left out; a valid file
    without rows leaves its partition in."""
    path = _fresh(fx, "broken")
    rows = _six_hourly(fx).select("event_id", "value", *scans.HOUR_KEYS)
    sinks.write_partitions(rows, path)
    for day in ("05", "17"):
        folder = f"{path}/publish_date=2024-01-{day}/hour=06"
        swaps.write_bytes(fx.spark, f"{folder}/part-broken.parquet", b"PAR1 cut short")
    empty = rows.limit(0).select("event_id", "value").coalesce(1)
    empty.write.mode("append").parquet(f"{path}/publish_date=2024-01-09/hour=12")
    found, report = scans.read_whole_partitions(fx.spark, path)
    # Named in the report are the two broken files and no others; else nothing comes back.
    named = report.agg((F.count("*") == 2) & F.bool_and(F.col("path").endswith("part-broken.parquet"))).scalar()
    return found.where(named)


@check(
    "C7 K6 S5",
    with_fx("ev obd", "SELECT device_id, lon, lat, oil, published_at FROM obd WHERE oil IS NOT NULL AND error_data IS NOT NULL"),
)
def diagnostics_as_files_arrive(fx: Fixtures) -> DataFrame:
    """Landed files flattened and upserted in two runs; the second run finds all
    rows of the first again and replaces them."""
    from airway.plans import obd
    from airway.streaming.hourly import upsert_new_files

    landed, target, progress = (_fresh(fx, n) for n in ("landed", "flat", "progress"))
    rows = fx.obd()

    def flat(batch: DataFrame) -> DataFrame:
        return obd.flatten(batch).withColumn("publish_date", F.substring("published_at", 1, 10))

    for part in (rows.where(F.col("published_at") < "2024-01-16"), rows):
        part.write.mode("append").parquet(landed)
        upsert_new_files(
            fx.spark, landed, rows.schema, flat, target, progress, ["device_id", "published_at"], ("publish_date",)
        )
    return scans.read_partitioned(fx.spark, target).drop("publish_date")


def _broken_lines(fx: Fixtures) -> DataFrame:
    """CSV lines with two unquoted JSON fields; some are cut short, some end
    without a time."""
    n = F.col("event_id")
    line = F.concat_ws(
        ",", n, F.col("user_id"), F.concat(F.lit("S"), F.col("user_id")), F.col("k"),
        F.to_json(F.struct("lon", "lat")),
        F.concat(F.lit('{"a":'), F.col("k"), F.lit(',"b":2,"c":'), n, F.lit("}")),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    )
    cut = F.when(n % 17 == 0, F.concat_ws(",", n, F.lit("cut"))).when(n % 19 == 0, F.regexp_replace(line, "[^,]*$", ""))
    return fx.events().select(F.coalesce(cut, line).alias("id,station_id,station_code,grid_id,coord,data,published_at"))


def _landed_lines(fx: Fixtures) -> DataFrame:
    path = _fresh(fx, "lines")
    _broken_lines(fx).write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    return scans.read_text_lines(fx.spark, path)


@check(
    "C13 S7 F10 F15 K4 T3",
    with_fx("ev csv", """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS station_id, 'S' || user_id AS station_code,
        CAST(k AS VARCHAR) AS grid_id, '{"lon":' || lon || ',"lat":' || lat || '}' AS coord, '{"a":' || k || ',"b":2,"c":' || event_id || '}' AS data,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS published_at, strftime(ts, '%Y-%m-%d') AS publish_date
        FROM csv WHERE fault IS NULL"""),
)
def mobile_csv_repaired(fx: Fixtures) -> DataFrame:
    good, _ = feeds.repair_csv(_landed_lines(fx))
    schema = "id string, station_id string, station_code string, grid_id string, coord string, data string, published_at string, publish_date string"
    table = _table(fx, schema, ("publish_date",))
    sinks.insert_positional(good, table, [c.split()[0] for c in schema.split(", ")], ("publish_date",))
    return fx.spark.table(table)


@check(
    "C13 F10",
    with_fx("ev csv", "SELECT fault AS reason, count(*) AS n FROM csv WHERE fault IS NOT NULL GROUP BY 1"),
)
def mobile_csv_rejects(fx: Fixtures) -> DataFrame:
    _, rejected = feeds.repair_csv(_landed_lines(fx))
    reason = F.when(F.col("value").endswith(",cut"), "short").otherwise("no time")
    return rejected.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@check("S11", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_with_header(fx: Fixtures) -> DataFrame:
    path = _fresh(fx, "csv")
    fx.raw("customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(path)
    return scans.read_csv(fx.spark, path)


@check("S10 C16 F8", "SELECT p_brand AS CarBrand, count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM part GROUP BY 1")
def vehicle_registry_documents(fx: Fixtures) -> DataFrame:
    """Landed JSON objects with an inferred schema: brand and whole record."""
    path = _fresh(fx, "registry")
    part = fx.raw("part").select("p_partkey", F.col("p_brand").alias("CarBrand"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("kind"))
    part.select(F.to_json(F.struct(*part.columns))).write.text(path)
    found = feeds.vehicle_registry(scans.read_json_documents(fx.spark, path))
    key = F.get_json_object("OtherInfo", "$.p_partkey").cast("bigint")
    return found.groupBy("CarBrand").agg(F.count("*").alias("n"), F.sum(key).alias("keys"))


@check("S8", with_fx("ev", "SELECT 2 * event_id AS id, k AS co FROM ev UNION ALL SELECT 2 * event_id + 1, NULL FROM ev"))
def json_array_documents(fx: Fixtures) -> DataFrame:
    """Each landed line is an array of two records; the second lacks a field."""
    path = _fresh(fx, "arrays")
    first = F.to_json(F.struct((F.col("event_id") * 2).alias("id"), F.col("k").alias("CO")))
    second = F.to_json(F.struct((F.col("event_id") * 2 + 1).alias("id")))
    fx.events().select(F.concat(F.lit("["), first, F.lit(","), second, F.lit("]"))).write.text(path)
    return scans.read_json_documents(fx.spark, path).select("id", F.col("co").cast("int").alias("co"))


@check("S9", with_fx("ev", "SELECT CAST(event_id AS VARCHAR) AS \"StationCode\", CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS \"AQI\" FROM ev"))
def json_declared_fields(fx: Fixtures) -> DataFrame:
    """Only declared fields are read; an absent one is null."""
    record = F.struct(
        F.col("event_id").alias("StationCode"), F.when(F.col("k") % 2 == 0, F.col("k")).alias("AQI"), F.lit("x").alias("Undeclared")
    )
    documents = fx.events().select(F.to_json(F.array(record)).alias("body"))
    return scans.inline_records(documents, "body", ["StationCode", "AQI"])
