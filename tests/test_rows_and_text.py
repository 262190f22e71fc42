import json

from pyspark.sql import functions as F

from airway.functions import records, times
from airway.operators.cleaning import all_nonzero, blank_marks, one_per_key
from airway.plans import feeds, obd
from tests.helpers import rows


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column("v").alias("r")).first()["r"]


def test_times(spark):
    assert one(spark, times.dotnet_hour, "/Date(1675313999000)/") == "2023-02-02 04:00:00"
    assert one(spark, times.dotnet_hour, "none") is None
    assert one(spark, times.iso_stamp, "2022-01-01T05:06:07.123") == "2022-01-01 05:06:07"
    assert one(spark, times.slash_stamp, "2022/12/7 09:05") == "2022-12-07 09:05:00"
    assert one(spark, times.loose_stamp, "2022-1-7 9:5:3") == "2022-01-07 09:05:03"
    assert one(spark, times.loose_stamp, "yesterday") is None
    assert one(spark, lambda c: times.shift_hour_start(F.col(c).cast("timestamp"), 2), "2022-12-31 22:40:00") == "2023-01-01 00:00:00"
    assert one(spark, lambda c: times.shift_hour_end(F.col(c).cast("timestamp"), -1), "2022-01-01 00:59:59") == "2021-12-31 23:59:59"
    assert one(spark, times.leading_digit, "5-LOW") == 5 and one(spark, times.leading_digit, "x") is None


def test_time_parts(spark):
    df = spark.createDataFrame([([23, 4, 12, 10, 53, 39],), ([21, 6, 30, 8, 45, 12],), ([21, 13, 1, 0, 0, 0],)], "p array<int>")
    assert [r[0] for r in df.select(times.parts_stamp("p")).collect()] == ["0023-04-12 10:53:39", "0021-06-30 08:45:12", None]
    assert df.select(times.parts_stamp("p", 2000)).first()[0] == "2023-04-12 10:53:39"


def test_pair_text(spark):
    parsed = lambda text: one(spark, records.pair_texts, text)
    assert parsed("[[1, 2],[3.5, x]]") == [["1", "2"], ["3.5", "x"]]
    assert parsed("[]") == [[""]] and parsed(None) is None
    df = spark.createDataFrame([("[[ 1.6 , 2],[x, 4],[]]",)], "t string").select(F.explode(records.pair_texts("t")).alias("p"))
    got = rows(df.select(records.pair_item(F.col("p"), 0).alias("a"), records.pair_item(F.col("p"), 1).alias("b")))
    assert got == [(1.6, 2.0), (None, 4.0), (None, None)]


def test_json_members(spark):
    df = spark.createDataFrame([('{"a": 1.5, "b": "2"}',), ('{"a": null}',), ("broken",), (None,)], "j string")
    got = records.json_columns(df, "j", {"x": "a", "y": "b"}, keep_payload=True)
    assert [(r["x"], r["y"]) for r in got.collect()] == [(1.5, 2.0), (None, None), (None, None), (None, None)]
    assert [r[0] for r in df.select(records.json_sum("j", ["a", "b", "c"])).collect()] == [3.5, 0.0, 0.0, 0.0]
    typed = df.select(records.json_doubles("j", ["a", "b"]).alias("d")).first()["d"]
    assert (typed["a"], typed["b"]) == (1.5, None)


def test_json_merges_keep_value_types(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": [1]}, "n": null}', '{"a": "x", "b": null, "d": 2.5}')], "l string, r string")
    merged, patched = df.select(records.json_merge("l", "r"), records.json_merge_patch("l", "r")).first()
    assert json.loads(merged) == {"a": "x", "b": None, "n": None, "d": 2.5}
    assert json.loads(patched) == {"a": "x", "n": None, "d": 2.5}


def test_missing_mark(spark):
    df = spark.createDataFrame([("—", "-"), ("12", None)], "a string, b string")
    assert rows(blank_marks(df, ["a", "b"])) == [("12", None), (None, "-")]


def test_nonzero_struct(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":2}'), (2, '{"a":0,"b":2}'), (3, '{"a":1}'), (4, '{"a":1,"b":"2"}'), (5, None)], "i int, j string")
    assert rows(df.where(all_nonzero(records.json_doubles("j", ["a", "b"]), ["a", "b"])), "i") == [(1,)]


def test_one_per_key_is_deterministic(spark):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(one_per_key(df, ["k"], ["t"])) == [("k", 1, "a"), (None, 4, "m")]
    assert rows(one_per_key(df.repartition(4), ["k"], ["t"], last=True)) == [("k", 2, "b"), (None, 5, "n")]


def test_csv_repair(spark):
    lines = [
        '1,2,S,9,{"lon":1.0,"lat":2.0},{"a":1,"b":2},2023-03-14 01:02:03',
        '1,2,S,9,{"lon":1.0,"lat":2.0},{"a":1},2023-03-14 01:02:03',
        '1,2,S,9,{"lon":1.0,"lat":2.0},{"a":1,"b":2},',
        "1,2,3",
        "",
    ]
    good, rejected = feeds.repair_csv(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(good, "coord", "data", "publish_date") == [
        ('{"lon":1.0,"lat":2.0}', '{"a":1,"b":2}', "2023-03-14"),
        ('{"lon":1.0,"lat":2.0}', '{"a":1}', "2023-03-14"),
    ]
    assert rejected.count() == 3


def obd_rows(spark):
    ok, zero = '{"6413":1,"6415":2,"6411":3}', '{"6413":0,"6415":2,"6411":3}'
    data = [(1, ok, "e", "t")] * 3 + [(2, ok, "e", "t")] * 2 + [(2, zero, "e", "t")] * 5 + [(None, ok, "e", "t")] * 9
    return spark.createDataFrame(data, "device_id int, dynamic_data string, error_data string, published_at string")


def test_active_device_orders_differ(spark):
    df = obd_rows(spark)
    assert {r["device_id"] for r in obd.active_filter_first(df, 2).collect()} == {1}
    assert sorted(r["device_id"] for r in obd.active_count_first(df, 2).collect()) == [1, 1, 1, 2, 2]


def test_active_devices_without_broadcast(spark, no_broadcast):
    assert obd.active_count_first(obd_rows(spark), 2).count() == 5


def test_flatten_drops_rows_with_any_null(spark):
    payload = '{"6423":"104.1","6422":30.5,"6420":7}'
    data = [(1, payload, "e", "t"), (2, payload, None, "t"), (3, '{"6423":1}', "e", "t")]
    df = spark.createDataFrame(data, "device_id int, dynamic_data string, error_data string, published_at string")
    assert rows(obd.flatten(df)) == [(1, 104.1, 30.5, 7.0, "t")]


def test_merge_patch_goes_down_and_takes_the_last_of_repeated_members(spark):
    rows = [
        ('{"a":{"x":1,"y":2},"b":1}', '{"a":{"y":3,"x":null},"b":null,"c":{"d":null,"e":1.5}}'),
        ('{"a":1,"a":2}', '{"b":"é","b":[1,{"z":null}]}'),
        (None, "no json"),
        ('{"a":[1]}', '{"a":{"k":7}}'),
    ]
    df = spark.createDataFrame(rows, "l string, r string")
    got = [tuple(r) for r in df.select(records.json_merge_patch("l", "r"), records.json_merge("l", "r")).collect()]
    assert [g[0] for g in got] == ['{"a":{"y":3},"c":{"e":1.5}}', '{"a":2,"b":[1,{"z":null}]}', "{}", '{"a":{"k":7}}']
    assert got[1][1] == '{"a":2,"b":[1,{"z":null}]}' and got[3][1] == '{"a":{"k":7}}'
