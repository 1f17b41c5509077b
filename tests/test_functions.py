from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from relist.functions import arrays as A
from relist.functions import dates as D
from relist.functions import json as J
from relist.functions import strings as X


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], list(values))


AGES = [
    ("1 second ago", datetime(2020, 3, 31, 9, 59, 59)),
    ("30 seconds ago", datetime(2020, 3, 31, 9, 59, 30)),
    ("1 minute ago", datetime(2020, 3, 31, 9, 59)),
    ("5 MINUTES AGO", datetime(2020, 3, 31, 9, 55)),
    ("2hours ago", datetime(2020, 3, 31, 8)),
    ("3days ago", datetime(2020, 3, 28, 10)),
    ("\t 3 days ago\n", datetime(2020, 3, 28, 10)),
    ("3 daysago", datetime(2020, 3, 28, 10)),
    ("2 weeks ago", datetime(2020, 3, 17, 10)),
    ("1 month ago", datetime(2020, 2, 29, 10)),
    ("13 months ago", datetime(2019, 2, 28, 10)),
    ("1 year ago", None),
    ("yesterday", None),
    ("a day ago", None),
    ("3 days", None),
    ("-3 days ago", None),
    ("3 days ago ", None),
    ("3000000000 days ago", None),
    ("99999999999999999999 days ago", None),
    ("2000000000 days ago", None),
    ("", None),
    (None, None),
]


def test_relative_ages(spark):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(AGES)], "i int, age string")
    got = rows.select("i", D.relative_age_to_ts(F.col("age"), F.lit("2020-03-31 10:00:00").cast("timestamp")).alias("t")).orderBy("i").collect()
    assert [(AGES[r.i][0], r.t) for r in got] == AGES


def test_calendar_days_keep_the_wall_clock(spark):
    """30 days over the start of daylight saving time: 29 days 23 hours of elapsed time."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        r = spark.range(1).select(
            D.at_least_n_days_after(F.lit("2020-04-14 12:00:00").cast("timestamp"), F.lit("2020-03-15 12:00:00").cast("timestamp"), 30).alias("a"),
            D.at_least_n_days_after(F.lit("2020-04-14 11:59:59").cast("timestamp"), F.lit("2020-03-15 12:00:00").cast("timestamp"), 30).alias("b"),
            D.same_local_date(F.lit("2020-04-14 00:30:00").cast("timestamp"), F.lit("2020-04-14 23:30:00").cast("timestamp")).alias("c"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.a, r.b, r.c) == (True, False, True)


@pytest.mark.parametrize("text, ok", [
    ("2020-01-02T03:04:05", True), ("2020-01-02T03:04", True), ("2020-01-02t03:04:05.123456", True),
    ("2020-01-02T03:04:05Z", True), ("2020-01-02T03:04:05+07:00", True), ("2020-01-02T03:04:05+07:00[Asia/Ho_Chi_Minh]", True),
    ("2020-01-02", False), ("2020-01-02 03:04:05", False), ("2020-02-30T00:00:00", False), ("x", False), ("2020-01-02T03:04:05Z ", False),
])
def test_iso(spark, text, ok):
    row = one(spark, t=text)
    value = row.select(D.try_parse_iso(F.col("t")).alias("v")).first().v
    assert (value is not None) == ok
    if ok:
        assert value.replace(microsecond=0, second=0) == datetime(2020, 1, 2, 3, 4)
        assert row.select(D.parse_iso(F.col("t")).alias("v")).first().v == value
        assert spark.range(1).select(D.parse_bound(text).alias("v")).first().v == value
    else:
        with pytest.raises(Exception, match="Invalid date time"):
            row.select(D.parse_iso(F.col("t"))).collect()
        with pytest.raises(ValueError):
            D.parse_bound(text)


def test_epochs(spark):
    r = spark.range(1).select(
        D.ts_to_epoch_ms(D.epoch_s_to_ts(F.lit(1577530825))).alias("ms"),
        D.epoch_ms_to_ts(F.lit(1577530825000)).alias("ts"),
        D.epoch_s_to_ts(F.lit(9_223_372_036_855_000)).alias("huge"),
        D.ts_to_epoch_ms(D.run_time("2024-01-01T00:00:00.123456")).alias("now")).first()
    assert (r.ms, r.ts, r.huge, r.now) == (1577530825000, datetime(2019, 12, 28, 11, 0, 25), None, 1704067200123)


def test_strings(spark):
    r = one(spark, a="\x01\t x y \n\r", b="/it/x", c=" /it/x").select(
        X.trim_java(F.col("a")).alias("trim"), X.strip_prefix(F.col("b"), "/").alias("strip"),
        X.strip_prefix(F.col("c"), "/").alias("keep"), X.build_url("https://x.example", "/", F.lit(None).cast("string")).alias("null"),
        X.parse_int(F.lit("2147483648")).alias("overflow"), X.regex_capture(F.col("b"), "^/(z+)", 1).alias("none"),
        X.hex_id(F.lit("a"), F.lit(1)).alias("id")).first()
    assert (r.trim, r.strip, r.keep, r.null, r.overflow, r.none) == ("x y", "it/x", " /it/x", None, None, None)
    assert len(r.id) == 24


def test_arrays(spark):
    r = spark.range(1).select(
        A.map_trim_set(F.array(F.lit("a"), F.lit(" a"), F.lit("b\n"))).alias("set"),
        A.singleton_set(F.lit(None).cast("string")).alias("null"), A.singleton_set(F.lit("x")).alias("x"),
        A.append(F.array(F.lit(1), F.lit(2)), F.lit(2)).alias("append"),
        A.append(F.lit(None).cast("array<int>"), F.lit(2)).alias("append_null"),
        A.array_all_empty(F.lit(None).cast("array<int>")).alias("e1"), A.array_all_empty(F.array()).alias("e2"),
        A.array_all_empty(F.array(F.lit(1))).alias("e3"),
        A.flat_map_ids(F.array(F.lit("a"), F.lit(None))).alias("ids"),
        A.array_exists(F.lit(None).cast("array<int>"), lambda x: x > 0).alias("exists")).first()
    assert (r.set, r.null, r.x, r.append, r.append_null) == (["a", "b"], None, ["x"], [1, 2, 2], [2])
    assert (r.e1, r.e2, r.e3, r.ids, r.exists) == (True, True, False, ["a"], False)


@pytest.mark.parametrize("text, long, string, strings", [
    ('{"v": 5}', 5, None, None), ('{"v": "5"}', 5, "5", None), ('{"v": 5.0}', 5, None, None), ('{"v": 5.5}', None, None, None),
    ('{"v": 1e3}', 1000, None, None), ('{"v": "x"}', None, "x", None), ('{"v": null}', None, None, None), ("{}", None, None, None),
    ('{"v": true}', None, None, None), ('{"v": []}', None, None, []), ('{"v": ["a", "b", "a"]}', None, None, ["a", "b"]),
    ('{"v": ["a", null]}', None, None, None), ('{"v": ["a", 1]}', None, None, None), ('{"v": [1]}', None, None, None),
    ('{"v": -7}', -7, None, None), ('{"v": 99999999999999999999}', None, None, None), ('{"v": "a", "v": "b"}', None, "b", None),
    ("[1]", None, None, None), ('"x"', None, None, None),
])
def test_typed_json(spark, text, long, string, strings):
    v = J.json_parse(F.col("t"))
    r = one(spark, t=text).select(J.json_long(v, "$.v").alias("l"), J.json_string(v, "$.v").alias("s"), J.json_string_set(v, "$.v").alias("a")).first()
    assert (r.l, r.s, r.a) == (long, string, strings)


@pytest.mark.parametrize("text, ok", [
    ("{}", True), (" [1, 2] ", True), ("null", True), ("1", True), ("", False), ("  ", False), ("{", False), ("{} x", False),
    ("{}{}", False), ("{},{}", False), ("nope", False), ('{"a":1', False), ('{"a":1,"a":2}', True),
])
def test_json_is_one_value(spark, text, ok):
    assert one(spark, t=text).select(J.json_parse(F.col("t")).isNotNull().alias("ok")).first().ok is ok


def test_json_long_reads_whole_numbers_directly(spark):
    """A whole number needs no pattern, whatever its size; the other forms read as before."""
    texts = ["0", "-0", "7", "-12", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "5.0", "5.5", "1e3", '"12"', '"12.0"', '"x"', "true", "null", "[1]"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.try_parse_json("t").alias("v"))
    read = df.select("k", J.json_long(F.col("v"), "$").alias("n"))
    assert [r.n for r in read.orderBy("k").collect()] == [0, 0, 7, -12, 2 ** 63 - 1, -2 ** 63, None, 5, None, 1000, 12, 12, None, None, None, None]
    assert "LongType" in read._jdf.queryExecution().optimizedPlan().toString()
