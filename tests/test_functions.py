"""Column functions on hand-written edge rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from beatline.functions import (
    day_segment, field, first_list_item, haversine_km, label_of,
    parse_date, parse_money, parse_timestamp, thousands, to_int,
)


def test_day_segment_boundaries(spark):
    cases = {
        0: "Night", 458: "Night", 459: "Undefined", 499: "Undefined", 500: "Morning",
        1158: "Morning", 1159: "Undefined", 1200: "Afternoon", 1658: "Afternoon",
        1659: "Undefined", 1700: "Evening", 2058: "Evening", 2059: "Undefined",
        2100: "Night", 2359: "Night", 2400: "Undefined", None: "Undefined",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t int")
    got = {r.t: r.s for r in df.select("t", day_segment("t").alias("s")).collect()}
    assert got == cases


def test_parse_timestamp_and_date(spark):
    rows = [("03/01/2020 12:00:00 AM",), ("03/01/2020 11:59:00 PM",), ("x",), (None,),
            ("13/45/2020 11:59:00 PM",)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(parse_timestamp("s").alias("ts"), parse_date("s").alias("d")).collect()
    assert out[0].ts == dt.datetime(2020, 3, 1, 0, 0) and out[0].d == dt.date(2020, 3, 1)
    assert out[1].ts == dt.datetime(2020, 3, 1, 23, 59)
    assert all(r.ts is None and r.d is None for r in out[2:])
    assert df.select(parse_timestamp("s")).schema[0].dataType.simpleString() == "timestamp_ntz"


def test_parse_money(spark):
    rows = [("$1,234",), ("---",), ("No 2021 estimate ($90,546 in 2020)",), (None,), ("$166,021",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_money("s")).collect()]
    assert got == [1234.0, None, None, None, 166021.0]


def test_labels(spark):
    df = spark.createDataFrame([("B",), ("X",), ("Q",), (None,), ("Z",)], "c string")
    got = [r[0] for r in df.select(label_of("c")).collect()]
    assert got == ["Black", "Unknown", "Unknown", "Unknown", "Asian Indian"]


def test_zip_head_and_to_int(spark):
    df = spark.createDataFrame([("90001,90002",), ("90003",), ("N/A",), (None,), ("",)], "z string")
    out = df.select(first_list_item("z").alias("h"), to_int(first_list_item("z")).alias("i")).collect()
    assert [r.h for r in out] == ["90001", "90003", "N/A", None, ""]
    assert [r.i for r in out] == [90001, 90003, None, None, None]


def test_haversine(spark):
    rows = [(34.0, -118.0, 34.0, -118.0), (None, -118.0, 34.0, -118.0),
            (34.0, None, 34.0, -118.0), (34.0, -118.0, None, -118.0), (34.0, -118.0, 34.0, None),
            (33.7576608970001, -118.289241553, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert got[1:5] == [None] * 4
    # independent check in Python
    la1, lo1, la2, lo2 = map(math.radians, (33.7576608970001, -118.289241553, 0.0, 0.0))
    a = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    assert got[5] == pytest.approx(6371 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)), rel=1e-12)


def test_thousands(spark):
    df = spark.createDataFrame([(12345.6786,), (None,), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(thousands("x", 3)).collect()] == ["12,345.679", None, "∞"]


def test_field_is_a_plain_split(spark):
    ldf = spark.createDataFrame([('a,"b,c",,"q""t"',), ("short",)], "value string")
    got = [tuple(r) for r in ldf.select(field("value", 1), field("value", 2), field("value", 9)).collect()]
    # the quoted comma splits the field
    assert got == [('"b', 'c"', None), (None, None, None)]


def test_zone_free_text_and_year_bounds(spark):
    from beatline.functions import year_range
    from beatline.functions.time import pattern_text
    rows = [(dt.datetime(1997, 1, 1, 0, 0),), (dt.datetime(1996, 12, 31, 23, 59, 59),),
            (dt.datetime(1998, 1, 1, 0, 0),), (dt.datetime(1997, 10, 12, 13, 5, 9),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = df.select(pattern_text("t").alias("s"), year_range("t", 1997).alias("y")).collect()
        back = df.select((parse_timestamp(pattern_text("t")) == F.col("t")).alias("same")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.s for r in got] == ["01/01/1997 12:00:00 AM", "12/31/1996 11:59:59 PM",
                                  "01/01/1998 12:00:00 AM", "10/12/1997 01:05:09 PM"]
    assert [r.y for r in got] == [True, False, False, True]
    assert all(r.same for r in back)
