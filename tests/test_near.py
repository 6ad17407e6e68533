"""Counts near in space and time against a loop over all pairs, whatever the cubes; poles, date line, hot places; plan."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL, physical_plan
from pyspark.sql import functions as F

from beatline.operators import counts_within
from beatline.plans.catalog import QUERIES

DAY0 = datetime(1999, 12, 20)
SCHEMA = "lat double, lon double, at timestamp_ntz"


def km_between(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def events(seed, n):
    """Around a town, both poles, the date line and one hot place; some without a place or time, some twice."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        lat, lon = r.choice([(0.0, 0.0), (34 + r.random() / 20, -118 + r.random() / 20), (89.99 + r.random() / 100, r.uniform(-180, 180)),
                             (-89.99, r.uniform(-180, 180)), (10.0, r.choice([179.99, -179.99, 180.0, -180.0]))])
        at = DAY0 + timedelta(hours=r.randrange(24 * 25))
        out.append((None if i % 31 == 0 else float("nan") if i % 37 == 0 else lat, lon, None if i % 23 == 0 else at))
    return out + out[:5]


def expected(facts, others, km, days):
    def spots(rows):
        out = {}
        for lat, lon, at in rows:
            if lat is not None and not math.isnan(lat) and at is not None:
                out[lat, lon, at.date()] = out.get((lat, lon, at.date()), 0) + 1
        return out
    held = spots(others)
    return sorted((*k, n, sum(m for o, m in held.items() if abs((k[2] - o[2]).days) <= days and km_between(k, o) <= km))
                  for k, n in spots(facts).items())


@pytest.mark.parametrize("km,days,cube,bins", [(1.3, 3, 2.0, None), (1.3, 3, 1.0, 1), (3.0, 0, 5.0, 40), (0.0, 1, 2.0, None),
                                                (700.0, 2, 2.0, None), (30_000.0, 30, 2.0, None)])
def test_against_all_pairs(spark, km, days, cube, bins):
    rows = events(7, 260)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, counts_within(df, df, km, days, cube=cube, bin_days=bins).collect()))
    assert got == expected(rows, rows, km, days) and any(r[4] > r[3] for r in got)


def test_two_tables(spark):
    """Facts that nothing is near count 0; the other table's rows don't appear."""
    a, b = events(1, 80), events(2, 200)
    got = counts_within(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), 1.3, 2, name="seen")
    assert got.columns == ["lat", "lon", "day", "crime_count", "seen"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == expected(a, b, 1.3, 2) and any(r[4] == 0 for r in rows)


def test_no_rows(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1.0, 2.0, DAY0)], SCHEMA)
    assert counts_within(none, one, 1, 1).count() == 0
    assert [r.nearby for r in counts_within(one, none, 1, 1).collect()] == [0]


def test_hot_place_is_counted_first(spark):
    """30,000 events at one place on ten days are ten rows in the join."""
    df = spark.range(30_000).select(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.timestamp_add(
        "DAY", (F.col("id") % 10).cast("int"), F.lit(DAY0).cast("timestamp_ntz")).alias("at"))
    assert sorted(r.nearby for r in counts_within(df, df, 1, 1).collect()) == [6000] * 2 + [9000] * 8


def test_plan(spark):
    """An equi-join on cube and bin, and partial sums before the counts are shuffled."""
    df = QUERIES["crowded_places"](spark, SF_SMALL)
    df.collect()
    plan = physical_plan(df).split("== Initial Plan ==")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert re.search(r"Join \[__cx#\d+L, __cy#\d+L, __cz#\d+L, __bin#\d+L\]", plan)
    assert "partial_sum(__n" in plan and "partial_count(1)" in plan


@pytest.mark.parametrize("key", ["crowded_places", "posts_nearby"])
def test_copies_are_not_broadcast(spark, key):
    """A row has several copies, of which Spark's estimate of bytes knows nothing: both sides are shuffled, whatever it says."""
    plan = physical_plan(QUERIES[key](spark, SF_SMALL))
    assert re.search(r"SortMergeJoin \[__cx#\d+L, __cy#\d+L, __cz#\d+L, __bin#\d+L\]", plan)


def test_posts_meet_watches_without_a_broadcast(spark):
    """Both grow with the scale, and Spark's estimate goes by packed bytes: nothing in the plan passes through the driver."""
    plan = physical_plan(QUERIES["posts_nearby"](spark, SF_SMALL))
    assert re.search(r"SortMergeJoin \[watch_id#\d+L?\], \[fid#\d+L?\]", plan) and "Broadcast" not in plan
