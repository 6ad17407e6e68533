"""Rolling counts and sessions against plain loops, for any width of the stretches; hot keys."""

import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from beatline.operators import rolling_counts, sessions

DAY0 = datetime(1999, 11, 28)


def facts(seed, n=500):
    r = random.Random(seed)
    out = [(i, r.choice(["hot", "hot", "b", "c", None]), None if i % 29 == 0 else DAY0 + timedelta(
        hours=r.choice([r.randrange(24 * 40), r.randrange(24 * 900)]))) for i in range(n)]
    return out + out[:3]


@pytest.mark.parametrize("days,width", [(1, 1), (30, 30), (30, 7), (30, 365), (90, 100_000)])
def test_rolling(spark, days, width):
    rows = facts(days + width)
    got = rolling_counts(spark.createDataFrame(rows, "id int, k string, at timestamp_ntz"), ["k"], "at", days, "n", width).collect()
    dated = [(k, at.date()) for _, k, at in rows if at]
    expect = [(k, d, dated.count((k, d)), sum(q == k and timedelta(0) <= d - e < timedelta(days) for q, e in dated))
              for k, d in set(dated)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expect))


@pytest.mark.parametrize("gap,width", [(0, 3), (12, 1), (48, 7), (48, 365), (24 * 60, 10)])
def test_sessions(spark, gap, width):
    rows = facts(gap + width)
    got = sessions(spark.createDataFrame(rows, "id int, k string, at timestamp_ntz"), ["k"], "at", gap, width).collect()
    expect = []
    for k in ("hot", "b", "c"):
        now = []
        for at in [*sorted(at for _, q, at in rows if q == k and at), None]:
            if now and (at is None or at - now[-1] > timedelta(hours=gap)):
                expect.append((k, now[0], now[-1], len(now)))
                now = []
            now.append(at)
    assert sorted(map(tuple, got)) == sorted(expect) and len(expect) > 3


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, at timestamp_ntz")
    assert rolling_counts(none, ["k"], "at", 30).count() == 0 and sessions(none, ["k"], "at", 24).count() == 0


def test_hot_key_is_dealt_out(spark):
    """Every window but that over the border sessions is by key and stretch, over rows counted before the shuffle."""
    hot = spark.range(50_000).select((F.col("id") % 1).alias("k"), F.timestamp_add(
        "HOUR", F.col("id").cast("int"), F.lit(DAY0).cast("timestamp_ntz")).alias("at"))
    df = rolling_counts(hot, ["k"], "at", 30, width=60)
    assert df.agg(F.max("last_30")).first()[0] == 30 * 24
    plan = physical_plan(df)
    assert re.search(r"Exchange hashpartitioning\(k#\d+L, __stretch#\d+", plan) and "partial_count" in plan
    df = sessions(hot.where("hour(at) % 6 = 0"), ["k"], "at", 3, width=60)
    assert df.count() == 8334 and df.where("events > 1").count() == 0
