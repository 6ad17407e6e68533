"""Stored summaries against plain counting: distinct values, quantiles, merging; plan of the yearly question."""

import math
import random

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from beatline.operators import estimates, merged, summaries
from beatline.operators.sketches import bin_of, least_of
from beatline.plans import queries as Q

QUANTILES = {"low": 0.0, "half": 0.5, "high": 0.99, "top": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(9)
    data = [(r.choice(["a", "a", "a", "b", None]), r.randrange(6), r.choice([None, *range(900)]),
             r.choice([None, -3, r.randrange(300), int(r.paretovariate(0.4))])) for _ in range(4000)]
    return data, spark.createDataFrame(data, "k string, part int, d long, n long")


def plain(data, key):
    out = {}
    for k in {x[0] for x in data} if key else {()}:
        mine = [x for x in data if not key or x[0] == k]
        numbers = sorted(max(x[3], 0) for x in mine if x[3] is not None)
        out[k] = len(mine), len({x[2] for x in mine if x[2] is not None}), numbers
    return out


@pytest.mark.parametrize("keys", [["k"], []])
def test_merged_parts_are_like_the_whole(rows, keys):
    data, df = rows
    parts = summaries(df, ["k", "part"], F.col("d"), F.col("n"))
    once = merged(parts, [*keys, "part"])
    for s in (merged(parts, keys), merged(once, keys), merged(parts.unionByName(parts.limit(0)), keys)):
        got = {r.k if keys else (): r for r in estimates(s, keys, QUANTILES).collect()}
        expect = plain(data, keys)
        assert set(got) == set(expect)
        for k, (n, kinds, numbers) in expect.items():
            assert got[k].times == n and got[k].distinct_values == kinds
            for name, q in QUANTILES.items():
                exact = numbers[max(math.ceil(q * len(numbers)), 1) - 1]
                assert exact * (1 - 1 / 128) <= got[k][name] <= exact


def test_bins_are_in_order_and_narrow(spark):
    numbers = sorted({n for e in range(62) for n in ((1 << e) - 1, 1 << e, (1 << e) + 1, 3 << e >> 1)} | set(range(600)) | {2**63 - 1})
    df = spark.createDataFrame([(n,) for n in numbers], "n long").withColumn("b", bin_of(F.col("n")))
    got = df.withColumn("least", least_of(F.col("b"))).orderBy("n").collect()
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(r.least <= r.n and (r.n - r.least) * 128 <= r.n and (r.n >= 256 or r.least == r.n) for r in got)
    assert max(r.b for r in got) < 7500


def test_small_sketches_err_within_their_bound(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS part", "id % 20000 AS d", "id AS n")
    s = merged(summaries(df, ["part"], F.col("d"), F.col("n"), log_size=10), [], log_size=10)
    got = estimates(s, [], {}).first()
    assert got.times == 60_000 and abs(got.distinct_values / 20_000 - 1) < 4 * 2 ** -5


def test_nulls_only_and_no_rows(spark):
    none = spark.createDataFrame([("a", None, None)], "k string, d long, n long")
    got = estimates(merged(summaries(none, ["k"], F.col("d"), F.col("n")), ["k"]), ["k"], QUANTILES).collect()
    assert [(r.times, r.distinct_values, r.half) for r in got] == [(1, 0, None)]
    assert estimates(merged(summaries(none.limit(0), ["k"], F.col("d"), F.col("n")), ["k"]), ["k"], QUANTILES).count() == 0


def test_years_read_the_stored_months_alone(spark, rows, tmp_path):
    _, df = rows
    months = summaries(df.withColumnRenamed("part", "year"), ["year", "k"], F.col("d"), F.col("n"))
    months.write.parquet(f"{tmp_path}/months")
    p = physical_plan(Q.yearly_from_months(spark.read.parquet(f"{tmp_path}/months")))
    files = [x for x in p.splitlines() if "Location" in x]
    assert files and all("months" in x for x in files) and "EvalPython" not in p and "CartesianProduct" not in p
