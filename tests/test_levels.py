"""Grouping sets level by level against Spark's own grouping sets and plain counting; plan."""

import random

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from beatline.operators import cube_sets, grouping_levels, rollup_sets

DIMS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def facts(spark):
    r = random.Random(4)
    rows = [(r.choice(["x", "y", None]), r.choice([1, 2, 3, None]), r.choice([True, False]), r.choice([None, 5, 7, -2])) for _ in range(300)]
    return spark.createDataFrame(rows, "a string, b int, c boolean, v int")


MEASURES = {"n": ("count", F.lit), "known": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}


@pytest.mark.parametrize("sets", [cube_sets(DIMS), rollup_sets(DIMS), [("a",), ("b", "c")], [("b",), ("b",)], [()], [("a", "b", "c")]])
def test_like_grouping_sets(spark, facts, sets):
    measures = {m: (kind, F.lit(1) if c is F.lit else c) for m, (kind, c) in MEASURES.items()}
    got = grouping_levels(facts, DIMS, sets, measures).collect()
    spelled = ", ".join(f"({', '.join(s)})" for s in dict.fromkeys([*map(tuple, sets), tuple(DIMS)]))
    expect = spark.sql(f"""select a, b, c, grouping_id(a, b, c) as level, count(1) as n, count(v) as known, sum(v) as total,
        min(v) as low, max(v) as high from {{facts}} group by a, b, c grouping sets ({spelled})""", facts=facts)
    if ("a", "b", "c") not in map(tuple, sets):
        expect = expect.where("level != 0")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, expect.collect())))


def test_edges(spark, facts):
    assert grouping_levels(facts.limit(0), DIMS, cube_sets(DIMS)).count() == 0
    with pytest.raises(ValueError):
        grouping_levels(facts, ["a"], [("b",)])
    assert [tuple(r) for r in grouping_levels(facts, ["a"], [()]).collect()] == [(None, 1, 300)]


def test_facts_are_aggregated_before_anything_is_doubled(spark, facts):
    df = grouping_levels(facts, DIMS, cube_sets(DIMS))
    df.collect()
    plan = physical_plan(df).split("== Initial Plan ==")[0]
    assert "Expand" not in plan and plan.count("Generate explode") == 3
    assert plan.rindex("Generate explode") < plan.index("partial_count(1)")  # below: nearer to the facts
