"""Components against union-find; no repeated work at a node with very many neighbours."""

import random

import pytest
from conftest import physical_plan

from beatline.llm import components as module
from beatline.llm.common import maybe_in, without
from beatline.llm.components import components, large_star, small_star


def union_find(edges):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = top(u), top(v)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in parent}


def check(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1] and None not in e])


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(70)], [(0, i) for i in range(1, 300)], [(500, i) for i in range(300)],
    [(1, 2), (2, 1), (1, 2), (3, 3), (4, None), (None, 5), (9, 7), (7, 8)], [(5, 5)],
], ids=["path", "star", "star around the largest", "odd rows", "no edge"])
def test_shapes(spark, edges):
    check(spark, edges)


def test_random_graphs(spark):
    r = random.Random(4)
    check(spark, [(r.randrange(400), r.randrange(400)) for _ in range(260)])


def test_empty(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stars_take_no_round(spark, monkeypatch):
    """Rounds go on until the edges are stars; the result is a stored table that later joins read without a shuffle."""
    rounds = []
    monkeypatch.setattr(module, "large_star", lambda edges: rounds.append(1) or large_star(edges))
    stars = [(1, i) for i in range(2, 40)] + [(50, i) for i in range(51, 60)]
    found = components(spark.createDataFrame(stars, "u long, v long"))
    assert {r.node: r.component for r in found.collect()} == union_find(stars) and not rounds
    assert "Exchange" not in physical_plan(found)
    check(spark, [(3, 1), (3, 2)])
    assert len(rounds) == 1


def test_steps(spark):
    df = spark.createDataFrame([(3, 1), (3, 2), (4, 3)], "u long, v long")
    assert sorted(map(tuple, large_star(df).collect())) == [(3, 1), (3, 2), (4, 1)]
    assert sorted(map(tuple, small_star(df).collect())) == [(2, 1), (3, 1), (4, 3)]


def test_filters_by_id(spark):
    """Rows in and not in a set of ids, with null and repeated ids and other columns of any name."""
    rows = spark.createDataFrame([(i % 50, f"t{i}", "x") for i in range(120)] + [(None, "n", "x")], "doc_id long, text string, id string")
    ids = spark.createDataFrame([(i,) for i in (1, 7, 49, 77)] + [(None,)], "doc_id long")
    out = without(rows, ids, "doc_id")
    assert out.columns == rows.columns
    assert sorted(r.text for r in out.collect()) == sorted(r.text for r in rows.collect() if r.doc_id not in (1, 7, 49))
    maybe = {r.text for r in maybe_in(rows, ids, "doc_id").collect()}
    assert maybe >= {r.text for r in rows.collect() if r.doc_id in (1, 7, 49)} and len(maybe) < 20
    assert without(rows, ids.limit(0), "doc_id").count() == 121 and maybe_in(rows, ids.limit(0), "doc_id").count() == 0
