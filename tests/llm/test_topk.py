"""Top-k search against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatline.llm import topk


def brute(rows, k, scale, every):
    fine = [(n, i, [int(np.floor(scale * float(x))) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v and all(x is not None and np.isfinite(x) and np.isfinite(scale * x) for x in v)]
    out = []
    for n, i, v in fine:
        if i % every == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2 ** 63), 2 ** 63 - 1), j)
                            for m, j, w in fine if m != n and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(spark, rows, k=5, scale=256.0, every=5, parts=6):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = topk.search(df.repartition(parts), F.col("vec_id") % every == 0, k, scale)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, k, scale, every)


@pytest.mark.parametrize("d,k,lists", [(64, 5, 4), (3, 2, 4), (7, 20, 2)])
def test_random(spark, d, k, lists, monkeypatch):
    """Copies, near copies, negative scores, several blocks and cells."""
    monkeypatch.setattr(topk, "CANDIDATES", 1 << 10)
    monkeypatch.setattr(topk, "QUERIES", 1 << 8)
    monkeypatch.setattr(topk, "CELL", 3)
    r = np.random.default_rng(d)
    x = r.normal(size=(500, d)) / d ** 0.5
    x[100:150] = x[100]
    x[200:260] = x[200] + r.normal(size=(60, d)) / 1000
    x[300:] -= 2 * np.abs(x[300:])  # only negative components
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)], k=k)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (1, None), (10, []), (15, [1.0, None]), (20, [nan, 1.0]), (25, [inf, 1.0]),
            (None, [1.0, 1.0]), (30, [1.0]), (35, [0.0, 0.0]), (40, [-1.0, -0.001]), (2, [3.0, 3.0]), (45, [1.0, 2.0, 3.0])]
    check(spark, rows)  # fewer than k of a length: all are found
    check(spark, [(0, [1.0])])
    check(spark, [(1, [1.0]), (2, [2.0])])  # no query
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 5 == 0).count() == 0


def test_repeated_rows(spark):
    """A repeated row finds its twin, and each of the repeats is a query."""
    check(spark, [(5, [1.0, 1.0])] * 3 + [(1, [2.0, 2.0])] * 2, k=3)


def test_large_numbers(spark):
    """Products beyond 53 bits are exact, beyond 64 bits the nearest that a long can hold."""
    rows = [(i, [float(2 ** 28 + i), float(2 ** 28 - 3 * i), 1.0 + i]) for i in range(12)]
    check(spark, rows, k=4, scale=1.0)
    check(spark, [(0, [1e30, 1.0]), (5, [-1e30, 1.0]), (6, [1e30, 2.0]), (7, [3.0, 1e300])], k=4, scale=1.0)


def test_cutoff_and_bound():
    """No pair that reaches the threshold is left out, whatever the signs; others mostly are."""
    r = np.random.default_rng(3)
    a, b = (np.floor(256 * r.normal(size=(n, 16)) / 4) for n in (40, 900))
    parts = topk.local_scores(a, b, 4)
    total = sum(parts)
    assert (total == a @ b.T).all()
    cutoff = np.sort(total, axis=1)[:, -5]
    none = (np.zeros(0, int), np.zeros(0, int))
    rows, cols = topk.sufficient(parts, none, cutoff, cutoff)
    assert set(zip(*np.nonzero(total >= cutoff[:, None]))) <= set(zip(rows, cols)) and len(rows) < total.size / 3
    later = topk.sufficient(parts, none, cutoff, np.sort(total, axis=1)[:, -2])  # bounds prune against a better threshold
    assert set(zip(*later)) < set(zip(rows, cols))
