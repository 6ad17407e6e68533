"""Links, components and copies against all pairs."""

import numpy as np
import pytest

from beatline.llm import vecjoin
from beatline.llm.vecjoin import near_vectors


def brute(rows, least):
    ok = []
    for k, (i, label, v, *_) in enumerate(rows):
        x = None if v is None or label is None or i is None or not v or any(c is None for c in v) else np.array(v, float)
        if x is not None and np.isfinite(x).all() and np.abs(x).max() > 0:
            x = x / np.abs(x).max()
            ok.append((k, label, x / np.linalg.norm(x)))
    links, parent = [0] * len(rows), {r[0]: r[0] for r in rows if r[0] is not None}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for n, (a, la, x) in enumerate(ok):
        for b, lb, y in ok[:n]:
            if la == lb and len(x) == len(y) and float(x @ y) >= least:
                links[a] += 1
                links[b] += 1
                i, j = top(rows[a][0]), top(rows[b][0])
                parent[max(i, j)] = min(i, j)
    return sorted((repr(r[0]), n, repr(None if r[0] is None else top(r[0])), r[0] is None or top(r[0]) == r[0])
                  for r, n in zip(rows, links))


def check(spark, rows, least=0.98, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding {kind}, n_links string, cell string, p int")
    got = sorted((repr(r.vec_id), r.n_links, repr(r.component_id), r.kept) for r in near_vectors(df, least).collect())
    assert got == brute(rows, least)


def row(i, label, v):
    return (i, label, v, "x", "y", 1)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vecs = [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [1.0, 0.0], [1.0], [], None, [0.0, 0.0, 0.0], [1.0, None, 0.0], [nan, 1.0, 0.0],
            [inf, 0.0, 0.0], [-0.0, 1.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [1e-30, 0.0, 0.0], [1e30, 1e29, 0.0]]
    rows = [row(i, 1, v) for i, v in enumerate(vecs)] + [row(50, None, vecs[0]), row(51, 2, vecs[0]), row(None, 1, vecs[0]), row(0, 1, vecs[0])]
    check(spark, rows)
    check(spark, [row(i, 1, v) for i, v in ((1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1e308, -1e308]))], kind="array<double>")


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


@pytest.mark.parametrize("block,fan", [(512, 3), (4, 1)])
def test_clusters(spark, monkeypatch, block, fan):
    """Dense and loose clusters, copies, chains of neighbours; also with tiny blocks and intervals."""
    monkeypatch.setattr(vecjoin, "BLOCK", block)
    monkeypatch.setattr(vecjoin, "FAN_BITS", fan)
    r = np.random.default_rng(11)
    rows = []
    for c in range(6):
        center = r.standard_normal(24)
        for _ in range(25):
            v = center + r.standard_normal(24) * (0.02, 0.1, 0.14, 0.18, 0.25, 0.6)[c]
            rows.append([float(x) for x in v.astype(np.float32)])
    rows += [rows[0]] * 30
    angle = [[float(np.cos(t)), float(np.sin(t))] + [0.0] * 22 for t in np.arange(40) * 0.15]
    rows += angle
    rows += [[float(x) for x in v] for v in r.standard_normal((60, 24)).astype(np.float32)]
    order = r.permutation(len(rows))
    check(spark, [row(int(i) + 5, int(i) % 2, rows[k]) for i, k in enumerate(order)])


def test_far_blocks_are_skipped(spark):
    """Clusters in different directions meet in few pairs of blocks."""
    r = np.random.default_rng(2)
    centers = r.standard_normal((40, 16)) * 4
    data = [(i, "1", [float(x) for x in centers[i % 40] + 0.02 * r.standard_normal(16)], 1) for i in range(2000)]
    nodes = spark.createDataFrame(data, "id long, label string, vec array<double>, copies long")
    eps = 0.2
    old, vecjoin.BLOCK = vecjoin.BLOCK, 25
    try:
        made = vecjoin.blocks(vecjoin.placed(nodes, vecjoin.axes_of(nodes), eps)).cache()
        n = made.count()
        pairs = vecjoin.near_blocks(made, eps).count()
    finally:
        vecjoin.BLOCK = old
    assert n >= 80 and n <= pairs < 0.25 * n * n / 2
