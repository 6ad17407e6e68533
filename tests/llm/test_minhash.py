"""Components and set sizes against all pairs of full sets."""

import itertools
import random

import numpy as np
import pytest
from cases import TEXTS
from conftest import physical_plan

from beatline.llm import minhash
from beatline.llm.minhash import near_duplicates


def plain_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(size, len(words))
    return frozenset((tuple(words[i:i + k])) for i in range(len(words) - k + 1))


def brute(rows, size, percent=80):
    sets = [(i, plain_set(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        common = len(a & b)
        if common and 100 * common >= percent * len(a | b):
            parent[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in parent}


def check(spark, rows, size=4):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df, size).collect()
    assert len(got) == len(rows)
    expect, sizes = brute(rows, size), {(i, len(plain_set(t, size))) for i, t in rows}
    for r in got:
        assert (r.doc_id, r.n_shingles) in sizes
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (expect[r.doc_id], expect[r.doc_id] == r.doc_id)


def edited(words, n, r):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"e{r.randrange(10 ** 6)}"
    return " ".join(out)


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id here at all"), (None, "no id here at all"),
                                                    (100, "a"), (101, "A"), (102, "one two"), (103, "ONE\ttwo"), (104, "two one")]
    check(spark, rows)
    check(spark, rows, 5)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_groups_of_copies_near_the_threshold(spark):
    """Exact copies, light and heavy edits of one text (links between some of them only), chains, and
    texts that share a long passage."""
    r = random.Random(8)
    base = [f"w{r.randrange(4000)}" for _ in range(160)]
    rows = [(1000 - i, edited(base, 0 if i < 20 else r.randrange(9), r)) for i in range(150)]
    chain = [f"c{i}" for i in range(120)]
    for k in range(25):
        rows.append((2000 + k, " ".join(chain)))
        chain = chain[2:] + [f"c{k}x", f"c{k}y"]
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(3000 + i, shared + " " + " ".join(f"q{r.randrange(10 ** 6)}" for _ in range(r.randrange(5, 80)))) for i in range(60)]
    check(spark, rows)


def test_an_id_with_two_texts_ties_both_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (7, a), (7, b), (9, b)], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(df, 4).collect()} == {1}


def test_blocks_and_salts_are_exact(spark, monkeypatch):
    """The same result when every block and every deal of pairs is tiny."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "BESIDE", 2)
    r = random.Random(3)
    base = [f"w{r.randrange(4000)}" for _ in range(120)]
    check(spark, [(i, edited(base, r.randrange(8), r)) for i in range(60)])


def test_a_bucket_is_dealt_out_in_one_pass(spark, monkeypatch):
    """Askers and asked of all blocks come from one pass over the nodes; all pairs across components are found once."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    ids = range(1, 10)
    same = np.zeros(minhash.HASHES, "<u2").tobytes(), np.zeros(minhash.FINE, np.uint8).tobytes()
    rows = spark.createDataFrame([(0, 5, i) for i in ids], "band short, key long, id long")
    fine = spark.createDataFrame([(i, same[0], 10, same[1]) for i in ids], "id long, minima binary, n_shingles long, sketch binary")
    found = spark.createDataFrame([(i, 1) for i in range(1, 6)] + [(6, 6), (7, 6)], "node long, component long")
    pairs = minhash.across(rows, fine, found, 80, best=False)
    assert physical_plan(pairs).count("Generate explode") == 1
    of = {i: 1 if i < 6 else 6 if i < 8 else i for i in ids}
    assert sorted(map(tuple, pairs.collect())) == [(i, j) for i in ids for j in ids if i < j and of[i] != of[j]]


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_signatures_estimate_the_similarity(share):
    r = np.random.default_rng(5)
    x = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    common = int(2 * 2000 * share / (1 + share))
    a, b = x[:2000], np.concatenate([x[:common], x[2000:4000 - common]])
    true = common / (4000 - common)
    for n in (minhash.HASHES, minhash.FINE):
        f = minhash.universal(n)
        same = (minhash.signature(a, *f) == minhash.signature(b, *f)).mean()
        assert abs(same - true) < 5 * (true * (1 - true) / n) ** 0.5
    assert minhash.agreements(minhash.HASHES, 80) < 0.7 * minhash.HASHES
