"""Weights, scores and ranks against a plain version; the bracket against a sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from cases import ROWS, TEXTS, docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from beatline.llm import resample as R


def feats(text, grams):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return words, [b" ".join(words[i:i + k]) for k in range(1, grams + 1) for i in range(len(words) - k + 1)]


def plain(rows, target, percent=25, least=20, grams=2, buckets=10_000, seed=7):
    s, t = Counter(), Counter()
    for texts, c in (([r[1] for r in rows], s), (target, t)):
        for x in texts:
            c.update(zlib.crc32(f) % buckets for f in feats(x, grams)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in range(buckets)]
    out = []
    for k, (i, x, *_) in enumerate(rows):
        words, fs = feats(x, grams)
        w = sum(gain[zlib.crc32(f) % buckets] for f in fs) // max(1, len(fs))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = place
    return sorted(map(repr, map(tuple, out)))


WORDS = "the a of run model data Über naïve 2024 x9 spark query token text".split()
TARGET = ["the model of data", "the data the model", "spark query", None, ""]


def many(n):
    return [(i, " ".join(WORDS[(i * j * 7 + j) % len(WORDS)] for j in range(i % 60)), "x") for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"percent": 60, "grams": 3, "buckets": 50, "seed": 1}, {"percent": 100, "least": 0},
                                     {"percent": 0}])
def test_plain(spark, options):
    rows = many(700) + [(i, t, "x") for i, t in enumerate(TEXTS, 1000)] + [(None, "no id " * 20, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, weight string").repartition(5)
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, item_id int")
    given = {("least_words" if k == "least" else k): v for k, v in options.items()}
    got = R.resample(df, target, **given).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(rows, TARGET, **options)


def test_repeats_and_hot_ties(spark):
    """A third of all rows under one id with one score: all ranks from 1 on are given once."""
    rows = [(5, "the same words " * 8, "x")] * 300 + many(600)
    df = spark.createDataFrame(rows, "doc_id long, text string, weight string").repartition(7)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = R.resample(df, target, percent=50).collect()
    ranks = sorted(r.rank for r in got if r.rank is not None)
    able = [r for r in got if r.n_words >= 20]
    assert ranks == list(range(1, len(able) * 50 // 100 + 1)) and len(got) == 900
    order = sorted(able, key=lambda r: r.rank or 10 ** 9)
    keys = [(-r.score, r.doc_id) for r in order[:len(ranks)]]
    assert keys == sorted(keys) and keys == sorted((-r.score, r.doc_id) for r in able)[:len(ranks)]


def test_edges(spark, docs, no_docs):  # noqa: F811
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = R.resample(docs, target).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(ROWS, TARGET)
    assert R.resample(no_docs, target).count() == 0
    none = spark.createDataFrame([], "text string")
    assert sorted(map(repr, map(tuple, R.resample(docs, none).collect()))) == plain(ROWS, [])


@pytest.mark.parametrize("margin", [0.0, 0.0001, 0.3])
def test_bracket_holds_the_cutoff(spark, margin):
    """Also from a bracket that is empty or far too narrow, and with many equal scores."""
    scores = spark.range(4000).select((F.col("id") * 7919 % 4001 % 37).alias("score")).repartition(6)
    values = sorted((r.score for r in scores.collect()), reverse=True)
    for wanted in (1, 2, 999, 1000, 3999, 4000):
        low, high, above = R.bracket(scores, wanted, 4000, margin or 1e-9)
        assert above < wanted and (high is None or values[wanted - 1] <= high) and (low is None or values[wanted - 1] >= low)
        assert above == (0 if high is None else sum(v > high for v in values))


def test_wrong_sketch_is_widened(spark, monkeypatch):
    """A sketch that gives a wrong first bracket costs more rounds, not the result."""
    real, calls = F.percentile_approx, []

    def wrong(col, at, accuracy):
        calls.append(at)
        return F.array(F.max(col) + 1, F.max(col) + 2) if len(calls) == 1 else real(col, at, accuracy)

    monkeypatch.setattr(R.F, "percentile_approx", wrong)
    scores = spark.range(1000).select(F.col("id").alias("score"))
    low, high, above = R.bracket(scores, 250, 1000)
    assert len(calls) > 1 and low <= 750 <= high and above == 999 - high
