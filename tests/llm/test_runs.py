"""Runs against a plain scan of all periods; the query's columns against a plain version."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from cases import TEXTS, docs, no_docs  # noqa: F401

from beatline.llm import runs
from beatline.llm.queries import QUERIES, periodic
from pyspark.sql import functions as F


def brute(words, least=6, times=4):
    """All periods one after the other: maximal stretches in which words q apart are equal."""
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            a = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            b = i + q
            if i > a and b - a >= max(least, times * q) and not any(
                    words[a:b - d] == words[a + d:b] for d in range(1, q)):
                out.append((a, b - a, q))
            i += i == a
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    """The contract's row, word by word."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for a, length, q in found for i in range(a + q, a + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


@pytest.mark.parametrize("times,least", [(4, 6), (3, 1), (5, 20)])
def test_random_words(times, least):
    r, some = random.Random(times), 0
    for _ in range(250):
        group = []
        for _ in range(r.randint(1, 6)):
            words = []
            for _ in range(r.randint(0, 6)):
                alphabet = r.choice([1, 2, 3, 50])
                unit = [b"%d" % r.randrange(alphabet) for _ in range(r.randint(1, 45))]
                words += (unit * 7)[:r.randint(1, 6 * len(unit))] if r.random() < 0.5 else unit
            group.append(words)
        for words, found in zip(group, runs.runs_of(group, least, times)):
            assert found == brute(words, least, times)
            some += len(found)
    assert some > 300


def test_known_runs():
    words = b"a b a b a b a b c c c c c c d".split()
    assert runs.runs_of([words]) == [[(0, 8, 2), (8, 6, 1)]]
    assert runs.collapsed(words, [(0, 8, 2), (8, 6, 1)]) == b"a b c d"
    unit = [b"w%d" % i for i in range(100)]
    words = [b"x"] + unit * 4 + unit[:7] + [b"y"]
    assert runs.runs_of([words, [], unit]) == [[(1, 407, 100)], [], []]  # no neighbour's words
    assert runs.runs_of([unit * 3 + unit[:-1]]) == [[]]  # one word too short
    assert runs.runs_of([[b"a"] * 5]) == [[]] and runs.runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    assert runs.runs_of([]) == [] and runs.greatest([]) is None
    assert runs.greatest([(9, 8, 2), (0, 16, 4), (0, 8, 2)]) == (0, 8, 2)
    with pytest.raises(ValueError):
        runs.runs_of([words], times=2)


def test_edges(spark, docs, no_docs):  # noqa: F811
    clash = docs.withColumnRenamed("score", "Runs").withColumnRenamed("kept", "n_words")
    found = runs.find(clash)
    assert [c.lower() for c in found.columns].count("runs") == 1 and "mix_block" in found.columns
    rows = {r.text: r for r in found.collect()}
    assert len(rows) == len(set(TEXTS)) + 1 and found.count() == docs.count()
    for t in TEXTS[:4]:
        assert rows[t].n_words == 0 and rows[t].runs == [] and rows[t].greatest is None and rows[t].collapsed == ""
    for t, r in rows.items():
        words = (t or "").encode().split()
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute(words)
    assert runs.find(no_docs).count() == 0


def test_contract(spark):
    texts = [t for t in TEXTS if not t or len(t) < 1000] + ["na " * 30, "one two three " * 9 + "four", "a b\tc\n" * 40]
    rows = [(i, texts[i % len(texts)] if i % 3 else " ".join(f"w{j}" for j in range(i % 97))) for i in range(400)]
    rows += [(None, "no id a a a a a a a"), (7, texts[-1]), (7, texts[-1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = runs.digests(runs.find(df.withColumn("text", periodic(F.col("text"), F.col("doc_id"))))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain(*r)) for r in rows)


def test_query(spark):
    """The registered query over a whole table; the very long texts by their digests only."""
    at = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_runs"](spark, at).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        if len((text or "").split()) < 1200:
            assert got[doc_id] == plain(doc_id, text)
    assert any(r[1] for r in got.values())
