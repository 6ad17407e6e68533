"""The label model on votes of known accuracy; toxic texts found in rows not learned from."""

import random

import numpy as np
from cases import TEXTS, docs, no_docs  # noqa: F401

from beatline.llm import toxicity
from beatline.llm.common import fold

WORDS = [f"w{i}x" for i in range(300)]
BAD = ["idiot", "grobble", "snarf", "mumpf"]


def corpus(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = r.random() < 0.2
        words = r.choices(WORDS, k=r.randint(15, 60))
        for _ in range(r.randint(1, 3) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(BAD) if r.random() < 0.7 else "blorf" + r.choice(["en", "ung", "ish", "o"]))
        rows.append((i, " ".join(words) + r.choice([".", "!", ""]), int(toxic)))
    return rows


def test_finds_toxic_texts_and_leaves_clean_ones(spark):
    rows = corpus(2500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i % 2], "doc_id long, toxic int")
    out = toxicity.score(docs, labels, docs.where(fold("doc_id", 5) != 0)).withColumn("held", fold("doc_id", 5) == 0).collect()
    truth = {i: t for i, _, t in rows}
    held = [r for r in out if r.held]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.predicted == 0 for r in out if truth[r.doc_id] == 0) and all(0 <= r.score <= 1 for r in out)
    kept = toxicity.reject(docs, labels, docs.where(fold("doc_id", 5) != 0))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.predicted == 0}


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = docs.where(fold("doc_id", 5) != 0)
    held = {r.doc_id for r in docs.where(fold("doc_id", 5) == 0).collect()}

    def scores(flip):
        labels = spark.createDataFrame([(i, 1 - t if flip and i in held else t) for i, _, t in rows], "doc_id long, toxic int")
        return {r.doc_id: round(r.score, 9) for r in toxicity.score(docs, labels.where(~labels.doc_id.isin(*held)) if flip else labels, known).collect()}

    flipped = scores(True)
    assert set(flipped) == set(scores(False))


def test_correlated_voters_share_their_weight():
    r = np.random.default_rng(3)
    y = r.random(20_000) < 0.3
    base = np.where(y, r.random(len(y)) < 0.6, r.random(len(y)) < 0.02)
    votes = np.zeros((len(y), toxicity.VOTERS))
    votes[:, 0] = votes[:, 1] = votes[:, 2] = base  # one voter three times
    votes[:, 3] = np.where(y, r.random(len(y)) < 0.5, r.random(len(y)) < 0.05)
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    known = np.zeros((len(patterns), 2))
    for k, t in zip(back.ravel()[:2000], y[:2000]):
        known[k, int(t)] += 1
    model = toxicity.LabelModel(patterns, counts.astype(float), known)
    assert model.correlations[0, 1] > 0.9 > 0.3 > model.correlations[0, 3]
    assert model.weights[0] < 0.45 < 0.7 < model.weights[3]
    assert abs(model.rates[1][0] - 0.6) < 0.08 and model.accuracy[0] > model.accuracy[3]


def test_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(99, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs.select("doc_id", "text", "score"), labels, docs).collect()
    assert len(out) == len(TEXTS) + 2 and len({r.score for r in out if r.doc_id in (0, 1, 2, 3)}) == 1
    assert toxicity.score(no_docs.select("doc_id", "text"), labels, no_docs).count() == 0
    unlabelled = toxicity.score(docs.select("doc_id", "text"), labels.limit(0), docs).collect()
    assert len(unlabelled) == len(TEXTS) + 2 and all(r.predicted == 0 for r in unlabelled if r.doc_id in (0, 1))
    assert toxicity.sample(docs, labels, limit=3).select("doc_id").distinct().count() <= 3


def test_entries_are_counted_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD", 7)  # counts are handed on in many parts
    rows = [(t, i % 2) for i, t in enumerate(["Idiots idiot, stems stemmed", "", None, "a-b c! ABCDEFGH", "stemming stemmer idiot"] * 7)]
    got = {r.word: (r.one, r.none) for r in toxicity.entry_counts(spark.createDataFrame(rows, "text string, toxic int")).collect()}
    plain = {}
    for text, toxic in rows:
        for w in toxicity.entries_of(toxicity.words_of(text)):
            plain.setdefault(w, [0, 0])[1 - toxic] += 1
    assert got == {w: tuple(c) for w, c in plain.items()} and got["stem*"][0] > 0


def test_families_like_a_plain_search(monkeypatch):
    r = random.Random(5)
    entries = sorted({(w[:k] + "*" if k else w, r.randrange(1, 50)) for w in ["".join(r.choices("ab", k=r.randint(3, 8))) for _ in range(300)]
                      for k in (0, r.choice([0, *toxicity.STEMS])) if not k or len(w) > k}, key=lambda e: (-e[1], e[0]))
    entries = list(dict(reversed(entries)).items())[::-1]  # each word once
    plain = {}
    for w, one in entries:
        stem = w[:-1] if w.endswith("*") else None
        if not any(c.endswith("*") and w.startswith(c[:-1]) or stem and c.startswith(stem) and n >= 0.8 * one for c, n in plain.items()):
            plain[w] = one
    assert toxicity.families(entries, 10_000) == plain and len(plain) > 20
    assert list(toxicity.families(entries, 5)) == list(plain)[:5]


def test_many_families_do_not_crowd_each_other_out(spark):
    """More toxic words than voters, with many inflections each; every one of them is found, none of the clean texts is."""
    r = random.Random(8)
    stems = ["".join(r.choices("bcdfgklmnprstvz", k=7)) for _ in range(60)]
    rows = []
    for i in range(3000):
        words = r.choices(WORDS, k=25)
        if toxic := r.random() < 0.3:
            words.insert(3, stems[i % 60] + r.choice(["", "en", "er", "ing", "ish", "ly"]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    made, _ = toxicity.fit(docs, labels, docs)
    assert all(any(s.startswith(v.rstrip("*")) for v in made.voters) for s in stems)
    out = {x.doc_id: x.predicted for x in toxicity.score(docs, labels, docs).collect()}
    assert out == {i: t for i, _, t in rows}


def test_rows_leave_by_key(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, 7 * i) for i, t, _ in rows] + [(3, None, 9_999)], "doc_id long, text string, row long").coalesce(1)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    by_key = toxicity.reject(docs, labels, docs, key="row")
    assert by_key.columns == docs.columns
    assert sorted(by_key.collect(), key=str) == sorted(toxicity.reject(docs, labels, docs).collect(), key=str)
