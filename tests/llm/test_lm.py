"""Counts and base score against plain counting; the model's gradients and probabilities."""

import math
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from cases import TEXTS

from beatline.llm import lm
from beatline.llm.common import fold

PATH = public_tokenizers.path("byte_bpe_50k.json")


def vocabulary(seed=0):
    tokens = [*lm.bpe.loaded(PATH).bytes, b""]
    return lm.Vocabulary.make(np.random.default_rng(seed).integers(0, 100, len(tokens) - 1), tokens, 5)


def double(w):
    model = lm.Attention(w)
    model.bias = np.where(lm.DISTANCE >= 0, w["near"][np.clip(lm.DISTANCE, 0, 2 * lm.STEP - 1)], -1e9)
    return model


def test_gradients():
    v, r = vocabulary(), np.random.default_rng(1)
    w = {k: x.astype(float) for k, x in lm.Attention.fresh(v).items()}
    w["near"] = r.standard_normal(2 * lm.STEP) * 0.2
    end = len(v.group) - 1
    blocks, aims, of = lm.laid_out([r.integers(0, 50_000, 40), r.integers(0, 50_000, 3)], end)
    args = (v.leaf[blocks], v.group[aims], v.leaf[aims], (of >= 0).astype(float))
    _, g = double(w).gradients(*args)
    for name in lm.SHAPES:
        for at in [np.unravel_index(int(np.argmax(np.abs(g[name]))), g[name].shape)]:
            up, down = ({k: x.copy() for k, x in w.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (double(up).gradients(*args)[0] - double(down).gradients(*args)[0]) / 2e-5
            assert math.isclose(slope, g[name][at], rel_tol=1e-3, abs_tol=1e-8), name


def test_next_id_probabilities_sum_to_one():
    v = vocabulary()
    model, end = lm.Attention(lm.Attention.fresh(v)), len(v.group) - 1
    ids = np.array([464, 3290, 318])
    first = lm.score_texts(model, v, [ids[:0]], end)[0]  # the end at once
    assert first < 0
    blocks, _, _ = lm.laid_out([ids], end)
    a = model.forward(v.leaf[blocks])
    logits = a["top"][3] @ model.out
    group = np.exp(logits) / np.exp(logits).sum()
    total = 0.0
    for g, _, fine in ((g, None, a["top"][3] @ model.fine[g]) for g in range(lm.GROUPS)):
        leaf = np.exp(fine) / np.exp(fine).sum()
        mine = np.flatnonzero(v.group == g)
        total += float(sum(group[g] * leaf[v.leaf[i] - g * lm.LEAVES] * math.exp(v.log_share[i]) for i in mine.tolist()))
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_windows_are_causal_and_each_id_is_scored_once():
    v = vocabulary()
    model, end = lm.Attention(lm.Attention.fresh(v)), len(v.group) - 1
    r = np.random.default_rng(4)
    texts = [r.integers(0, 50_000, n) for n in (0, 1, lm.STEP - 1, lm.STEP, 5 * lm.STEP + 3, 40_000)]
    together = lm.score_texts(model, v, texts, end)
    for k, t in enumerate(texts):
        assert math.isclose(together[k], lm.score_texts(model, v, [t], end)[0], rel_tol=1e-5)
    # a change at the end leaves what came before
    long = texts[4]
    blocks, aims, of = lm.laid_out([long], end)
    assert (of >= 0).sum() == len(long) + 1 and aims[of >= 0].tolist() == [*long.tolist(), end]
    changed = long.copy()
    changed[-1] = 7
    other, _, _ = lm.laid_out([changed], end)
    x, y = (model.forward(v.leaf[b])["top"] @ model.out for b in (blocks, other))
    n = len(long)
    assert np.allclose(x[:n], y[:n], atol=1e-5) and not np.allclose(x[n], y[n], atol=1e-5)


def test_an_id_asks_at_least_sixteen_ids_back():
    v = vocabulary()
    w, end = lm.Attention.fresh(v), len(v.group) - 1
    text = np.random.default_rng(6).integers(0, 50_000, 64)
    other = text.copy()
    other[16] = 7 if v.leaf[text[16]] != v.leaf[7] else 8
    model = lm.Attention(w)
    x, y = (model.forward(v.leaf[lm.laid_out([t], end)[0]])["top"] @ model.out for t in (text, other))
    moved = np.flatnonzero(np.abs(x - y).max(axis=1) > 1e-6)
    assert moved.min() == 17 and moved.max() >= 17 + 15  # place k predicts id k from those before


def test_sums_by_place():
    at = np.array([3, 0, 3, 7, 3])
    got = lm.sums_by(at, np.arange(10.0).reshape(5, 2), 9)
    expect = np.zeros((9, 2))
    np.add.at(expect, at, np.arange(10.0).reshape(5, 2))
    assert (got == expect).all()


def test_a_very_long_text_trains_in_steps():
    v = vocabulary()
    start, end = lm.Attention.fresh(v), len(v.group) - 1
    long = np.tile(np.array([464, 3290, 318], "<u2"), 100_000)
    w, seen = lm.train_part(start, v, iter([[long]]), end, 0.01)
    assert seen == len(long) + 1 and all(np.isfinite(x).all() for x in w.values())
    before, after = (lm.score_texts(lm.Attention(x), v, [long], end)[0] for x in (start, w))
    assert after > 0.6 * before  # the share of an id in its leaf is no weight and stays


def test_training_learns_what_follows(spark):
    rows = [(i, " ".join(["left right"] * 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = lm.score(df, PATH, fold("doc_id", 10) == 0).collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.score > 0.6 * r.base_score for r in held)


def test_every_training_text_reaches_the_weights(spark, monkeypatch, tmp_path):
    plain = lm.train_part

    def noted(weights, vocabulary, batches, end, rate):
        def kept():
            for texts in batches:
                with open(f"{folder}/{uuid.uuid4()}", "w") as f:
                    f.writelines(f"{len(t)}\n" for t in texts)
                yield []  # what is trained on plays no part here
        return plain(weights, vocabulary, kept(), end, rate)

    folder = str(tmp_path)
    monkeypatch.setattr(lm, "train_part", noted)
    df = spark.range(6000).selectExpr("id AS doc_id", "repeat('a ', int(id)  % 7) AS text")
    lm.score(df, PATH, fold("doc_id", 10) == 0)
    seen = [int(n) for f in tmp_path.iterdir() for n in f.read_text().split()]
    expect = [i % 7 for i in range(6000) if zlib.crc32(str(i).encode()) % 10]
    assert sorted(seen) == sorted(expect)  # more than 2,000 texts, each of them once


def test_counts_and_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 6)  # most words go through the join
    monkeypatch.setattr(lm, "HELD", 5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id here at all"), (70, "unseen zzz The the THE")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update((t or "").encode().lower().split() + [None])
    n, v = sum(c.values()), len(c)
    out = lm.score(df, PATH, fold("doc_id", 10) == 0).collect()
    got = sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.held_out) for r in out)
    expect = []
    for i, t in rows:
        words = (t or "").encode().lower().split() + [None]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        expect.append((repr(i), len(words), sum(w in c for w in words), n, round(base, 6), held(i)))
    assert got == sorted(expect) and all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_no_rows_and_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    from pyspark.sql import functions as F
    none = lm.score(df, PATH, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in none)
    assert lm.score(df.limit(0), PATH, F.lit(False)).count() == 0
