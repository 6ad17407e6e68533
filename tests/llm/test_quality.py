"""Measures against plain counting; the estimation on votes of known accuracy."""

import numpy as np
import pytest
from cases import TEXTS, docs, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from beatline.llm import quality


def plain(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [ln for ln in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", ln)]
    dup = sum(ln in lines[:i] for i, ln in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else {
        w for w in windows if w in quality.Counter(windows) and quality.Counter(windows)[w] > 1}
    covered = {j for i, w in enumerate(windows) if w in again for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("text", [t for t in TEXTS if t is None or len(t) < 2000] + ["a b c a b c a b", "x\nx\n\n \nx y\nx", "é|é # é"])
def test_known_texts(text):
    assert quality.measures(text)[:5] == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\t", "#", "|", "é", " ", "漢"]), max_size=60).map("".join))
def test_any_text(text):
    assert quality.measures(text)[:5] == plain(text)


def test_estimation_finds_the_good_texts():
    r = np.random.default_rng(1)
    good = r.random(4000) < 0.85
    votes = np.stack([np.where(r.random(4000) < 0.2, 0, np.where(r.random(4000) < (0.95 if k < 4 else 0.6), 1, -1) * np.where(good, 1, -1))
                      for k in range(6)], axis=1)
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, p = quality.estimate(patterns, counts.astype(float))
    found = quality.posterior(patterns, share, p)[back.ravel()] >= 0.5
    assert (found == good).mean() > 0.97 and abs(share - 0.85) < 0.05
    sure = quality.log_odds(p)
    assert sure[0, 2] > sure[5, 2] and sure[0, 0] < sure[5, 0] <= 0  # the accurate rules count more


def test_operator(spark, docs, no_docs):
    out = quality.assess(docs.select("doc_id", "text", "kept")).collect()
    assert len(out) == docs.count() and all(r.base_failed and not r.kept for r in out if r.n_words < 50)
    assert quality.assess(no_docs.select("doc_id", "text")).count() == 0
    prose = " ".join(f"the quick wa{chr(97 + i % 26)}b of word{chr(97 + i % 23)}{chr(97 + i % 7)} and more" for i in range(60))
    junk = " ".join("#| $$ || <> ## %%".split() * 40)
    rows = [(i, f"{prose} no {'abcdefghij'[i % 10]}") for i in range(60)] + [(100 + i, f"{junk} {i}") for i in range(20)]
    verdict = {r.doc_id: r.kept for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(verdict[100 + i] for i in range(20))
