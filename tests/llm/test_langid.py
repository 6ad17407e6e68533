"""Phrases against a plain cross-parsing; accuracy on texts that were not learned from."""

import random

import numpy as np
from cases import TEXTS, docs, no_docs  # noqa: F401

from beatline.llm import langid

LANGS = {"aa": ["the", "of", "and", "ing", "tion", "er"], "bb": ["der", "die", "und", "lich", "keit", "ver"],
         "cc": ["que", "los", "ción", "ado", "mente", "el"]}


def text(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(LANGS[lang]) for _ in range(r.randint(1, 3))) for _ in range(n)).capitalize() + "."


SAMPLES = {lang: text(lang, 600, 0) for lang in LANGS}


def test_automaton_knows_exactly_the_substrings():
    codes = [int(c) for c in "0110100110010110"]
    table = langid.suffix_automaton(codes, 2)
    inside = {tuple(codes[i:j]) for i in range(len(codes)) for j in range(i, len(codes) + 1)}
    for n in range(1, 9):
        for k in range(2 ** n):
            word, state = [k >> i & 1 for i in range(n)], 1
            for c in word:
                state = table[state, c] if state else 0
            assert (state > 0) == (tuple(word) in inside)


def test_phrases_equal_plain_cross_parsing():
    p = langid.Parser(SAMPLES)
    for t in (text("aa", 40, 1), text("bb", 3, 2), "xyz 漢 the", "q"):
        codes = p.codes(t)
        got = p.phrases([codes, codes[:1]])[0]
        for k, lang in enumerate(p.languages):
            sample = p.codes(SAMPLES[lang]).tolist()
            inside = "".join(chr(c) for c in sample)
            n, i, phrase = 1, 0, ""
            for c in codes.tolist():
                grown = phrase + chr(c)
                if c != langid.UNKNOWN and grown in inside:
                    phrase = grown
                else:
                    n, phrase = n + 1, chr(c) if c != langid.UNKNOWN and chr(c) in inside else ""
            assert got[k] == n, (t, lang)
            assert i == 0
    assert len(p.codes("x" * 2000)) == 2000


def test_scripts_of_many_letters():
    r = random.Random(3)
    words = {lang: ["".join(chr(start + r.randrange(900)) for _ in range(2)) for _ in range(1500)]
             for lang, start in (("ja", 0x4E00), ("ko", 0xAC00), ("zh", 0x4E00 + 600))}  # two share 300 letters
    made = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    p = langid.Parser(SAMPLES | {lang: made(lang, 9000) for lang in words})
    assert len(set(p.codes("".join(w for some in words.values() for w in some)).tolist())) > 2000
    for lang in words:
        short = [made(lang, 6) for _ in range(30)]
        assert [got for got, _ in p(short)] == [lang] * 30
    assert p([text("bb", 20, 2)])[0][0] == "bb"


def test_segments_cover_whole_texts():
    p = langid.Parser(SAMPLES)
    t = text("aa", 900, 4)
    whole = p.phrases([p.codes(t)])[0]
    half = p.phrases([p.codes(t)[:len(t) // 2]])[0]
    assert (whole > 1.5 * half).all()


def test_held_out_accuracy(spark):
    rows = [(i, text(lang, 30 + i % 40, i), lang) for i, lang in enumerate(sorted(LANGS) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(df, df.where("doc_id % 4 <> 2")).where("doc_id % 4 = 2").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95 and all(0 <= r.score <= 1 for r in out)


def test_edges(spark, docs, no_docs):
    df = spark.createDataFrame([(i, text(lang, 300, i), lang) for i, lang in enumerate(sorted(LANGS) * 4)] + [
        (50, None, "aa"), (51, "text", None), (52, "", "bb")], "doc_id long, text string, lang string")
    out = {(r.doc_id, r.text): r for r in langid.identify(docs, df).collect()}
    for (_, t), r in out.items():
        assert (r.lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))
    assert langid.identify(no_docs, df).count() == 0
    nobody = langid.identify(docs, df.limit(0)).collect()
    assert len(nobody) == len(TEXTS) + 2 and {r.lang_pred for r in nobody} == {"und"}
    assert sum(map(len, langid.samples(df).values())) <= 3 * langid.SAMPLE
