"""Encoding and decoding against the library, word for word and text for text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from cases import ROWS, TEXTS, docs, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from beatline.llm import bpe
from beatline.llm.chunks import Chunks, Memory

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def got(text):
    return np.frombuffer(bpe.loaded(PATH).encode([text])[0], "<u4").tolist()


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_known_texts(text):
    assert got(text) == expected(text)
    assert bpe.loaded(PATH).decode(np.array(got(text))) == LIBRARY.decode(expected(text), skip_special_tokens=False)


PIECES = st.sampled_from(["the", "in", "er", "th", " ", "  ", "\n", "\n\n", "\t", "a", "aa", "é", "漢", "'s", "1", "!", "<|endoftext|>",
                          " ", "Ᲊ", "Ⅷ", "²", "\x1c", "​"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.characters(exclude_categories=["Cs"])), max_size=40).map("".join))
def test_any_text(text):
    assert got(text) == expected(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50_400), max_size=12))
def test_any_ids_decode(ids):
    assert bpe.loaded(PATH).decode(np.array(ids, np.int64)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80))
def test_list_and_heap_merge_alike(data):
    model = bpe.loaded(PATH)
    old, bpe.SHORT = bpe.SHORT, 0
    try:
        heap = model.merge(data)
    finally:
        bpe.SHORT = old
    assert heap == model.merge(data) == model.encode_words([data])[0]


def test_compatible_pairs_are_those_that_merge_to_themselves():
    model = bpe.loaded(PATH)
    r = np.random.default_rng(3)
    known = np.array(list(model.token.values()))
    a, b = r.choice(known, 3000), r.choice(known, 3000)
    ok = model.compatible(a, b)
    for x, y, fits in zip(a.tolist(), b.tolist(), ok.tolist()):
        assert fits == (model.merge(model.bytes[x] + model.bytes[y]) == [x, y])


def test_memory_keeps_what_is_used_and_is_bounded():
    made = []
    memory = Memory(lambda keys: (made.extend(keys), [k.upper() for k in keys])[1], most=3)
    for keys in ({"a", "b"}, {"a", "c", "d"}, {"a", "e"}, {"a", "f", "g", "h"}, {"a"}):
        get = memory.learn(keys)
        assert [get(k) for k in sorted(keys)] == [k.upper() for k in sorted(keys)]
    assert made.count("a") == 1 and len(memory.new) + len(memory.old) <= 8


def test_chunks_equal_whole_texts():
    whole = Chunks(lambda strings: [b"|".join(s.encode().split(b" ")) for s in strings])
    assert whole.encode([]) == []


def test_operator(docs, no_docs):
    out = bpe.encode_decode(docs, PATH)
    assert out.columns == ["doc_id", "text", "score", "kept", "mix_block", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.ids == expected(r.text) and r.decoded == (r.text or "")
    digests = {r.doc_id: r for r in bpe.digests(out).collect()}
    r = digests[5]
    assert r.ids_sha256 == hashlib.sha256(",".join(map(str, expected(TEXTS[5]))).encode()).hexdigest()
    assert digests[0].ids_sha256 == digests[0].decoded_sha256 == hashlib.sha256(b"").hexdigest() and digests[0].n_tokens == 0
    assert bpe.encode_decode(no_docs, PATH).count() == 0
    again = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {r.doc_id: r.decoded for r in again.collect()} == {r.doc_id: r.decoded for r in rows}
