"""Chunks whose coder is dear: marks at their end are coded apart, and the ids are the library's own."""

import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from beatline.llm import tokenfile
from beatline.llm.chunks import Chunks

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENDS = [*",.;:!?#*$%&", "$$$", "###", "&&&&", "?!", ",'", "'s,", "<|endoftext|>,", "1,", "-,", ")", "ª,", "Ƛ,", "中,", "\t,", " .", "\r"]


def test_ids_are_those_of_the_library():
    r, tok = random.Random(3), Tokenizer.from_file(PATH)
    stems = ["word", "don't", "Éau", "ß", "", "$", "̀", "x<|endoftext|>y", "7", "it's", "\tq"]
    texts = ["".join(r.choice(stems) + r.choice(["", *ENDS]) + r.choice([" ", " ", "\n", "  ", " \n"]) for _ in range(r.randrange(1, 9)))
             for _ in range(3000)]
    got = tokenfile.coder(PATH).encode(texts)
    for text, ids in zip(texts, got):
        assert ids == b"".join(i.to_bytes(4, "little") for i in tok.encode(text, add_special_tokens=False).ids), text


def test_a_chunk_is_coded_once_whatever_marks_end_it():
    coded = []

    def code(strings):
        coded.extend(strings)
        return [s.encode() for s in strings]

    texts = ["a word, word. word word###\nword,", "b word! word, Word$"]
    chunks = Chunks(code, dear=True)
    assert chunks.encode(texts) == [t.encode() for t in texts]
    assert sorted(coded) == sorted(["a", "b", " word", "\nword", " Word", ",", ".", "!", "$", "###"])


def test_generations_end_between_slices():
    """With room for one chunk every slice starts a generation; nothing is lost."""
    chunks = Chunks(lambda strings: [s.encode() for s in strings], most=1, dear=True)
    for text in ["x one, two.", "x two, three", "x one two, three."] * 3:
        assert chunks.encode([text]) == [text.encode()]


def odd_texts(seed, n):
    r = random.Random(seed)
    stems = ["word", "don't", "Éau", "ß", "", "$", "̀", "x<|endoftext|>y", "<|endoftext|>", "7", "it's", "\tq", "中文", "\u3000", "\x1c", "Ġ", "Ċ"]
    return ["", " ", "\n", "\n\n", "a", " a", "\na", "a ", "a\n", "a \nb", "\t a", "a\u3000 b"] + [
        "".join(r.choice(stems) + r.choice(["", *ENDS]) + r.choice([" ", " ", "\n", "  ", " \n"]) for _ in range(r.randrange(1, 9)))
        for _ in range(n)]


def test_columns_have_the_ids_of_the_library(monkeypatch):
    """In one slice, in slices of a few texts, and of a column that is itself a slice."""
    tok, texts = Tokenizer.from_file(PATH), odd_texts(5, 3000)
    expected = [b"".join(i.to_bytes(4, "little") for i in tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert tokenfile.coder(PATH).encode_column(pa.array(texts)) == expected
    monkeypatch.setattr("beatline.llm.chunks.COLUMN", 100)
    assert tokenfile.coder(PATH).encode_column(pa.array(texts).slice(7)) == expected[7:]
    assert tokenfile.coder(PATH).encode_column(pa.array([], pa.string())) == []


def test_a_chunk_is_looked_up_once_in_a_slice_of_a_column():
    looked_up = []

    class Held(dict):
        def get(self, key, default=None):
            looked_up.append(key)
            return super().get(key, default)

    chunks = Chunks(lambda strings: [s.encode() for s in strings])
    chunks.memory.new = Held()
    texts = ["a b c b", "", "a b\nb", "b  b"] * 50
    assert chunks.encode_column(pa.array(texts)) == [t.encode() for t in texts]
    assert sorted(looked_up) == ["", "\nb", "b", "c"]


def test_strings_that_a_blank_leads_need_no_mark():
    """They come in calls of the library of their own, and their number of ids does not matter."""
    led, plain = [], []

    def code(strings, to):
        to.extend(strings)
        return [s.encode() for s in strings]

    chunks = Chunks(lambda s: code(s, plain), dear=True, led=lambda s: code(s, led))
    assert chunks.encode_column(pa.array(["a word, b\nc", "a  b"])) == [b"a word, b\nc", b"a  b"]
    assert sorted(led) == ["\nc", " b", " word"] and sorted(plain) == [",", "a", "a", "a  b"]
