"""Texts that the operators have to cope with."""

import pytest

LONG = " ".join(f"w{i % 977} and {i}" for i in range(20_000)) + "x" * 30_000

TEXTS = [
    None, "", " ", "\n\n \t", "a", "Hello  world,\nit's 2024!", "<|endoftext|> twice <|endoftext|><|endoftext|>",
    "naïve café 漢字 😀  　 x", "Ᲊ \U00010940 ՘ newer letters", "'s 't don't we'll I'VE", LONG,
    "same text of more than five words here", "same text of more than five words here",
    "mail a.b+c@x-y.example.org, 10.0.0.255 or 256.1.1.1; card 4111 1111 1111 1111, +1 (555) 555-0123 now",
]

ROWS = [(i, t, "x", "y", "z", "b") for i, t in enumerate(TEXTS)] + [
    (5, TEXTS[5], "x", "y", "z", "b"), (None, "no id here at all", None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and very long texts, repeats and columns with clashing names."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, ids string, score string, kept string, mix_block string")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
