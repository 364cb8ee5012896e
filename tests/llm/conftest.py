from __future__ import annotations

import random

import pytest

LETTERS = "abcdefghijklmnoprstuvwz"


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    long = " ".join(prose(1, 12_000))
    rows = [
        (1, "Hello  world, this is a text.\nIt has lines.", "en"), (2, "Hello world, this is a text. It has lines.", None), (2, "another text of the same id", "en"),
        (3, None, "en"), (4, "", "fr"), (None, "a text without an id", None), (None, None, None), (5, long, "de"), (5, long, "de"),
        (6, "a" * 70_000, "en"), (7, "élève 日本語 \U0001f600 <|endoftext|> 1234 don't", "fr"), (8, " \t \n ", None),
        (9, "repeated row", "en"), (9, "repeated row", "en"), (10, "!!! ???", None),
    ]
    docs = [(i, t, lang, "src", len(t or ""), 1, "x", 7, False) for i, t, lang in rows]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, row int, `sender` string, hash long, kept boolean")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.filter("1 = 0")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
