"""Documents of all hard kinds, for the tests of this folder."""

from __future__ import annotations

import re

import pytest

EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def hard_rows() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties, repeated rows, marks inside texts."""
    long_text = "ein langer Text über Wörter und the others " * 9000
    return [
        (1, "the same words here and there, once more", "en", "a", 10),
        (2, "the same words here and there, once more", "en", "a", 10),
        (2, "the same words here and there, once more", "en", "a", 10),
        (None, "the same words here and there, once more", None, None, None),
        (3, None, "en", "b", 0),
        (4, "", "de", "b", 0),
        (5, " \t\n ", "de", None, 0),
        (6, "one", "fr", "", 3),
        (7, long_text, "de", "c", len(long_text)),
        (8, "x" * 70_000, None, "c", 70_000),
        (9, "1234 5678 !!! ###", "en", "a", 17),
        (10, "<s> </s> <|endoftext|> <|startoftext|> ▁ 你好 \U0001d11e", "en", "a", 30),
        (2, "another text under the same id", "en", "b", 30),
    ]


@pytest.fixture()
def hard(spark):
    """Documents of all hard kinds, with columns whose names operators use themselves."""
    schema = EMPTY + ", id long, sig string, row string, `a.b` int"
    return spark.createDataFrame([(*r, 7, "s", "r", 1) for r in hard_rows()], schema)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], EMPTY)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
