"""Awkward rows for the training-data operators."""

import pytest
from llm_helpers import prose


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, tiny, repeated, very long, non-Latin, white-space and control-character texts."""
    long = prose(1, 30_000)
    shared = prose(2, 90)
    return [
        None, "", " \n\t ", "x", "x", "Été ß İ ﬁ ñ", "a\x1cb c\x85d e", long, long,
        prose(3, 40) + " " + shared + " " + prose(4, 30), shared + " " + prose(5, 60), prose(6, 10) + " " + shared,
        "ha " * 400, "#$% !!! *** | <> " * 30, "line one two\nline one two\n\nline one two",
        "Released under the MIT License. Apache License, Version 2.0; CC BY-NC 4.0 under the mit license",
        "<|endoftext|> said <|ENDOFTEXT|> don't they're 1234 日本語 🙂",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The texts as documents with null ids, repeated ids and clashing extra columns."""
    rows = [
        (None if i == 3 else 8 if i == 9 else i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", i, f"k{i}")
        for i, t in enumerate(odd_texts)
    ]
    schema = "doc_id long, text string, lang string, source string, score int, row string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
