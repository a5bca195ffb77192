"""Rows that every operator must take (fixtures)."""

import pytest

LONG = " ".join(f"w{i % 9973}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    columns whose names an operator might use itself."""
    rows = [
        (1, "the cat sat on the mat and looked at the moon", "en", "a"),
        (2, None, "en", None),
        (3, "", None, "a"),
        (4, " \n\t ", "en", "a"),
        (5, "12345 !!! ...", "en", "b"),
        (6, LONG, "en", "b"),
        (7, LONG, "en", "b"),
        (8, "the cat sat on the mat and looked at the moon", "en", "a"),
        (8, "the cat sat on the mat and looked at the moon", "en", "a"),
        (None, "the cat sat on the mat and looked at the moon", None, None),
        (9, "one", "fr", "a"),
        (10, "ONE", "fr", "a"),
        (11, "é\u00a0ü 漢字 \U0001f600 <|endoftext|> </s>[INST]", "de", "a"),
    ]
    kind = "doc_id bigint, text string, lang string, source string, _id string, _key int, score string, size string, shard string"
    return spark.createDataFrame([(*r, "x", 1, "s", "z", "q") for r in rows], kind)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
