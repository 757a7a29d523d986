"""Fixtures of the corpus operators: awkward little document tables."""
from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a
    long text, odd characters."""
    base = "The quick brown fox jumps over the lazy dog and then it sleeps for a long while near the old river bank. "
    rows = [
        (1, base, "en", "s", 10), (2, base, "en", "s", 10), (2, base, "en", "s", 10), (3, None, "en", "s", None),
        (4, "", None, None, 0), (5, "   \n\t ", "de", "s", 3), (None, base + "x", None, "s", 5), (None, None, None, None, None),
        (6, base.upper(), "en", "s", 10), (7, base * 400, "en", "hot", 40000), (8, "Ünïcödé 漢字 \U0001F600 ÉÉ ok line \x00 nul", "fr", "s", 7),
        (9, "one", "en", "s", 3), (10, "one two three", "en", "s", 3), (11, "a\nb\na\n\nb\n", "en", "s", 3),
        (12, "der die das und nicht ist ein eine mit auf " * 5, "de", "s", 3), (12, "zwei andere Texte mit derselben Nummer", "de", "s", 3),
        (13, "!!! ??? 12345 ###", "en", "s", 3), (14, "<|endoftext|> and <s> </s> <unk> <0x0A> ▁ x", "en", "s", 3),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same rows with further columns named like outputs and helpers."""
    from pyspark.sql import functions as F
    return odd_docs.select("*", *[F.lit("x").alias(c) for c in (
        "n_words", "N_HIT", "items", "fp", "shard", "slot", "size", "key", "a", "b", "component_id", "piece", "start", "length",
        "offset", "score", "held_out", "lang_pred", "kept", "n_tokens", "host", "path", "rule", "verdict", "w", "n", "lo", "hi", "c0", "c1", "row", "t", "runs", "_text",
        "_id", "_content", "_p", "_raw", "_features", "_block", "_words", "_chars", "_bin", "_off", "_fill", "_lo", "_slot", "_bits", "_near")])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
