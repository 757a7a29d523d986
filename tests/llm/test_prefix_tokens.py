from __future__ import annotations

import random

import pytest
import sentencepiece

from pregame.llm import prefix_tokens as X


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=X.vocabulary_file())


@pytest.fixture(scope="module")
def counter():
    return X.PrefixCounter(X.spines(X.vocabulary_file()))


def test_every_prefix_of_random_texts(counter, library):
    r = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "er", "漢", "é", "\U0001F600", "▁", "<s>", "</s>", "\x00", ".", "##", "(", "0", "12",
             "http", "//", "A", "THE", "́", "tion", "'s", "=", "internationalisation"]
    for _ in range(300):
        text = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        assert counter.prefix_counts(text) == [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert counter.count(text) == len(library.encode(text))


def test_without_spaces(counter, library):
    r = random.Random(6)
    text = "".join(r.choice("abcdefghinorst.") for _ in range(3000))
    assert counter.count(text) == len(library.encode(text))
    assert counter.prefix_counts(text)[1500] == len(library.encode(text[:1500]))


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "small_docs", "no_docs"])
def test_documents(request, frame, library):
    docs = request.getfixturevalue(frame)
    got = sorted(map(tuple, X.token_report(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)


def test_budget_questions(spark, library):
    from pyspark.sql import functions as F
    text = "Internationalisation of the   old\ntext, 漢字 and more."
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    table = X.count_tokens(docs, every_prefix=True)
    for n in (0, 1, 7, 20, 500):
        got = table.select("doc_id", X.tokens_in_prefix(F.col("prefix_tokens"), F.lit(n)).alias("t"),
                           X.longest_prefix_within(F.col("prefix_tokens"), F.lit(n)).alias("p")).collect()
        by = {r.doc_id: r for r in got}
        assert by[1].t == len(library.encode(text[:n]))
        assert by[1].p == max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= n)
        assert (by[2].t, by[2].p) == (0, 0)
