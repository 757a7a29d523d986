from __future__ import annotations

import zlib

import numpy as np
import pytest

from pregame.llm import langid as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [d for d, r in got.items() if r.held_out and truth[d]]
    assert len(held) > 100 and np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.98


@pytest.mark.parametrize("frame", ["odd_docs", "clashing"])
def test_odd_documents(request, frame):
    docs = request.getfixturevalue(frame)
    rows = L.identify(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und") for r in rows)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {3, 4, 5} <= und and 1 not in und


def test_empty_and_unlabelled(no_docs, odd_docs):
    from pyspark.sql import functions as F
    assert L.identify(no_docs).count() == 0
    rows = L.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_words_first_then_shorter_grams():
    logs = lambda *p: np.log(np.array(p))
    model = {"langs": ["a", "b"], "grams": {0: "known", 3: "abc\nbcd", 1: "x"},
             "logs": np.array([logs(.9, .1), logs(.2, .8), logs(.4, .6), logs(.7, .3)], np.float32)}
    s = L.Scorer(model)
    both = np.exp((logs(.2, .8) + logs(.4, .6)) / 2)
    got = np.exp(s.log_posteriors(["known", "abcd", "xyz", "qqq"]))
    assert np.allclose(got, [[.9, .1], both / both.sum(), [.7, .3], [.5, .5]])
    assert s.texts(["known known", "12 !", None]) == [
        ("a", pytest.approx(.9), pytest.approx(.81 / .82)), ("und", 0.0, 0.0), ("und", 0.0, 0.0)]


def test_forgetting_changes_nothing(small_docs):
    model = L.train(small_docs)
    texts = [r.text for r in small_docs.collect()]
    want = L.Scorer(model).texts(texts)
    s = L.Scorer(model, 10_000)
    got = [x for t in texts for x in s.texts([t])]
    assert [x[0] for x in got] == [x[0] for x in want] and np.allclose([x[1:] for x in got], [x[1:] for x in want], atol=1e-6)


def test_rows_kept(clashing, no_docs):
    kept = L.keep_identified(clashing)
    assert kept.columns == clashing.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 1 in ids and not ids & {3, 4, 5}
    assert L.keep_identified(no_docs).count() == 0


def slow_model(rows, size):
    """Counts and log frequencies by the definition: (order, gram) -> by language."""
    from collections import Counter, defaultdict
    words = defaultdict(Counter)
    for lang, text in {(r.lang, r.text) for r in rows if r.lang is not None and r.text is not None}:
        words[lang].update(w for w in L.words_of(text) if w.isalpha())
    counts = defaultdict(Counter)
    for lang, c in words.items():
        for w, n in c.items():
            if n > 1:
                counts[0, lang][w] += n
            p = f"^{w}$"
            for k in L.ORDERS:
                for i in range(len(p) - k + 1):
                    counts[k, lang][p[i:i + k]] += n
    langs = sorted(words)
    out = {}
    for k in (0, *L.ORDERS):
        known = {g for lang in langs for g, _ in sorted(counts[k, lang].items(), key=lambda x: (-x[1], x[0]))[:size]}
        for g in known:
            out[k, g] = [np.log((counts[k, lang][g] + .5) / (sum(counts[k, lang].values()) + .5 * (len(known) + 1))) for lang in langs]
    return langs, out


def test_training_against_definition(small_docs):
    """With all texts in the sample: the grams known, and their frequencies from all
    counts, also where a gram is below a language's own cut."""
    for size in (40, 10_000):
        model = L.train(small_docs, sample_texts=10 ** 9, table_size=size)
        langs, want = slow_model(small_docs.collect(), size)
        keys = [(k, g) for k, grams in model["grams"].items() for g in grams.split("\n")]
        assert model["langs"] == langs and set(keys) == set(want) and len(keys) == len(want)
        assert np.allclose(model["logs"], [want[k] for k in keys], atol=1e-5)


def test_many_labels(spark):
    """250 labels: every one is learned, within the model's bound."""
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i, j: alphabet[i // 26] + alphabet[i % 26] + alphabet[j % 26] + alphabet[i % 7]
    docs = spark.createDataFrame([(i, " ".join(word(i, j) for j in range(30)), f"l{i:03}") for i in range(250) for _ in range(2)],
                                 "doc_id long, text string, lang string")
    model = L.train(docs, cells=1 << 20)
    assert len(model["langs"]) == 250 and model["logs"].size <= 1 << 20
    got = L.predict(docs, model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95


def test_close_languages_stay(spark):
    """Three languages that share most words: no word speaks for one of them, the
    texts do."""
    shared = [f"wo{c}rd" for c in "abcdefghijklmnopqrst"]
    rows = [(i, " ".join(shared * 3 + [f"{lang}only"] * 2), lang) for i, lang in enumerate(["hr", "sr", "bs"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.keep_identified(docs).count() == 60
    assert max(r.score for r in L.predict(docs, L.train(docs)).collect()) < 0.5
