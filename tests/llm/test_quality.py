from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from pregame.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    inside = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "small_docs", "no_docs"])
def test_base_counts(request, frame):
    docs = request.getfixturevalue(frame)
    got = sorted((tuple(r) for r in Q.judge(docs).select("doc_id", *Q.BASE, "base_failed").collect()), key=str)
    assert got == sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=str)


def jensen_shannon(p, q):
    kl = lambda a, m: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def test_distances_against_brute_force(spark, small_docs):
    import unicodedata
    rows = small_docs.collect()
    refs = {r["lang"]: r for r in Q.references(small_docs)}

    def classes(t):
        kinds = [unicodedata.category(c) for c in t]
        space = sum(c in " \t\n\x0b\x0c\r" for c in t)
        upper, digit = sum(k == "Lu" for k in kinds), sum(c in "0123456789" for c in t)
        mark = sum(k[0] in "PS" for k in kinds)
        return [upper, digit, mark, space, len(t) - upper - digit - mark - space]

    for lang, ref in refs.items():
        own = [r.text for r in rows if r.lang == lang and r.text]
        total = [sum(x) for x in zip(*map(classes, own))]
        assert ref["classes"] == pytest.approx([x / sum(total) for x in total])
        words = Counter(w for t in own for w in WORD.findall(t))
        n = sum(words.values())
        assert ref["words"] == pytest.approx({w: c / n for w, c in words.items() if c >= Q.COMMON_SHARE * n})
    got = {r.doc_id: r for r in Q.judge(small_docs).collect()}
    for r in rows:
        if r.lang not in refs or not WORD.findall(r.text or ""):
            continue
        near = []
        w, c = Counter(WORD.findall(r.text)), classes(r.text)
        n = sum(w.values())
        for lang, ref in refs.items():
            p = [w[x] / n for x in ref["words"]]
            q = list(ref["words"].values())
            jw = jensen_shannon([*p, 1 - sum(p)], [*q, 1 - sum(q)]) / jensen_shannon([*(0 for _ in q), 1], [*q, 1 - sum(q)])
            jc = jensen_shannon([x / sum(c) for x in c], ref["classes"])
            far = max(jc / Q.CLASS_DISTANCE if len(r.text) >= Q.MIN_CHARS else 0, jw / (Q.WORD_DISTANCE + Q.WORD_SLACK / n ** .5) if n >= Q.MIN_WORDS else 0)
            near.append((far, lang, jc, jw))
        g = got[r.doc_id]
        far = min(near)[0]
        assert (g.class_distance, g.word_distance) == pytest.approx(next(x[2:] for x in near if x[1] == g.near_lang), abs=1e-6)
        assert g.kept == (not g.base_failed and far <= 1)


def test_junk_goes_and_clean_text_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in Q.judge(docs).collect() if not r.base_failed]
    junk = [r.kept for r in rows if re.search(r"(### |&&& |\*\*\* )", r.text) or " | " in r.text]
    clean = [r.kept for r in rows if not re.search(r"[#&*|$%]", r.text) and "!! " not in r.text]
    assert len(junk) > 20 and sum(junk) < 0.1 * len(junk)
    assert len(clean) > 300 and sum(clean) > 0.995 * len(clean)


def test_rows_kept(clashing, no_docs, odd_docs):
    from pyspark.sql import functions as F
    kept = Q.keep_good(clashing)
    assert kept.columns == clashing.columns
    want = {(r.doc_id, r.text) for r in Q.judge(odd_docs).filter("kept").collect()}
    assert {(r.doc_id, r.text) for r in kept.collect()} == want
    assert Q.keep_good(no_docs).count() == 0
    bare = Q.judge(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r.kept == (not r.base_failed) for r in bare)


def _language(k, n):
    """n words of an invented language: ten common words and rarer ones, none of
    them in another language."""
    return " ".join(f"q{k}x{i % 10}" if i % 2 else f"r{k}y{(i * i + i // 7) % 997}" for i in range(n))


def test_every_language_is_a_reference(spark):
    rows = [(100 * k + j, _language(k, 600 + j), f"l{k:02}", "s", 0) for k in range(60) for j in range(2 if k > 50 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert len(Q.references(docs)) == 60
    got = Q.judge(docs).collect()
    assert all(r.kept and r.near_lang == r.lang for r in got)


def test_label_without_reference_is_left_to_the_base_rules(spark):
    rows = [(j, _language(1, 600 + j), "big", "s", 0) for j in range(4)]
    rows += [(10, _language(2, 500), "small", "s", 0), (11, "spam " * 500, "small", "s", 0), (12, _language(3, 500), None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.kept for r in Q.judge(docs).collect()}
    assert got[10] and not got[11] and not got[12]


def test_sql_agrees_on_many_and_on_small_languages(spark):
    """The oracle SQL on 60 languages, a label of 500 words, and one foreign text."""
    import duckdb

    from pregame.llm import queries
    rows = [(100 * k + j, _language(k, 600 + j), f"l{k:02}") for k in range(60) for j in range(2 if k > 50 else 4)]
    rows += [(9001, _language(71, 500), "small"), (9002, _language(72, 500), None), (9003, "spam " * 500, "small"), (9004, None, "l01"), (9005, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    got = Q.quality_report(docs)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL['op7_quality']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert kept[9001] and not kept[9002] and not kept[9003] and all(kept[100 * k] for k in range(60))
