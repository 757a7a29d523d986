from __future__ import annotations

import hashlib
import re

import pytest

from pregame.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        words = WORD.findall(lower(text))
        hit, ids = set(), set()
        for item_id, t in items:
            w = WORD.findall(lower(t))
            n = min(len(w), size)
            for i in range(len(w) - n + 1 if n else 0):
                for p in range(len(words) - n + 1):
                    if words[p:p + n] == w[i:i + n]:
                        hit |= set(range(p, p + n))
                        ids.add(str(item_id) if item_id is not None else "")
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items_of(spark, data):
    return spark.createDataFrame(data, "item_id long, text string")


ITEMS = [(1, "quick BROWN fox"), (10, "quick, brown; fox jumps!"), (2, "over the lazy dog and then it sleeps for a long while near"),
         (None, "漢字"), (5, None), (6, ""), (7, "fox jumps"), (8, "not there at all")]


@pytest.mark.parametrize("frame", ["odd_docs", "clashing"])
def test_odd_documents_against_brute_force(spark, request, frame):
    docs = request.getfixturevalue(frame)
    got = rows(D.contamination_report(docs, items_of(spark, ITEMS)), *COLS)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_several_blocks_give_the_same(spark, odd_docs):
    items = items_of(spark, ITEMS).coalesce(1)
    one = rows(D.find_passages(odd_docs, items), "doc_id", "n_words", "n_hit", "items", "starts", "ends")
    assert one == rows(D.find_passages(odd_docs, items, block_windows=1), "doc_id", "n_words", "n_hit", "items", "starts", "ends")


def test_offsets_point_into_the_original(spark):
    docs = spark.createDataFrame([(1, "Ä漢 — The QUICK\n\nbrown... fox! é end quick brown fox")], "doc_id long, text string")
    r = D.find_passages(docs, items_of(spark, [(1, "quick brown fox")])).first()
    assert [r.text[a:b] for a, b in zip(r.starts, r.ends)] == ["QUICK\n\nbrown... fox", "quick brown fox"]


def test_rows_kept(spark, clashing, no_docs):
    items = items_of(spark, [(1, "quick brown fox")])
    kept = D.decontaminate(clashing, items)
    assert kept.columns == clashing.columns
    clean = [r for r in clashing.collect() if "quick brown fox" not in lower(r.text)]
    assert sorted(map(str, kept.collect())) == sorted(map(str, clean))
    assert D.contamination_report(no_docs, items).count() == 0
    assert D.decontaminate(clashing, items_of(spark, [])).count() == clashing.count()
