from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from pregame.llm import ctw as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def symbols(text, depth):
    raw = bytes([255]) * depth + lower(text).encode() + b"\xff"
    return [(raw[i - depth:i], raw[i]) for i in range(depth, len(raw))]


def brute(docs, depth):
    """Scores by the definition: block probabilities by sequential estimates,
    weighted probabilities by recursion."""
    count = defaultdict(lambda: [0, 0])
    for r in docs:
        if not held(r.doc_id):
            for ctx, b in symbols(r.text, depth):
                for j in range(8):
                    for d in range(depth + 1):
                        count[ctx[depth - d:], (1 << j) | (b >> (8 - j))][b >> (7 - j) & 1] += 1
    children = defaultdict(set)
    for ctx, bits in list(count):
        if ctx:
            children[ctx[1:], bits].add((ctx, bits))

    def ln_block(n0, n1):
        return math.lgamma(n0 + .5) + math.lgamma(n1 + .5) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(node):
        own = ln_block(*count[node])
        if len(node[0]) == depth:
            return own
        below = sum(weighted(c) for c in children[node])
        return np.logaddexp(own, below) - math.log(2)

    @lru_cache(None)
    def one(ctx, bits):
        p = None
        for d in range(depth, -1, -1):
            node = (ctx[depth - d:], bits)
            if node not in count:
                continue
            n0, n1 = count[node]
            own = (n1 + .5) / (n0 + n1 + 1)
            if p is None:
                p = own
            else:
                below = sum(weighted(c) for c in children[node])
                share = 1 / (1 + math.exp(min(700, below - ln_block(n0, n1))))
                p = share * own + (1 - share) * p
        return .5 if p is None else p

    out = []
    for r in docs:
        s = 0.0
        for ctx, b in symbols(r.text, depth):
            for j in range(8):
                p = one(ctx, (1 << j) | (b >> (8 - j)))
                s += math.log10(p if b >> (7 - j) & 1 else 1 - p)
        out.append(s)
    return out


def base(docs):
    words = [[*WORD.findall(lower(r.text)), None] for r in docs]
    c = Counter(w for ws, r in zip(words, docs) if not held(r.doc_id) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(r.doc_id, held(r.doc_id), len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in ws)) for ws, r in zip(words, docs)]


@pytest.mark.parametrize("frame,depth,words", [("odd_docs", 2, 1 << 20), ("clashing", 3, 4), ("odd_docs", 1, 1), ("odd_docs", 5, 100)])
def test_against_the_definition(request, frame, depth, words):
    df = request.getfixturevalue(frame)
    docs = df.collect()
    got = sorted((tuple(r) for r in C.score_documents(df, depth=depth, words=words).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=lambda r: (str(r[0]), r[2], r[6]))
    want = sorted(((*b, s) for b, s in zip(base(docs), brute(docs, depth))), key=lambda r: (str(r[0]), r[2], r[6]))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-5)


def test_base_of_small_table(small_docs):
    docs = {r.doc_id: r for r in small_docs.collect()}
    got = {r.doc_id: r for r in C.score_documents(small_docs, depth=3, words=500).collect()}
    for doc_id, h, n, known, total, score in base(list(docs.values())):
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)


def test_empty_and_untrained(spark, no_docs):
    assert C.score_documents(no_docs).count() == 0
    only = spark.createDataFrame([(i, "ab") for i in range(200) if held(i)], "doc_id long, text string")
    rows = C.score_documents(only).collect()
    assert all(r.score == pytest.approx(-24 * math.log10(2)) and r.train_tokens == 0 and r.n_known == 0 for r in rows)


def test_chunks_and_forgetting_change_nothing(small_docs, monkeypatch):
    want = {r.doc_id: r.score for r in C.score_documents(small_docs, depth=3).collect()}
    monkeypatch.setattr(C, "CHUNK", 5000)
    monkeypatch.setattr(C, "KEPT_GRAMS", 1000)
    monkeypatch.setattr(C, "KEPT_WORDS", 500)
    monkeypatch.setattr(C._chunks, "__defaults__", (5000,))
    got = {r.doc_id: r.score for r in C.score_documents(small_docs, depth=3).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("nodes", [0, 40, 1500])
def test_whole_tree_answers_whatever_is_held(small_docs, nodes):
    df = small_docs.limit(60)
    docs = df.collect()
    got = {r.doc_id: r.score for r in C.score_documents(df, depth=3, nodes=nodes).collect()}
    assert got == pytest.approx({r.doc_id: s for r, s in zip(docs, brute(docs, 3))}, rel=1e-6)
