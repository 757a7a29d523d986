from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from pregame.llm import periodic


def slow_runs(w):
    """Every run by its definition: for each period, the maximal stretches of equal
    words, whose smallest period is that one."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_report(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(w)
    drop = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def pieces(rng, n, letters):
    """Text of random words, repeated blocks, blocks inside of blocks, and noise."""
    out = []
    while len(out) < n:
        block = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]))]
        if rng.random() < 0.4:
            block = block * rng.choice([4, 5, 9]) + [rng.randrange(letters) for _ in range(rng.randrange(3))]
        out += block * rng.choice([1, 1, 2, 3, 4, 5, 6]) + block[:rng.randrange(len(block) + 1)]
    return out[:n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_definition(seed):
    rng = random.Random(seed)
    texts = [pieces(rng, rng.choice([0, 1, 5, 6, 7, 20, 60, 150, 300]), rng.choice([1, 2, 3, 20])) for _ in range(60)]
    got = periodic.runs_of([np.array(t, np.int64) for t in texts])
    for t, r in zip(texts, got):
        assert [tuple(x) for x in r.tolist()] == slow_runs(t), t


def test_nested_and_long():
    small = [1, 2] * 9 + [3]
    word = small * 5 + [7, 8, 9]
    text = word * 6 + list(range(100, 150)) + [5] * 5000
    fib = [1], [1, 2]
    while len(fib[1]) < 700:
        fib = fib[1], fib[1] + fib[0]
    got = periodic.runs_of([np.array(text), np.array(fib[1])])
    assert [tuple(x) for x in got[0].tolist()] == slow_runs(text[:len(word) * 6 + 50]) + [(len(word) * 6 + 50, 5000, 1)]
    assert [tuple(x) for x in got[1].tolist()] == slow_runs(fib[1])


def test_set_is_consistent_and_dense():
    rng = random.Random(5)
    t = np.array(pieces(rng, 3000, 3) + [-1], np.int64)
    found = np.array(slow_all(t.tolist()), np.int64)
    names, scale = periodic._mixed(t.astype(np.uint64)), 1
    while scale <= 64:
        contexts = periodic._mixed(names * np.uint64(0x9E3779B97F4A7C15) + periodic._ahead(names, scale))
        out = periodic._omitted(found, scale, len(t))
        chosen = set(periodic.synchronising_set(names, out, scale).tolist())
        last = len(t) - 1 - 3 * scale
        member: dict = {}
        for i in range(last):
            assert member.setdefault(tuple(t[i:i + 2 * scale].tolist()), i in chosen) == (i in chosen)
            if not any(j in chosen for j in range(i, i + scale)):
                assert all(out[i:i + 2 * scale])
        names, scale = contexts, 2 * scale


def slow_all(w):
    """Stretches of four periods or more, whatever their length."""
    out = []
    for q in range(1, 17):
        same = np.array(w[q:]) == np.array(w[:-q])
        for s, c in zip(*periodic._stretches(same)):
            if c + q >= 4 * q:
                out.append((s, c + q, q))
    return out


def test_report_against_definition(spark, small_docs, odd_docs):
    for docs in (small_docs.select("doc_id", "text"), odd_docs.select("doc_id", "text")):
        got = sorted(map(tuple, periodic.run_report(periodic.with_planted_periods(docs)).collect()), key=str)
        want = sorted((slow_report(r.doc_id, r.text if r.text is None or len(r.text) < 30000 else r.text) for r in docs.collect()
                       if len((r.text or "").split()) < 1500), key=str)
        long = {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 1500}
        assert [r for r in got if r[0] not in long] == want and len(got) == docs.count()


def test_groups_do_not_matter(spark, small_docs, monkeypatch):
    a = sorted(periodic.run_report(small_docs).collect())
    monkeypatch.setattr(periodic, "GROUP", 50)
    assert sorted(periodic.run_report(small_docs.repartition(3)).collect()) == a


def test_collapse_and_clashing(spark, clashing, no_docs):
    from pyspark.sql import functions as F
    d = clashing.withColumn("runs", F.lit("x")).withColumn("Collapsed", F.lit("y"))
    out = periodic.collapse(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[7] == " ".join(got[7].split()) and len(got[7]) < 2 * len(got[1])  # 400 copies of a sentence: one stays
    assert periodic.with_runs(d).count() == d.count()
    assert periodic.run_report(no_docs).count() == 0 and periodic.collapse(no_docs).count() == 0
