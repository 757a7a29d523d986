from __future__ import annotations

import re

import pytest
import xxhash

from pregame.llm import simhash as S
from pregame.operators.components import components


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids_prints, roots=False):
    """{fingerprint: smallest id reachable} by comparing all pairs."""
    prints = sorted({p for _, p in ids_prints})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    if roots:
        return {p: find(p) for p in prints}
    least = {}
    for d, p in ids_prints:
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return {p: least.get(find(p)) for p in prints}


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "small_docs", "no_docs"])
def test_against_brute_force(request, frame):
    docs = request.getfixturevalue(frame)
    texts = [(r.doc_id, slow_print(r.text)) for r in docs.collect()]
    comp = groups(texts)
    want = sorted(((d, f"{p:016x}", comp[p]) for d, p in texts), key=str)
    assert sorted(map(tuple, S.near_duplicates(docs).collect()), key=str) == want


@pytest.mark.parametrize("bucket", [0, 2, 12])
def test_links_of_dense_clusters(spark, bucket):
    """Clusters of fingerprints a few bits apart, joined by pairs and by shared
    neighbours, give the components of all pairs."""
    import random
    r = random.Random(3)
    prints = set()
    for _ in range(40):
        c = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 40])):
            p = c
            for _ in range(r.randrange(5)):
                p ^= 1 << r.randrange(64)
            prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = S.links(df, bucket)
    got = {r.node: r.root for r in components(edges).collect()}
    want = groups([(i, p) for i, p in enumerate(sorted(prints))])
    mine, theirs = {}, {}
    for p in prints:
        mine.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        theirs.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_golay_code_is_perfect():
    import numpy as np
    table = S.remainder_table()
    assert len(set(table.tolist())) == 2048
    words = np.arange(0, 1 << 23, 977, dtype=np.int64)
    assert (S.remainder(words ^ table[S.remainder(words)]) == 0).all()


def test_components_of_a_path(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, n)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_one_row_of_each_group(spark, clashing, no_docs):
    kept = S.near_dedup(clashing)
    assert kept.columns == clashing.columns
    texts = [(r.doc_id, slow_print(r.text)) for r in clashing.collect()]
    comp = groups(texts)
    rows = kept.collect()
    assert len(rows) == len(set(groups(texts, roots=True).values()))
    assert all(r.doc_id == comp[slow_print(r.text)] for r in rows)
    assert S.near_dedup(no_docs).count() == 0
