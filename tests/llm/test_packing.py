from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pregame.llm import packing as P


def want(docs, capacity):
    tok = Tokenizer.from_file(P.tokeniser_file())
    out = []
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def sound(rows, capacity):
    """Sequences are filled gaplessly from 0 and hold no more than they may."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("frame,capacity", [("odd_docs", 4096), ("clashing", 16), ("small_docs", 4096), ("no_docs", 4096)])
def test_documents(request, frame, capacity):
    docs = request.getfixturevalue(frame)
    rows = P.pack_documents(docs, capacity=capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == want(docs, capacity)
    sound(rows, capacity)


def fewest(sizes, capacity):
    return -(-sum(sizes) // capacity)


@pytest.mark.parametrize("unit,over", [(64, 0.07), (1 << 16, 0.03)])
def test_rounds_come_near_the_bound(spark, unit, over):
    """Many small partitions of awkward sizes, several rounds."""
    items = spark.range(0, 6000, 1, 24).selectExpr("id", "1 + pmod(xxhash64(id), 900) AS length")
    rows = P.pack(items, "length", 1000, unit=unit).collect()
    n = sound(rows, 1000)
    assert len(rows) == 6000 and n <= (1 + over) * fewest([r.length for r in rows], 1000)


def test_nothing_to_merge(spark):
    """Items over half a sequence: no round can save any, and the rounds end."""
    rows = P.pack(spark.range(0, 500, 1, 8).selectExpr("id", "600L AS length"), "length", 1000, unit=32).collect()
    assert sound(rows, 1000) == 500


def test_best_fit():
    bins, offsets, fills = P.best_fit([3, 7, 5, 5, 10, 0], 10)
    assert sorted(fills) == [10, 10, 10] and fills[bins[4]] == 10 and offsets[4] == 0
    with pytest.raises(ValueError):
        P.best_fit([11], 10)


def test_layout_does_not_matter(spark):
    """1, 16 and 200 input partitions: as few sequences within 0.1 %, all near the
    sum of lengths."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = []
    for parts in (1, 16, 200):
        rows = P.pack_documents(docs.repartition(parts)).select("sequence_id", "offset", "length").collect()
        counts.append(sound(rows, 4096))
    assert max(counts) <= 1.001 * min(counts) + 1 and max(counts) <= 1.01 * fewest([r.length for r in rows], 4096) + 1


def test_forgetting_changes_nothing(small_docs):
    with open(P.tokeniser_file(), "rb") as f:
        data = f.read()
    texts = [(r.text or "").encode() for r in small_docs.collect()]
    little, much = P._Ids(data, 20_000), P._Ids(data)
    assert [little.of(t) for t in texts] == [much.of(t) for t in texts] and len(little) < len(much)
