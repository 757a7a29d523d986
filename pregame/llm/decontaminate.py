"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions, answers) are normalised into words and cut into
windows of ``window`` consecutive words; a shorter text is one window.  All
windows go into one automaton, and every document is normalised the same way
and scanned once.  Matches are word ranges of the document; since normalising
never changes a byte's place, they map back to character offsets of the
original text.

Normalising: A-Z become a-z, words are runs of ``0-9 a-z`` and of every
non-ASCII character.  This is done on UTF-8 bytes, where all separators are
single ASCII bytes.

The benchmark is the stated query set.  Its windows are collected in blocks of
at most ``block_windows`` (so each broadcast automaton has a proven bound) and
the documents pass one block after another within the same stage; a benchmark
of up to that many windows is one automaton.  Documents are never shuffled.

Edge cases: a null or empty text has no words and is clean; a null item text
has no windows; a null item id is reported as the empty string; equal windows
of several items report all of them; repeated document rows give repeated
results; an empty benchmark leaves every document clean; very long texts are scanned
whole; extra columns, whatever their names, are kept (by ``find_passages`` except
those named like an output).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_place, quoted, replacing, text_slices

WINDOW = 10
BLOCK_WINDOWS = 200_000

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
])
_FOUND = T.StructType([
    T.StructField("_lo", T.ArrayType(T.LongType())),
    T.StructField("_hi", T.ArrayType(T.LongType())),
    T.StructField("_ids", T.ArrayType(T.StringType())),
])


def _byte_table() -> bytes:
    out = bytearray(b" " * 256)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            out[b] = b
        elif 0x41 <= b <= 0x5A:
            out[b] = b + 32
    return bytes(out)


NORMAL = _byte_table()


def windows(text: bytes | None, size: int = WINDOW) -> list[str]:
    """The windows of one benchmark text as automaton patterns: words joined by
    single spaces, with a space at both ends so that only whole words match."""
    words = (text or b"").translate(NORMAL).split()
    last = max(len(words) - size, 0)
    return [(b" " + b" ".join(words[i:i + size]) + b" ").decode("latin-1")
            for i in range(last + 1)] if words else []


def _blocks(items: DataFrame, item_id: str, text_cols: list[str], size: int, limit: int):
    """Yields {pattern: (words, item ids)} with at most about ``limit`` windows."""
    block: dict[str, set] = {}
    rows = items.select(F.coalesce(F.col(quoted(item_id)).cast("string"), F.lit("")).alias("i"),
                        *[F.col(quoted(c)).cast("string").cast("binary").alias(f"t{k}") for k, c in enumerate(text_cols)])
    for row in rows.toLocalIterator():
        for text in row[1:]:
            for p in windows(bytes(text) if text is not None else None, size):
                block.setdefault(p, set()).add(row[0])
        if len(block) >= limit:
            yield {p: (p.count(" ") - 1, sorted(ids)) for p, ids in block.items()}
            block = {}
    yield {p: (p.count(" ") - 1, sorted(ids)) for p, ids in block.items()}


def _scanner(patterns, place: int, first: bool, last: bool):
    """mapInArrow function: adds one block's matches; the last block turns all
    matches into the ``HITS`` columns."""

    def scan(batches):
        import ahocorasick
        import numpy as np
        import pyarrow as pa
        import re

        auto = ahocorasick.Automaton()
        for p, v in patterns.value.items():
            auto.add_word(p, v)
        if len(auto):
            auto.make_automaton()
        word = re.compile(rb"[^ ]+")
        for batch, texts in text_slices(batches, place):
            names = batch.schema.names
            keep = [n for n in names if n not in ("_lo", "_hi", "_ids")]
            before = [batch.column(names.index(n)).to_pylist() for n in ("_lo", "_hi", "_ids")] if not first else None
            out = []
            for k, raw in enumerate(texts):
                plain = (raw or b"").translate(NORMAL)
                words = plain.split()
                norm = b" " + b" ".join(words) + b" "
                found = list(auto.iter(norm.decode("latin-1"))) if words and len(auto) else []
                lo, hi, ids = ([list(b[k]) for b in before] if before else ([], [], []))
                if found:
                    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
                    ends = np.searchsorted(spaces, [e for e, _ in found])
                    lo += [int(e) - n for e, (_, (n, _)) in zip(ends, found)]
                    hi += ends.tolist()
                    ids = sorted(set(ids).union(*(v[1] for _, v in found)))
                if not last:
                    out.append((lo, hi, ids))
                    continue
                if not lo:
                    out.append((len(words), 0, [], [], []))
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi, -1)
                inside = np.cumsum(edge)[:-1] > 0
                step = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
                spots = [m.span() for m in word.finditer(plain)]
                tail = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80)))
                a = [spots[i][0] for i in step[0::2]]
                b = [spots[i - 1][1] for i in step[1::2]]
                out.append((len(words), int(inside.sum()), ids,
                            [int(x - tail[x]) for x in a], [int(x - tail[x]) for x in b]))
            if last:
                types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
                new = ["n_words", "n_hit", "items", "starts", "ends"]
            else:
                types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
                new = ["_lo", "_hi", "_ids"]
            cols = list(zip(*out)) or [()] * len(new)
            yield pa.RecordBatch.from_arrays([batch.column(names.index(n)) for n in keep]
                                             + [pa.array(c, t) for c, t in zip(cols, types)], keep + new)

    return scan


def find_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_texts: tuple[str, ...] = ("text",), window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` plus n_words, n_hit (words inside a match), items (ids of the
    items found, sorted as strings) and starts/ends (character ranges of the
    matched passages in the original text; merged, in order)."""
    spark = docs.sparkSession
    rest = replacing(docs, HITS.fieldNames()).columns
    out, at = by_place(docs)
    base = list(out.schema.fields)
    blocks = _blocks(items, item_id, list(item_texts), window, block_windows)
    block, first = next(blocks), True
    while block is not None:
        following = next(blocks, None)
        schema = T.StructType(base + (HITS if following is None else _FOUND).fields)
        out = out.mapInArrow(_scanner(spark.sparkContext.broadcast(block), docs.columns.index(text_col), first, following is None), schema)
        block, first = following, False
    return out.select(*[F.col(at[c]).alias(c) for c in rest], *HITS.fieldNames())


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs."""
    own, at = by_place(docs)
    return find_passages(own, items, text_col=at[text_col], **options).filter("n_hit = 0").select(
        *[F.col(v).alias(c) for c, v in at.items()])


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and the passages' character ranges."""
    found = find_passages(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
