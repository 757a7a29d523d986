"""Best-fit packing of documents into token sequences, as a tree of rounds.

``pieces`` tokenises whole texts (in Arrow batches, each distinct word once a
task), ends every document with one id and cuts only documents longer than a
sequence.  ``pack`` packs any table of sized items:

1. the items (narrow rows, checkpointed) are dealt to tasks of about ``UNIT``
   items, however many partitions they came in, and each task packs its own
   best-fit decreasing, at most ``UNIT`` at a time, so memory is bounded;
2. bins with ``GAP`` free places or fewer are nearly full and stay as they are;
3. underfull bins become items themselves: they are dealt by hash to tasks of
   about ``UNIT`` bins and packed again, round after round (a tree merge), until
   a round fits one task or saves no bin;
4. every round leaves a narrow table bin -> parent bin and offset; the items
   follow it by equi-joins.

Only ids, sizes and checksums are shuffled, never texts.  Bin numbers come from
the task number and a counter and are checkpointed before anything uses them,
so a lost executor cannot renumber them.

Edge cases: a null or empty text is the end id alone; a very long text is cut into
pieces of ``CAPACITY``; repeated rows are items of their own; a null doc_id is kept; an item larger than the capacity raises;
an empty table gives an empty result; extra columns, whatever their names, are left
out by ``pack_documents`` and kept by ``pack`` (those named like an output are
replaced).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Remembered, cut, quoted, replacing, text_slices

CAPACITY = 4096
END_ID = 1
UNIT = 1 << 16
GAP = 8
MEMO_BYTES = 160 << 20  # of words whose ids a task keeps


def tokeniser_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _drops_white_space(data: bytes) -> bool:
    """Does the tokeniser lower-case, keep the matches of a rule without white
    space, and map bytes?  Others get whole texts."""
    import json
    conf = json.loads(data)
    norm = [n["type"] for n in (conf["normalizer"] or {}).get("normalizers", [])]
    steps = (conf["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (norm == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["invert"] and steps[0]["behavior"] == "Removed" and not steps[1]["use_regex"]
            and not steps[1]["add_prefix_space"] and steps[0]["pattern"].get("Regex") ==
            "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")


class _Ids(Remembered):
    """word -> its ids as little-endian 32-bit bytes."""

    def __init__(self, data: bytes, memo_bytes: int = MEMO_BYTES):
        import os
        import re
        from struct import Struct
        super().__init__(memo_bytes, 220)  # two byte strings and a place in a dict
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokeniser = Tokenizer.from_str(data.decode())
        self.encode, self.merge = tokeniser.encode_batch_fast, tokeniser.model.tokenize
        self.by_word = _drops_white_space(data)
        self.packers = [Struct(f"<{n}I").pack for n in range(65)]
        self.struct = Struct
        # letters or digits, then plain marks: the splitting rule cuts between them
        self.plain = re.compile(rb"[a-z]{1,64}").fullmatch
        self.marked = re.compile(rb"(.*[0-9a-z])([.,;:!?#$%&*]+)", re.S).fullmatch

    def work(self, word: bytes) -> bytes:
        parts = self.marked(word)
        if parts:
            return self[parts[1]] + self[parts[2]]
        if self.plain(word):  # nothing to normalise, split or map: merging is all
            return self.packed([t.id for t in self.merge(word.decode())])
        return self.whole(word)

    def packed(self, ids: list[int]) -> bytes:
        n = len(ids)
        return (self.packers[n] if n < 65 else self.struct(f"<{n}I").pack)(*ids)

    def whole(self, text: bytes) -> bytes:
        return self.packed(self.encode([text.decode()], add_special_tokens=False)[0].ids)

    def of(self, text: bytes | None) -> bytes:
        """Ids of a text.  Where white space ends every match of the splitting
        rule and is then dropped, they are those of the text's words one after
        another.  Letter case is dropped as well, but special strings
        are looked for before that: texts that may hold one keep theirs."""
        text = text or b""
        if not self.by_word:
            return self.whole(text)
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


def _pieces(model, capacity: int, end_id: int):
    def run(batches):
        import zlib

        import pyarrow as pa
        ids_of = _Ids(model.value).of
        end, width = end_id.to_bytes(4, "little"), 4 * capacity
        for batch, texts in text_slices(batches):
            out = []
            keep = []
            for row, text in enumerate(texts):
                ids = ids_of(text) + end
                for piece, b in enumerate(range(0, len(ids), width)):
                    part = ids[b:b + width]
                    keep.append(row)
                    out.append((piece, b // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) or [()] * 4
            rest = [c.take(pa.array(keep, pa.int64())) for c in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(
                rest + [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                batch.schema.names[1:] + ["piece", "start", "length", "ids_crc32"])
        pa.default_memory_pool().release_unused()
    return run


def pieces(docs: DataFrame, tokeniser: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document.  The vocabulary
    file (its size is its bound) is read on the driver and broadcast."""
    with open(tokeniser or tokeniser_file(), "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    d = docs.select(F.col(quoted(text_col)).cast("binary").alias("_text"), F.col(quoted(id_col)))
    schema = T.StructType([d.schema[1], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return d.mapInArrow(_pieces(model, capacity, end_id), schema)


def best_fit(sizes, capacity: int):
    """Best-fit decreasing: (bin, offset) of every size and each bin's fill.
    Ties go to the earlier item and the bin opened last."""
    import numpy as np
    sizes = np.asarray(sizes, np.int64)
    if len(sizes) and (sizes.max() > capacity or sizes.min() < 0):
        raise ValueError(f"items must have sizes from 0 to {capacity}")
    bins, offsets, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r free places
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins, offsets, fills


def _local(size_col: str, capacity: int, unit: int):
    """Packs a task's rows; adds _bin, _off and _fill (of the whole bin)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        base, held, rows = TaskContext.get().partitionId() << 33, [], 0

        def flush():
            nonlocal base, held, rows
            t = pa.Table.from_batches(held)
            bins, offs, fills = best_fit(t.column(size_col).to_numpy(), capacity)
            fill = np.asarray(fills, np.int64)[bins] if len(fills) else bins
            for name, values in (("_bin", bins + base), ("_off", offs), ("_fill", fill)):
                t = t.append_column(name, pa.array(values, pa.int64()))
            base += len(fills)
            held, rows = [], 0
            return t.combine_chunks().to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, unit):
                held.append(batch.slice(at, unit))
                rows += held[-1].num_rows
                if rows >= unit:
                    yield from flush()
        if held:
            yield from flush()
    return run


def _merge(capacity: int, unit: int):
    """Packs a task's bins (bin, fill) as items; a parent is called after its
    first bin."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        ids, sizes = (t.column(c).to_numpy() for c in ("bin", "fill"))
        order = np.argsort(ids, kind="stable")  # rows come in any order after a shuffle
        ids, sizes = ids[order], sizes[order]
        for at in range(0, len(ids), 4 * unit):
            i, s = ids[at:at + 4 * unit], sizes[at:at + 4 * unit]
            bins, offs, fills = best_fit(s, capacity)
            first = np.zeros(len(fills), np.int64)
            first[bins[offs == 0]] = i[offs == 0]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (
                i, first[bins], offs, np.asarray(fills, np.int64)[bins])], ["bin", "parent", "shift", "fill"])
    return run


def pack(items: DataFrame, size_col: str, capacity: int = CAPACITY, unit: int = UNIT, gap: int = GAP) -> DataFrame:
    """``items`` plus sequence_id and offset: sequences of at most ``capacity``,
    filled gaplessly from 0.  ``size_col`` is a long of 1 to ``capacity``."""
    names = items.columns
    own = replacing(items, ["sequence_id", "offset"])
    place = {c: i for i, c in enumerate(names)}
    d = cut(items.toDF(*[f"c{i}" for i in range(len(names))]))
    n = d.count()
    if n:  # items in tasks of about a unit, by a number that the checkpoint fixes
        d = d.withColumn("_at", F.monotonically_increasing_id())
        d = d.repartition(-(-n // unit), F.xxhash64("_at")).drop("_at")
    schema = T.StructType(d.schema.fields + [T.StructField(c, T.LongType()) for c in ("_bin", "_off", "_fill")])
    packed = cut(d.mapInArrow(_local(f"c{place[size_col]}", capacity, unit), schema))
    out = packed.withColumns({"_sequence": F.col("_bin"), "_offset": F.col("_off")}).drop("_bin", "_off", "_fill")
    # one row a bin: that of its first item
    open_bins = packed.filter("_off = 0").select(F.col("_bin").alias("bin"), F.col("_fill").alias("fill"))
    left = open_bins.filter(F.col("fill") < capacity - gap)
    n = left.count()
    round_no = 0
    while n > 1:
        tasks = -(-n // unit)
        dealt = left.repartition(tasks, F.xxhash64("bin", F.lit(round_no)))
        merged = cut(dealt.mapInArrow(_merge(capacity, unit), "bin long, parent long, shift long, fill long"))
        moved = merged.select(F.col("bin").alias("_bin"), F.col("parent").alias("_parent"), F.col("shift").alias("_shift")) \
            .filter("_bin <> _parent")
        out = (out.join(moved, out["_sequence"] == moved["_bin"], "left")
               .withColumn("_offset", F.col("_offset") + F.coalesce("_shift", F.lit(0)))
               .withColumn("_sequence", F.coalesce("_parent", "_sequence")).drop("_bin", "_parent", "_shift"))
        left = merged.filter("bin = parent").select("bin", "fill").filter(F.col("fill") < capacity - gap)
        now = merged.filter("bin = parent").count()
        if tasks == 1 or now == n:
            break
        n, round_no = left.count(), round_no + 1
    return out.select(*[F.col(f"c{place[c]}").alias(c) for c in own.columns], F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, tokeniser: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    return pack(pieces(docs, tokeniser, capacity), "length", capacity)
