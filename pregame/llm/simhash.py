"""SimHash near-duplicates through Golay codes.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes
(seed 42) of its word shingles.  Fingerprints within ``MAX_BITS`` = 2 differing
bits are linked; a document's component is the smallest doc_id reachable.

Candidate keys.  A fingerprint is cut into segments of 23, 23 and 18 bits (the
last filled up with zeros).  The binary Golay code [23, 12] is perfect: every
23-bit word lies within three bits of exactly one of 4,096 codewords.  A
segment's indices are the codewords that the segment itself and its 23 one-bit
neighbours decode to: one or six.  Two segments at most two bits apart have a
common one-bit neighbour, hence a common index.  Of three segments that differ
in two bits altogether, one has no error at all (pigeonhole) and the one after
it has two at most.  So a fingerprint's keys are (segment number, the whole
segment, one index of the following segment): 35 bits, 3 to 18 keys, and any
two fingerprints within two bits share one.  Joined pairs are verified by the
bit count of their difference.

Scale.  Only distinct fingerprints are joined, whatever number of copies each
has.  Keys with up to ``PAIR_BUCKET`` fingerprints give pairs.  Fingerprints of
fuller buckets go another, equally exact way without any pairs: two words are
within two bits when they share a one-bit neighbour (or one is the neighbour of
the other), so each sends itself and its 64 neighbours, and all that meet at a
value (65 at most) are linked to the smallest.  Rows stay linear in the number
of fingerprints.  Nothing is broadcast or collected.

Edge cases: a null, empty or all-blank text has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; repeated rows are
one fingerprint and get one result row each; a null doc_id is no candidate for
a component's smallest id unless all are null; an empty table gives an empty
result; very long texts count whole; columns beyond the id and the text, whatever
their names, are ignored (or kept, in ``near_dedup``).  Joins on ``fp`` meet the
fingerprint that many texts share (null texts share zero) as a hot key on the side
of the texts' narrow rows only; adaptive execution splits it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from . import marks
from .common import by_place, cut, quoted, text_slices

SHINGLE = 3
SEED = 42
MAX_BITS = 2
PAIR_BUCKET = 12
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text."""
    import numpy as np
    import xxhash
    words = (text or b"").lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, seed=SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        import pyarrow as pa
        for batch, texts in text_slices(batches):
            fp = [fingerprint(t, shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp, pa.int64())],
                                             [*batch.schema.names[1:], "fp"])
    return run


def remainder_table():
    """Error pattern of weight three or less for each of the 2,048 remainders."""
    import numpy as np
    from itertools import combinations
    table = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            table[remainder(np.array([e]))[0]] = e
    return table


def remainder(words):
    """Remainders of 23-bit words (numpy integers) by the generator polynomial."""
    r = words.copy()
    for bit in range(22, 10, -1):
        r ^= ((r >> bit) & 1) * (GENERATOR << (bit - 11))
    return r


def _keys(batches):
    """fp -> (key, fp): see the module's text."""
    import numpy as np
    import pyarrow as pa
    table = remainder_table()
    flips = np.concatenate(([0], 1 << np.arange(23))).astype(np.int64)
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 20_000):
            fp = every[at:at + 20_000]
            u = fp.view(np.uint64)
            seg = [((u >> np.uint64(s)) & np.uint64(m)).astype(np.int64)
                   for s, m in ((0, (1 << 23) - 1), (23, (1 << 23) - 1), (46, (1 << 18) - 1))]
            for k in range(3):
                near = seg[(k + 1) % 3][:, None] ^ flips[None, :]
                index = np.sort((near ^ table[remainder(near)]) >> 11, axis=1)
                fresh = np.concatenate((np.ones((len(fp), 1), bool), index[:, 1:] != index[:, :-1]), axis=1)
                row, col = np.nonzero(fresh)
                key = (k << 35) | (seg[k][row] << 12) | index[row, col]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(fp[row], pa.int64())], ["key", "fp"])


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def links(prints: DataFrame, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) that connect exactly the
    fingerprints connected by links of two bits or fewer.  Every edge is such a
    link or leads over such links."""
    keys = prints.select("fp").mapInArrow(_keys, "key long, fp long")
    sizes = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                .filter("n > 1"))
    twos = sizes.filter("n = 2").select("a", "b").filter(_near("a", "b"))
    rest = sizes.filter("n > 2").select("key", "n")
    # fuller buckets: their fingerprints again, beside the bucket's size
    full = cut(keys.join(rest, "key"))
    some = full.filter(F.col("n") <= pair_bucket)
    pairs = (some.select("key", F.col("fp").alias("a")).join(some.select("key", F.col("fp").alias("b")), "key")
             .filter("a < b").select("a", "b").filter(_near("a", "b")))
    hot = full.filter(F.col("n") > pair_bucket).select("fp").distinct()
    meet = (hot.select("fp", F.explode(F.concat(F.array(F.col("fp")), F.transform(
                F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))).alias("w"))
            .groupBy("w").agg(F.collect_list("fp").alias("all"))  # 65 fingerprints at most can meet at one value
            .filter(F.size("all") > 1)
            .select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a <> b"))
    return twos.union(pairs).union(meet).distinct()


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The kept columns of ``docs`` plus fp (signed 64-bit fingerprint)."""
    d = docs.select(F.col(quoted(text_col)).cast("binary").alias("_text"), *(["doc_id"] if keep is None else keep))
    schema = T.StructType([*d.schema.fields[1:], T.StructField("fp", T.LongType())])
    return d.mapInArrow(_fingerprints(shingle), schema)


def component_of(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(fp, root, component_id) for the fingerprints of a table (id, fp): root
    names the fingerprint's component, component_id is its smallest id."""
    distinct = cut(prints.groupBy("fp").agg(F.min(id_col).alias("_least")))
    roots = components(links(distinct))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root"))
    # pre-aggregated, so one huge component is no hot key
    least = labelled.groupBy("root").agg(F.min("_least").alias("component_id"))
    return labelled.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    prints = cut(fingerprints(docs, shingle=shingle))
    comp = component_of(prints)
    return prints.join(comp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.  Where
    several rows have that id, the one of the smallest content hash stays, once;
    a null id stays only where the whole component has none.

    Which row stays is settled on narrow rows (id, content hash).  Rows that are
    alone in their component stay where they lie; the others are told from them by
    bitmaps of bounded size (``marks``), and only they are shuffled with their texts."""
    own, at = by_place(docs)
    content = F.xxhash64(*[F.col(c) for c in own.columns])
    id_of = F.col(at[id_col])
    prints = cut(fingerprints(own, at[text_col], [id_of.alias("_id"), content.alias("_content")]))
    member = cut(prints.join(component_of(prints, "_id"), "fp").drop("fp"))
    first = F.when(F.col("_id").eqNullSafe(F.col("component_id")), F.struct("_id", "_content"))
    # pre-aggregated, so one huge component is no hot key
    groups = cut(member.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("k")))
    several = member.join(groups.filter("n > 1").select("root"), "root", "left_semi")
    found = cut(marks.bitmaps(several, "_content"))  # 8 MB at most

    def flagged(df: DataFrame) -> DataFrame:
        d = df.withColumn("_slot", marks.slot(F.col("_content"))).join(F.broadcast(found), "_slot", "left")
        return d.withColumn("_asked", marks.is_set(F.col("_bits"), marks.bit(F.col("_content"))))

    rows = flagged(own.withColumn("_content", content))
    kept = flagged(groups.select(F.col("k._id").alias("_kid"), F.col("k._content").alias("_content"))).filter("_asked").select(
        "_kid", F.col("_content").alias("_kcontent"))
    asked = rows.filter("_asked").join(kept, id_of.eqNullSafe(F.col("_kid")) & (F.col("_content") == F.col("_kcontent")), "left_semi")
    names = own.columns
    once = asked.dropDuplicates([at[id_col], "_content"])
    out = rows.filter("NOT _asked").select(*names).union(once.select(*names))
    return out.select(*[F.col(v).alias(c) for c, v in at.items()])
