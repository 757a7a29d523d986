"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q that holds its
period ``EXPONENT`` = 4 times or more, is at least ``LEAST_LENGTH`` words long and
cannot be extended to either side.

For a scale t, the synchronising set holds the positions i at which the smallest
hash of t-word stretches starting in [i, i + t] stands at i or at i + t.  Whether
i belongs to it depends on the 2t words from i alone (equal contexts, equal
membership), and any t consecutive positions hold one, unless the 3t - 1 words
there have a period of t / 4 or less.  Stretches with such a small period are left
out of the minima: a repeating stretch would otherwise fill the set.

Scales are dyadic.  A run with t <= q < 2t reaches over t + q + 2t positions, so it
holds a synchronising position s whose whole context recurs at s + q: the next
position of the set with an equal context is q further on, and the pair proposes
q.  Proposals are extended word by word to both sides, which verifies them.
Periods of up to ``DIRECT`` words are found by comparing every word with its
neighbours; these highly periodic regions, and the runs of the smaller scales, are
what the set of a scale leaves out, and they supply their small periods
themselves.

The texts of a task are worked off in groups of about ``GROUP`` bytes, laid end to
end with separators that equal nothing, longest first; a scale looks only at the
texts long enough for it.  A text costs about words x log(words) array steps and
is never cut.  Nothing is shuffled.

Edge cases: a null, empty or blank text has no words and no runs, and its
collapsed text is empty; repeated rows give equal results; equal words are equal
bytes; very long texts make a group of their own; a null id is kept; an empty
table gives an empty result; extra columns are kept by ``with_runs`` and
``collapse`` (those named like an output are replaced) and left out of
``run_report``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, crc_text, quoted, replacing, text_slices

LEAST_LENGTH = 6
EXPONENT = 4
DIRECT = 3
GROUP = 3 << 19  # bytes of text worked off together

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _mixed(x):
    """Scrambled unsigned 64-bit numbers (the finaliser of a counter-based generator)."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ahead(x, by: int):
    """x[i + by]; the last places wrap round, which only stretches that cross a
    separator can see."""
    import numpy as np
    return np.roll(x, -by)


def _stretches(same):
    """(start, count) of the runs of True."""
    import numpy as np
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2] - edge[0::2]


def _direct(t):
    """Runs of the periods up to DIRECT, by comparing neighbours."""
    import numpy as np
    out = []
    for q in range(1, min(DIRECT, len(t) - 1) + 1):
        start, count = _stretches(t[q:] == t[:-q])
        length = count + q
        keep = length >= EXPONENT * q
        start, length = start[keep], length[keep]
        # of periods 2 and 3 the only smaller one can be 1
        if q > 1 and len(start):
            single = np.all([t[start + k] == t[start] for k in range(1, q)], axis=0)
            start, length = start[~single], length[~single]
        out.append(np.column_stack((start, length, np.full(len(start), q))))
    return out


def _extended(t, at: int, q: int):
    """(start, length) of the longest stretch around position ``at`` in which
    words q apart are equal."""
    import numpy as np
    end, step, last = at, 64, len(t) - q
    while end < last:
        stop = min(end + step, last)
        other = np.flatnonzero(t[end:stop] != t[end + q:stop + q])
        if len(other):
            end += int(other[0])
            break
        end, step = stop, min(step * 2, 1 << 16)
    start, step = at, 64
    while start > 0:
        stop = max(start - step, 0)
        other = np.flatnonzero(t[stop:start] != t[stop + q:start + q])
        if len(other):
            start = stop + int(other[-1]) + 1
            break
        start, step = stop, min(step * 2, 1 << 16)
    return start, end + q - start


def _omitted(runs, scale: int, size: int):
    """Positions whose ``scale``-word stretch has a period of a quarter or less."""
    import numpy as np
    r = runs[(runs[:, 2] * EXPONENT <= scale) & (runs[:, 1] >= scale) & (runs[:, 0] < size)]
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, r[:, 0], 1)
    np.add.at(edge, np.minimum(r[:, 0] + r[:, 1] - scale + 1, size), -1)
    return np.cumsum(edge[:-1]) > 0


def synchronising_set(names, omitted, scale: int):
    """Positions at which the smallest name of [i, i + scale] stands at an end;
    ``names[i]`` names the ``scale`` words from i."""
    import numpy as np
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    names = np.where(omitted, none, names)
    least, width = names, 1
    while width < scale:
        least = np.minimum(least, _ahead(least, width))
        width *= 2
    far = _ahead(names, scale)
    least = np.minimum(least, far)
    return np.flatnonzero(((least == names) | (least == far)) & (least != none))


def _proposals(at, contexts, scale: int):
    """(position, period): the next position of the set with an equal context, at
    least ``scale`` and less than twice as far; the first of each chain whose
    stretches overlap by a whole period."""
    import numpy as np
    key = contexts[at]
    order = np.argsort(key, kind="stable")
    pos, key = at[order], key[order]
    far = np.diff(pos)
    ok = (key[1:] == key[:-1]) & (far >= scale) & (far < 2 * scale)
    first, far = pos[:-1][ok], far[ok]
    order = np.lexsort((first, far))
    first, far = first[order], far[order]
    head = np.ones(len(first), bool)
    head[1:] = (far[1:] != far[:-1]) | (np.diff(first) > 2 * scale)
    return zip(first[head].tolist(), far[head].tolist())


def runs_of(texts: list) -> list:
    """Runs of every text (arrays of numbers, equal words having equal numbers):
    one array of rows (start, length, period) each, by start, then period."""
    import numpy as np
    none = np.zeros((0, 3), np.int64)
    order = sorted((i for i, t in enumerate(texts) if len(t) >= LEAST_LENGTH), key=lambda i: -len(texts[i]))
    out = [none] * len(texts)
    if not order:
        return out
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    t = np.empty(begin[-1], np.int64)
    for k, i in enumerate(order):
        t[begin[k]:begin[k + 1] - 1] = texts[i]
        t[begin[k + 1] - 1] = -1 - k  # a separator equals nothing
    found = np.concatenate([none, *_direct(t)]).astype(np.int64)
    names, scale = _mixed(t.astype(np.uint64)), 1
    while True:
        # texts that can hold a run of a period of ``scale``
        names = names[:begin[np.searchsorted(-sizes, -EXPONENT * scale, side="right")]]
        if not len(names):
            break
        contexts = _mixed(names * np.uint64(0x9E3779B97F4A7C15) + _ahead(names, scale))
        if scale > DIRECT:
            at = synchronising_set(names, _omitted(found, scale, len(names)), scale)
            got, past = [], (0, 0)  # (period, end) of the last stretch
            for i, q in _proposals(at, contexts, scale):
                if past[0] == q and i + q + 2 * scale <= past[1]:
                    continue
                start, length = _extended(t, i, q)
                if start + length < i + q + 2 * scale:
                    continue  # contexts differ, only their hashes were equal
                past = (q, start + length)
                if length >= EXPONENT * q:
                    got.append((start, length, q))
            if got:
                found = np.concatenate((found, np.array(got, np.int64)))
        names, scale = contexts, 2 * scale
    found = found[found[:, 1] >= LEAST_LENGTH]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    text = np.searchsorted(begin, found[:, 0], side="right") - 1
    found[:, 0] -= begin[text]
    ends = np.searchsorted(text, np.arange(len(order) + 1))
    for k, i in enumerate(order):
        out[i] = found[ends[k]:ends[k + 1]]
    return out


def kept_words(size: int, runs):
    """Mask of the words outside of every run's repetitions."""
    import numpy as np
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _worker(digest: bool):
    """Adds runs and the collapsed text (or its SHA-256) to the rows of a task; the
    text is the first column, which is left out."""
    def run(batches):
        import hashlib
        from itertools import compress

        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))

        def worked(batch, texts):
            number: dict = {}
            words = [(t or b"").split() for t in texts]
            runs = runs_of([np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in words])
            plain = [b" ".join(compress(ws, kept_words(len(ws), r).tolist()) if len(r) else ws) for ws, r in zip(words, runs)]
            flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                [pa.array(flat[:, k]) for k in range(3)], RUN.names)).cast(kind)
            last = pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string()) if digest \
                else pa.array(plain, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns[1:], lists, last],
                                              [*batch.schema.names[1:], "runs", "collapsed_sha256" if digest else "collapsed"])

        for batch, texts in text_slices(batches, 0, GROUP):
            yield worked(batch, texts)
    return run


def with_runs(docs: DataFrame, text_col: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` without its text, plus runs (array of start, length, period, by
    start, then period) and collapsed: the words outside of all repetitions,
    joined by one space (``digest``: collapsed_sha256 instead)."""
    name = "collapsed_sha256" if digest else "collapsed"
    rest = replacing(docs, [text_col, "runs", name])
    own = "_text"  # a name that no other column has
    while own in {c.lower() for c in rest.columns}:
        own = f"_{own}"
    d = docs.select(F.col(quoted(text_col)).cast("binary").alias(own), *[F.col(quoted(c)) for c in rest.columns])
    schema = T.StructType([*rest.schema.fields, T.StructField("runs", T.ArrayType(RUN)), T.StructField(name, T.StringType())])
    return d.mapInArrow(_worker(digest), schema)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every run of its texts cut down to one period."""
    out = with_runs(docs, text_col)
    return out.select(*[F.col("collapsed").alias(c) if c.lower() == text_col.lower() else F.col(quoted(c)) for c in docs.columns])


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the checksum of its id, repeats its
    words periodically from some word on."""
    h = crc_text("doc_id")
    g, n = F.floor(h / 10), F.size("_w").cast("bigint")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, words_of(F.col("text"))).alias("_w"))
    d = d.select("doc_id", "text", "_w", F.when(n > 0, a).alias("_a"), F.when(n > 0, p).alias("_p"))
    planted = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get(F.col("_w"), (F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int"))))
    return d.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, text): n_runs, the longest run (ties: the
    first, then the smallest period), and digests of the runs and of the
    collapsed text."""
    d = with_runs(docs.select("doc_id", "text"), digest=True)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("_before"), (-r["period"]).alias("_less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in RUN.names]), F.lit("\n"))), "")
    d = d.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("_l"), lines.alias("_lines"), "collapsed_sha256")
    period = -F.col("_l._less")
    return d.select("doc_id", "n_runs", (-F.col("_l._before")).alias("start"), F.col("_l.length").alias("length"), period.alias("period"),
                    F.expr("1000 * _l.length div -_l._less").cast("bigint").alias("exponent_milli"),
                    F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")
