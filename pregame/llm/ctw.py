"""Language-model scores by context-tree weighting over bytes.

Text is a sequence of bytes (A-Z in lower case), closed by an end byte 0xFF,
which UTF-8 never holds; before the text stand ``DEPTH`` such bytes.  Each byte
is eight binary decisions.  A context is up to ``DEPTH`` preceding bytes plus
the bits of the byte decided so far; its Krichevsky-Trofimov estimate follows
from how often either bit came there in the training texts.  Context-tree
weighting mixes the estimates of all depths: a node's weighted probability is
the mean of its own block probability and the product of its children's, so
the share of its own estimate in a prediction is the posterior of stopping
there.  The code length of a text is the sum over its bytes.

Training.  Each task counts its (``DEPTH`` + 1)-byte grams and words; counts
are summed by key, and the tree is built from the gram counts level by level
from the deepest, one pre-aggregated ``groupBy`` a level.  All training texts
count in whole.  Grams of held-out texts are in the tree with a count of zero,
which changes no other node.

Serving.  A path ends at the deepest node that training has seen, which answers
with its own estimate.  From the root down, each level is joined with the one
above, so that every node knows the mixture of its path, and every gram its
probability under the whole tree.  The most frequent grams, ``NODES`` of them at
most, are broadcast; each document hands on its other grams to a join with the
exact values, as it does its rare words.  ``NODES`` is a matter of speed alone.

Baseline.  Word counts are exact for every word.  Words with at least one in
``WORDS`` of all training words (at most ``WORDS`` of them) are broadcast; each
document hands on its other words, by 64-bit hash, to a join with the exact
counts, where no key can be hot since no key has a larger share.

Edge cases: a null text is empty: one word (the end) and the end byte; without
any training text every bit has probability one half and the base score is
that of N = V = 0; repeated rows are scored alike; a null doc_id counts as the
empty text in the split; columns beyond id and text are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import remove, scratch_path
from .common import byte_lists, crc_text, cut

DEPTH = 5
NODES = 1 << 22
WORDS = 1 << 20
CHUNK = 4 << 20  # bytes of text worked on at a time
KEPT_GRAMS = 1 << 21
STEPS = 8  # steps of gram frequency to a doubling
KEPT_WORDS = 1 << 19
GRAM, WORD = 0, 1
END = 0xFF


def _grams(texts: list[bytes], depth: int):
    """Packed grams of texts and how many each text has: one for every byte and
    one for its end."""
    import numpy as np
    raw = bytes([END]) * depth + b"".join(t + bytes([END]) * depth for t in texts)
    a = np.frombuffer(raw, np.uint8).astype(np.int64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    # places of the texts' bytes and ends, leaving out the further end bytes
    place = np.ones(len(a) - depth, bool)
    if depth > 1:
        ends = np.cumsum(sizes + depth - 1) - depth
        place[(ends[:, None] + 1 + np.arange(depth - 1)[None, :]).ravel()] = False
    g = a[:len(a) - depth].copy()
    for i in range(1, depth + 1):
        g <<= 8
        g |= a[i:len(a) - depth + i]
    return g[place], sizes


def _chunks(texts: list[bytes], size: int = CHUNK):
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _count(depth: int):
    """(text, held out) -> (kind, key, n, m): counts of grams and words in the
    training texts (n), and of grams in all texts (m)."""
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        import xxhash

        def out(kind, keys, n, m):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys, pa.int64()),
                                               pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["kind", "key", "n", "m"])

        def summed(parts):
            keys, n, m = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys)
            keys, n, m = keys[order], n[order], m[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(n, first), np.add.reduceat(m, first)

        def hashed(words):
            n = np.fromiter(words.values(), np.int64, len(words))
            return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64), n, n

        parts, held = [], 0
        words: Counter = Counter()
        for batch in batches:
            texts = [(t or b"").lower() for t in byte_lists(batch.column(0))]
            asked = batch.column(1).to_pylist()
            for at, part in _chunks(texts):
                for unseen in (False, True):
                    own = [t for t, h in zip(part, asked[at:]) if h == unseen]
                    if not own:
                        continue
                    keys, n = np.unique(_grams(own, depth)[0], return_counts=True)
                    parts.append((keys, np.zeros_like(n) if unseen else n, n))
                    held += len(keys)
                    if not unseen:
                        for t in own:
                            words.update(t.split())
                        words[b" "] += len(own)  # the end of a text; no word is a space
                if held > KEPT_GRAMS:
                    parts = [summed(parts)]
                    held = len(parts[0][0])
                    if held > KEPT_GRAMS // 2:
                        yield out(GRAM, *parts[0])
                        parts, held = [], 0
                if len(words) > KEPT_WORDS:
                    yield out(WORD, *hashed(words))
                    words = Counter()
        if parts:
            yield out(GRAM, *summed(parts))
        yield out(WORD, *hashed(words))
    return run


def _ln_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 0.5: Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    steps = x
    for i in range(1, 8):
        steps = steps * (x + i)
    return series - F.ln(steps)


def ln_block(n0: Column, n1: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    n0, n1 = n0.cast("double"), n1.cast("double")
    return _ln_gamma(n0 + 0.5) + _ln_gamma(n1 + 0.5) - _ln_gamma(n0 + n1 + 1) - 1.1447298858494002  # ln(pi)


def _decided(grams: DataFrame) -> DataFrame:
    """Grams -> (key, n, ctx, bits, bit): the eight decisions of their last byte."""
    return grams.select("key", "n", F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("b"),
                        F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j")).select(
        "key", "n", "ctx", F.expr("shiftleft(1, j) | shiftright(b, 8 - j)").alias("bits"), F.expr("shiftright(b, 7 - j) & 1").alias("bit"))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in the shared folder, a fraction of a checkpoint's size."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def tree(grams: DataFrame, folder: str, depth: int = DEPTH) -> list[DataFrame]:
    """Gram counts (key, n) -> nodes of every depth, from the deepest: (ctx,
    bits, n0, n1, own): ``own`` is the share of the node's own estimate.  They
    are kept in ``folder``."""
    seen = F.col("n0") + F.col("n1") > 0  # else its probability is one, like that of nothing
    level = (_decided(grams).groupBy("ctx", "bits").agg(F.sum(F.expr("n * (1 - bit)")).alias("n0"), F.sum(F.expr("n * bit")).alias("n1"))
             .withColumns({"lw": F.when(seen, ln_block(F.col("n0"), F.col("n1"))).otherwise(0.0), "own": F.lit(1.0)}))
    out = [_stored(level, f"{folder}/{depth}")]
    for d in range(depth - 1, -1, -1):
        up = out[-1].groupBy(F.col("ctx").bitwiseAND(F.lit((1 << (8 * d)) - 1)).alias("ctx"), "bits").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lw").alias("below"))
        up = up.withColumn("le", ln_block(F.col("n0"), F.col("n1")))
        most = F.greatest("le", "below")
        mixed = most + F.ln(F.exp(F.col("le") - most) + F.exp(F.col("below") - most)) - 0.6931471805599453
        up = up.withColumns({"lw": F.when(seen, mixed).otherwise(0.0),
                             "own": 1 / (1 + F.exp(F.least(F.col("below") - F.col("le"), F.lit(700.0))))})
        out.append(_stored(up.select("ctx", "bits", "n0", "n1", "lw", "own"), f"{folder}/{d}"))
    return out


def log10_of_grams(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Gram counts (key, n, m) -> key, m, v: log10 probability of each gram's
    last byte after the bytes before, under the whole tree."""
    folder = scratch_path(grams.sparkSession, "ctw")
    levels = tree(grams, folder, depth)
    above = None
    for d, level in enumerate(reversed(levels)):
        # of the path's probability of a one: what the nodes above give (had), and the share they leave (left)
        if above is None:
            level = level.withColumns({"end": F.lit(0.5), "had": F.lit(0.0), "left": F.lit(1.0)})
        else:
            above = above.withColumnRenamed("ctx", "shorter")
            level = level.withColumn("shorter", F.col("ctx").bitwiseAND(F.lit((1 << (8 * (d - 1))) - 1))).join(
                F.broadcast(above) if d <= 2 else above, ["shorter", "bits"])  # two levels have 65,536 nodes a bit at most
        n, one = F.col("n0") + F.col("n1"), (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
        ends = F.when(n > 0, F.col("had") + F.col("left") * one).otherwise(F.col("end"))
        level = level.select("ctx", "bits", ends.alias("end"),
                             F.when(n > 0, F.col("had") + F.col("left") * F.col("own") * one).otherwise(F.col("end")).alias("had"),
                             F.when(n > 0, F.col("left") * (1 - F.col("own"))).otherwise(0.0).alias("left"))
        above = level if d == depth else _stored(level, f"{folder}/ends-{d}")
    p = F.when(F.col("bit") == 1, F.col("end")).otherwise(1 - F.col("end"))
    each = _decided(grams).join(above.select("ctx", "bits", "end"), ["ctx", "bits"]).groupBy("key").agg(F.sum(F.log10(p)).alias("v"))
    out = cut(grams.select("key", "m").join(each, "key"))
    remove(grams.sparkSession, folder)
    return out


class _Numbers(dict):
    """word -> its number, given out in order of first sight."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


def _score(gram_model, word_model, depth: int):
    """(text, ...) -> the other columns, _row, n_bytes, n_tokens, known, partial
    base score and score, and the grams and words to be looked up (kinds, keys
    and counts)."""
    def run(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext
        (held, values), (hashes, logs) = gram_model.value, word_model.value
        row = TaskContext.get().partitionId() << 33
        place = _Numbers()
        word_hash, word_log = np.zeros(0, np.int64), np.zeros(0)

        for batch in batches:
            texts = [(t or b"").lower() for t in byte_lists(batch.column(0))]
            n_tokens, known, base, score, kinds, rare, times = [], [], [], [], [], [], []
            for _, part in _chunks(texts):
                grams, sizes = _grams(part, depth)
                inverse, u = pd.factorize(grams)
                found = np.full(len(u), np.nan)
                if len(held):
                    at = np.minimum(np.searchsorted(held, u), len(held) - 1)
                    found = np.where(held[at] == u, values[at], np.nan)
                away = np.isnan(found)
                score += np.add.reduceat(np.where(away, 0.0, found)[inverse], np.concatenate(([0], np.cumsum(sizes)[:-1]))).tolist()
                spot = np.flatnonzero(away[inverse])
                pair, n_pair = np.unique(np.repeat(np.arange(len(part)), sizes)[spot] * len(u) + inverse[spot], return_counts=True)
                to = np.searchsorted(pair, np.arange(len(part) + 1) * len(u))
                pair = u[pair % len(u)]

                if len(place) > KEPT_WORDS:
                    place, word_hash, word_log = _Numbers(), np.zeros(0, np.int64), np.zeros(0)
                split = [np.array([*map(place.__getitem__, t.split()), place[b" "]], np.int64) for t in part]
                fresh, place.fresh = place.fresh, []
                if fresh:
                    h = np.fromiter(map(xxhash.xxh64_intdigest, fresh), np.uint64, len(fresh)).view(np.int64)
                    v = np.full(len(h), np.nan)
                    if len(hashes):
                        i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                        v = np.where(hashes[i] == h, logs[i], np.nan)
                    word_hash, word_log = np.concatenate((word_hash, h)), np.concatenate((word_log, v))
                for i, at in enumerate(split):
                    v = word_log[at]
                    rest = np.isnan(v)
                    r, n = np.unique(at[rest], return_counts=True)
                    n_tokens.append(len(at))
                    known.append(len(at) - int(rest.sum()))
                    base.append(float(v[~rest].sum()))
                    g = slice(to[i], to[i + 1])
                    kinds.append(np.repeat((GRAM, WORD), (to[i + 1] - to[i], len(r))))
                    rare.append(np.concatenate((pair[g], word_hash[r])))
                    times.append(np.concatenate((n_pair[g], n)))
            size = batch.num_rows
            lists = lambda a, t: pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([len(x) for x in a]))), pa.int32()),
                pa.array(np.concatenate(a) if a else [], t))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.arange(row, row + size), pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                 lists(kinds, pa.int32()), lists(rare, pa.int64()), lists(times, pa.int64())],
                [*batch.schema.names[1:], "_row", "n_bytes", "n_tokens", "_known", "_base", "score", "_kinds", "_rare", "_times"])
            row += size
    return run


def held_out(id_col: str = "doc_id") -> Column:
    return crc_text(id_col) % 10 == 0


def score_documents(docs: DataFrame, depth: int = DEPTH, nodes: int = NODES, words: int = WORDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_bytes, bits_per_byte."""
    import numpy as np
    sc = docs.sparkSession.sparkContext
    text = F.col("text").cast("binary").alias("_text")
    counts = cut(docs.select(text, held_out().alias("_held")).mapInArrow(_count(depth), "kind int, key long, n long, m long")
                 # each task has summed up its own, so they are dealt out as they are
                 .repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    sums = {r.kind: (r.n, r.v) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    train_tokens, vocabulary = sums.get(WORD, (0, 0))
    whole = train_tokens + 0.1 * (vocabulary + 1)
    valued = log10_of_grams(counts.filter(F.col("kind") == GRAM).select("key", "n", "m"), depth)
    step = F.floor(F.log2("m") * STEPS)
    least, room = 64 * STEPS, nodes
    for r in sorted(valued.groupBy(step.alias("step")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r.step
    big = valued.filter(step >= least).select("key", "v").toArrow()  # at most ``nodes`` rows
    key, v = big.column("key").to_numpy(), big.column("v").to_numpy()
    order = np.argsort(key)
    grams = (key[order], v[order])
    vocab = counts.filter(F.col("kind") == WORD)
    often = vocab.filter(F.col("n") >= train_tokens / words).select("key", "n").toArrow()  # at most ``words`` rows
    key, n = often.column("key").to_numpy(), often.column("n").to_numpy()
    order = np.argsort(key)
    frequent = (key[order], np.log10((n[order] + 0.1) / whole))
    scored = cut(docs.select(text, "doc_id").mapInArrow(
        _score(sc.broadcast(grams), sc.broadcast(frequent), depth),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _row long, n_bytes long, n_tokens long, _known long, "
        "_base double, score double, _kinds array<int>, _rare array<long>, _times array<long>"))
    asked = scored.select("_row", F.explode(F.arrays_zip("_kinds", "_rare", "_times")).alias("x")).select(
        "_row", F.col("x._kinds").alias("kind"), F.col("x._rare").alias("key"), F.col("x._times").alias("times"))
    exact = vocab.select("kind", "key", F.log10((F.col("n") + 0.1) / F.lit(float(whole))).alias("v")).union(
        valued.filter(step < least).select(F.lit(GRAM), "key", "v"))
    word = F.col("kind") == WORD
    counted = asked.join(exact, ["kind", "key"], "left").groupBy("_row").agg(
        F.sum(F.when(word & F.col("v").isNotNull(), F.col("times"))).alias("_more_known"),
        F.sum(F.when(word, F.col("times") * F.coalesce("v", F.log10(0.1 / F.lit(float(whole)))))).alias("_more_base"),
        F.sum(F.when(~word, F.col("times") * F.col("v"))).alias("_more_score"))
    out = scored.drop("_kinds", "_rare", "_times").join(counted, "_row", "left").withColumn(
        "score", F.col("score") + F.coalesce("_more_score", F.lit(0.0)))
    return out.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("_base") + F.coalesce("_more_base", F.lit(0.0))).alias("base_score"),
        "score", "n_bytes", (-F.col("score") * 3.321928094887362 / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
