"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers first (``floor(scale * c)``), so copies are recognised
exactly and sums are exact.  The fit list X holds each distinct vector once; its
rows a are centred (x - S / n) before anything is multiplied.

Golub-Kahan-Lanczos builds orthonormal v_1, v_2, ... (as long as a vector is wide)
and u_1, u_2, ... (as long as the list) with X v_j = beta_(j-1) u_(j-1) + alpha_j u_j
and X' u_j = alpha_j v_j + beta_j v_(j+1).  One pass over the list makes one step of
both products: every row gives a.v_j, takes off its share of the earlier u, and adds
its part of X'u.  The u are never stored: u_j = X p_j for short p_j, so a row's entry
of all of them is one small product.  Both sides are fully reorthogonalised: the v
on the driver, the u by the inner products with all earlier u that the same pass
adds up.

The small bidiagonal matrix is decomposed on the driver: its singular values are
those of X, and its right vectors, carried over by the v, are the components.  Steps
go on until the leading components' residuals are at rounding level.  Then the rest
of the space is probed from a fresh start, orthogonal to all v so far, until its own
largest value has settled too, so equal eigenvalues are not missed; at the latest
all v together span the space and the result is complete.

What reaches the driver are ``FAN_IN`` rows of sums a pass at most, each as wide as
two vectors.  The list is packed into blocks of rows and checkpointed
once; passes read it from memory or from there.

Edge cases: rows whose vector is null, has a null or non-finite entry, or one whose
integer would not fit a long are dropped; of vectors of several lengths those of the
most frequent length stay (ties: the longer); equal vectors get equal results, as
often as they occur; a null id is kept; directions without variance are no
components, so a list of fewer than two vectors, or an empty table, gives an empty
result; a deviation beyond a long is null; further columns are ignored.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, quoted

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 1 << 22  # of packed rows
TASK_BYTES = 1 << 25  # of packed rows that a task of a pass reads
FAN_IN = 256  # tasks whose sums one task adds up
RESIDUAL = 1e-14  # of the largest singular value
SEED = 7


class Whitener(NamedTuple):
    """Rows, exact sums, components (one a row, by falling eigenvalue), eigenvalues
    and the share of the variance of each."""
    n: int
    sums: list
    components: object
    values: object
    explained: object

    @property
    def mean(self):
        import numpy as np
        return np.array([s / self.n for s in self.sums])  # quotients of whole numbers, rounded once


def integers(vec: Column, scale: int = SCALE) -> Column:
    """The vector in whole numbers, or null if it can't be had."""
    fits = F.forall(vec, lambda c: c.isNotNull() & (F.abs(c.cast("double")) * scale < 2.0 ** 63))
    return F.when(vec.isNotNull() & fits, F.transform(vec, lambda c: F.floor(c.cast("double") * scale).cast("bigint")))


def usable(df: DataFrame, vec_col: str, id_col: str | None = None, scale: int = SCALE) -> DataFrame:
    """([id,] x) of the rows that take part."""
    d = df.select(*([F.col(quoted(id_col)).alias("vec_id")] if id_col else []), integers(F.col(quoted(vec_col)), scale).alias("x"))
    d = d.filter("x IS NOT NULL AND size(x) > 0")
    width = d.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).select("w").scalar()
    return d.filter(F.size("x") == width)


def _matrices(batches):
    """Integer matrices of the lists of longs in a column x."""
    for batch in batches:
        if batch.num_rows:
            lists = batch.column(batch.schema.names.index("x"))
            yield batch, lists.flatten().to_numpy().reshape(batch.num_rows, -1)


def _packed(batches):
    import pyarrow as pa
    for _, x in _matrices(batches):
        step = max(1, BLOCK_BYTES // (8 * x.shape[1]))
        for at in range(0, len(x), step):
            part = x[at:at + step]
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["rows", "data"])


class _List:
    """The fit list as packed blocks, and passes over it."""

    def __init__(self, fit: DataFrame):
        self.context = fit.sparkSession.sparkContext
        blocks = cut(fit.mapInArrow(_packed, "rows long, data binary"))
        one = blocks.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()
        self.n = one[0]
        # small lists come in more partitions than a pass is worth
        self.tasks = max(1, min(blocks.rdd.getNumPartitions(), max(self.context.defaultParallelism, -(-one[1] // TASK_BYTES))))
        self.blocks = blocks.coalesce(self.tasks).persist(StorageLevel.MEMORY_AND_DISK)

    def close(self):
        self.blocks.unpersist()

    def sums(self) -> list:
        """Exact sum of every dimension."""
        def run(batches):
            import numpy as np
            import pyarrow as pa
            from decimal import Decimal
            total: list = []
            for batch in batches:
                for rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x = np.frombuffer(data, np.int64).reshape(rows, -1)
                    # two halves, neither of which can overflow
                    part = [(int(h) << 32) + int(m) for h, m in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
                    total = [a + b for a, b in zip(total, part)] if total else part
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(
                    [Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "s"])
        got = self.blocks.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
        return [int(s) for _, s in sorted((r.i, r.s) for r in got)]

    def added(self, work, *shared):
        """Sum over all rows of ``work(centred rows, *shared)``, a flat array, added up
        in a tree of tasks."""
        sent = self.context.broadcast((self.mean, *shared))

        def run(batches):
            import numpy as np
            import pyarrow as pa
            mean, *rest = sent.value
            total = None
            for batch in batches:
                for rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    a = np.frombuffer(data, np.int64).reshape(rows, -1).astype(np.float64) - mean
                    part = work(a, *rest)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        def summed(batches):
            import pyarrow as pa
            total = _total(x for batch in batches for x in batch.column(0).to_pylist())
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        parts, left = self.blocks.mapInArrow(run, "sums binary"), self.tasks
        while left > FAN_IN:
            left = -(-left // FAN_IN)
            parts = parts.repartition(left).mapInArrow(summed, "sums binary")
        out = _total(r.sums for r in parts.collect())
        sent.destroy()
        return out


def _total(parts):
    """Sum of packed arrays of doubles."""
    import numpy as np
    total = None
    for part in parts:
        x = np.frombuffer(part)
        total = x.copy() if total is None else total + x
    return total


def _step(a, short, last):
    """Parts of U'(X q), X'(X q) and |X q|^2: u = X ``short``, q = ``last``."""
    import numpy as np
    t = a @ last
    return np.concatenate(((a @ short).T @ t, a.T @ t, [t @ t]))


def bidiagonalise(rows: _List, width: int, wanted: int, residual: float = RESIDUAL, seed: int = SEED):
    """(components, singular values) of the centred list, ``wanted`` at most."""
    import numpy as np
    rng = np.random.default_rng(seed)
    vs = np.zeros((width, 0))  # v_1 ... v_j as columns
    short = np.zeros((width, 0))  # p_1 ... p_j
    back = np.zeros((width, 0))  # X'u_1 ... X'u_j
    b = np.zeros((0, 0))

    def fresh():
        v = rng.standard_normal(width)
        for _ in range(2):
            v -= vs @ (vs.T @ v)
        return v / np.linalg.norm(v)

    v, beta, start, settled = fresh(), 0.0, 0, None
    while True:
        j = vs.shape[1]
        q = v - beta * short[:, -1] if beta else v
        got = rows.added(_step, short, q)
        c, g, norm = got[:j], got[j:j + width], got[-1]
        # what is left of the earlier u comes off; the u are orthonormal
        alpha = float(np.sqrt(max(norm - c @ c, 0.0)))
        grown = np.zeros((j + 1, j + 1))
        grown[:j, :j] = b
        grown[j, j] = alpha
        if beta:
            grown[j - 1, j] = beta
        b, vs = grown, np.column_stack((vs, v))
        left, values, right = np.linalg.svd(b)
        top = values[0]
        if alpha <= 1e-13 * max(top, np.sqrt(norm)) or alpha == 0.0:
            # nothing left in this direction: v lies in the space without variance, or
            # the last u was the whole rest
            short, back = np.column_stack((short, np.zeros(width))), np.column_stack((back, np.zeros(width)))
            w = np.zeros(width)
        else:
            short = np.column_stack((short, (q - short @ c) / alpha))
            back = np.column_stack((back, (g - back @ c) / alpha))
            w = back[:, -1] - alpha * v
            for _ in range(2):
                w -= vs @ (vs.T @ w)
        if vs.shape[1] == width:
            break
        beta = float(np.linalg.norm(w))
        if top == 0.0 or alpha <= 1e-13 * top and j == start:
            break  # a fresh direction without variance: none is left
        lead = min(wanted, j + 1)
        used_up = beta <= residual * top
        done = j + 1 >= wanted and bool(np.all(beta * np.abs(left[-1, :lead]) <= residual * top))
        if done and settled is not None:
            # the probe's largest value, once it has settled, is the largest of what was left
            ends, probe, _ = np.linalg.svd(b[start:, start:])
            if probe[0] <= settled[-1] * (1 + 1e-9) and (used_up or beta * abs(ends[-1, 0]) <= 1e-9 * top):
                break
        if used_up or done and (settled is None or not np.allclose(values[:lead], settled, rtol=1e-12, atol=0)):
            # probe what is orthogonal to all v so far
            settled = values[:lead].copy() if done else settled
            v, beta, start = fresh(), 0.0, j + 1
        else:
            v = w / beta
    left, values, right = np.linalg.svd(b)
    keep = [k for k in range(min(wanted, len(values))) if values[k] > 1e-12 * values[0]]
    comp = right[keep] @ vs.T
    return comp / np.linalg.norm(comp, axis=1, keepdims=True), values[keep]


def _spread(a):
    import numpy as np
    return np.array([np.einsum("ij,ij->", a, a)])


def fit(df: DataFrame, vec_col: str, components: int = COMPONENTS, scale: int = SCALE) -> tuple[Whitener, float]:
    """The whitener of a table's distinct vectors, and the largest difference of the
    whitened covariance from the identity."""
    import numpy as np
    rows = _List(usable(df, vec_col, scale=scale).select("x").distinct())
    try:
        n, sums = rows.n, rows.sums()
        none = Whitener(n, sums, np.zeros((0, len(sums))), np.zeros(0), np.zeros(0))
        if n < 2:
            return none, 0.0
        rows.mean = none.mean
        total = float(rows.added(_spread)[0])
        if total == 0.0:
            return none, 0.0
        comp, sigma = bidiagonalise(rows, len(sums), components)
        made = Whitener(n, sums, comp, sigma ** 2 / n, sigma ** 2 / total)
        k = len(sigma)
        got = rows.added(_moments, comp.T / np.sqrt(made.values))
        mean, square = got[:k] / n, got[k:].reshape(k, k) / n
        return made, float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())
    finally:
        rows.close()


def _moments(a, axes):
    import numpy as np
    w = a @ axes
    return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))


def _deviations(x, n: int, sums):
    """Exact sum over the dimensions of (n x - S)^2; None where a long can't hold it."""
    import numpy as np
    largest = n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums)
    if largest ** 2 * len(sums) < 1 << 63:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1)
    y = n * x.astype(object) - np.array(sums, object)
    return [d if d < 1 << 63 else None for d in (y * y).sum(axis=1)]


def _whitened(model):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        m, error = model.value
        axes, k = m.components.T / np.sqrt(m.values), len(m.values)
        for batch, x in _matrices(batches):
            w = (x.astype(np.float64) - m.mean) @ axes
            rows = len(x)
            again = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array(np.full(rows * k, m.n), pa.int64()), pa.array(_deviations(x, m.n, m.sums), pa.int64()).take(again),
                 pa.array(w.ravel()), pa.array(np.tile(m.explained, rows)), pa.array(np.full(rows * k, error))], OUT)
    return run


OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    made, error = fit(df, vec_col, components, scale)
    d = usable(df, vec_col, id_col, scale)
    schema = T.StructType([d.schema["vec_id"]] + [T.StructField(c, t) for c, t in zip(OUT[1:], (
        T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()))])
    return d.mapInArrow(_whitened(df.sparkSession.sparkContext.broadcast((made, error))), schema)
