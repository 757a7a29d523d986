"""Global order without a single-partition window.

Row positions and running sums over a whole table are
built in two levels: a range-partitioned sort (Spark samples the key, so a hot
key value is split across partitions whenever the order is total), then the
per-partition totals -- one row per partition, a size bound we control -- are
turned into offsets and broadcast back.  The sorted table is checkpointed to
the reliable checkpoint folder so positions stay stable if an executor is lost
and a stage is recomputed.  Exact order statistics need no order of the rows: they
are found by counting (``order_statistics``).
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | record number
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage by a reliable checkpoint in
    the shared folder.  With ``spark.cleaner.referenceTracking.cleanCheckpoints``
    Spark deletes the files once nothing refers to them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sorted_positions(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Range-partition + sort; adds _pid and _local (position in partition)."""
    # the range partitioner samples its input in a job of its own; keep the
    # input for the two passes (sample, sort) so upstream runs once, and drop
    # it as soon as the checkpoint has cut the lineage
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    # no explicit number of partitions: adaptive execution merges small ones
    s = src.repartitionByRange(*order).sortWithinPartitions(*order)
    s = kept(s.withColumn("_mid", F.monotonically_increasing_id()))
    src.unpersist()
    return (s.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
             .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
             .drop("_mid"))


def _offsets(s: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Exclusive running totals over the partition table (one row per
    partition, so this tiny window and the broadcast below are size-safe)."""
    totals = s.groupBy("_pid").agg(*[m.alias(f"_t_{k}") for k, m in measures.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_pid", *[F.coalesce(F.sum(f"_t_{k}").over(w), F.lit(0)).alias(f"_o_{k}")
                                   for k in measures])


def row_index(df: DataFrame, order: list[str | Column], name: str = "row_idx") -> DataFrame:
    """0-based position of every row in the total order ``order``."""
    s = sorted_positions(df, order)
    off = _offsets(s, {"n": F.count(F.lit(1))})
    return (s.join(F.broadcast(off), "_pid")
             .withColumn(name, (F.col("_o_n") + F.col("_local")).cast("bigint"))
             .drop("_pid", "_local", "_o_n"))


def row_index_by_date(df: DataFrame, order: list[str], name: str = "row_idx") -> DataFrame:
    """0-based position of every row in a total order that starts with a date: counts
    per date, their prefix sums over the small table of dates, and the row number
    inside the date.  No sample, no range sort, no checkpoint; a date's rows are one
    task's."""
    date = order[0]
    first = F.coalesce(F.col(date), F.lit("0001-01-01").cast("date"))  # no date comes first
    d = df.withColumn("_day", first)
    days = d.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    starts = days.select("_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_day").orderBy(*order)) - 1
    out = d.withColumn("_inside", inside).join(starts, "_day")
    return out.select(*df.columns, (F.col("_start") + F.col("_inside")).cast("bigint").alias(name))


def running_sums(df: DataFrame, order: list[str | Column], cols: list[str],
                 inclusive: bool = True, index: str | None = None) -> DataFrame:
    """``cum_<c>`` = sum of ``c`` over all rows up to (or before) each row in
    the total order; optional 0-based position ``index``."""
    s = sorted_positions(df, order)
    measures = {c: F.sum(c) for c in cols}
    if index:
        measures["_n"] = F.count(F.lit(1))
    off = _offsets(s, measures)
    wl = Window.partitionBy("_pid").orderBy("_local").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = s.join(F.broadcast(off), "_pid")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wl), F.lit(0)))
    if index:
        out = out.withColumn(index, (F.col("_o__n") + F.col("_local")).cast("bigint"))
    return out.drop("_pid", "_local", *[f"_o_{k}" for k in measures])


BUCKETS = 4096
_LARGEST = 1.7976931348623157e308


def _bucket(x, lo: float, hi: float):
    """Number of the bucket of each of ``x`` among BUCKETS equal ones from lo to hi: never
    falls as x grows, since no step of the arithmetic does."""
    import numpy as np
    a, b = (max(-_LARGEST, min(_LARGEST, v)) / 2 for v in (lo, hi))
    if a == b:  # infinite beside the largest number
        return np.where(x == lo, 0, BUCKETS - 1)
    half = np.clip(x, -_LARGEST, _LARGEST) / 2
    return np.minimum(np.floor((half - a) / (b - a) * BUCKETS), BUCKETS - 1).astype(np.int64)


def _counts(src: DataFrame, targets: list[tuple]) -> DataFrame:
    """(t, b, n, lo, hi) of every target (column, lowest value, highest value, buckets):
    rows, least and largest of the values in each of its buckets, or of each value.  Whole
    batches are counted at once, each task's buckets before the shuffle."""
    bucket = _bucket

    def count(batches):
        import numpy as np
        import pyarrow as pa
        n = {t: np.zeros(BUCKETS, np.int64) for t, x in enumerate(targets) if x[3]}
        least, largest = ({t: np.full(BUCKETS, end) for t in n} for end in (np.inf, -np.inf))
        whole = {t: [] for t, x in enumerate(targets) if not x[3]}
        for batch in batches:
            for t, (column, lo, hi, _) in enumerate(targets):
                x = batch.column(column).to_numpy(zero_copy_only=False).astype(float)
                x = x[(x >= lo) & (x <= hi)] + 0.0  # nulls are NaN here; one zero
                if t in whole:
                    whole[t].append(x)
                elif len(x):
                    x.sort()
                    b = bucket(x, lo, hi)
                    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
                    last = np.r_[first[1:], len(b)]
                    at = b[first]
                    n[t][at] += last - first
                    least[t][at], largest[t][at] = np.minimum(least[t][at], x[first]), np.maximum(largest[t][at], x[last - 1])
        for t in range(len(targets)):
            if t in whole:
                b, k = np.unique(np.concatenate([*whole[t], np.zeros(0)]), return_counts=True)
                lo = hi = b
            else:
                b = np.flatnonzero(n[t])
                k, lo, hi = n[t][b], least[t][b], largest[t][b]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), t, np.int32)), *(pa.array(np.asarray(v, kind)) for v, kind in (
                (b, float), (k, np.int64), (lo, float), (hi, float)))], names=["t", "b", "n", "lo", "hi"])
    return src.mapInArrow(count, "t int, b double, n bigint, lo double, hi double").groupBy("t", "b").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def order_statistics(df: DataFrame, columns: list[str], ranks) -> dict[str, tuple[int, dict[int, float]]]:
    """(number of values, {rank: value}) of every column that has any: exact values at 0-based ranks of many columns (nulls and NaN left out).
    ``ranks(count)`` names the ranks wanted of a column with that many values.

    No sort: a pass counts the values of every column by equal buckets between the
    column's ends, pre-aggregated before the shuffle, so a value that most rows share
    is one row.  Only buckets that hold a wanted rank are looked into by the next
    pass, between their own ends, until such a bucket holds a single value.  A pass
    narrows 4,096-fold; once a bucket has no more rows than that, the next pass counts
    its values themselves, however close they are.  What reaches the driver are one row a column, then one a
    rank and pass."""
    names = [f"v{i}" for i in range(len(columns))]
    src = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(v)
                      for c, v in zip(columns, names)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ends = src.agg(*[f(v).alias(f"{n}{v}") for v in names for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
        found: dict = {c: (ends[f"n{v}"], {}) for c, v in zip(columns, names) if ends[f"n{v}"]}
        # (column, lowest value, highest value, values below, ranks, rows)
        open_ = [(c, v, ends[f"lo{v}"], ends[f"hi{v}"], 0, sorted(set(ranks(ends[f"n{v}"]))), ends[f"n{v}"]) for c, v in zip(columns, names) if ends[f"n{v}"]]
        while True:
            for c, _, lo, hi, _, wanted, _ in open_:
                if lo == hi:
                    found[c][1].update(dict.fromkeys(wanted, lo))
            open_ = [t for t in open_ if t[2] != t[3]]
            if not open_:
                return found
            counts = _counts(src, [(v, lo, hi, n > BUCKETS) for _, v, lo, hi, _, _, n in open_])
            # at most BUCKETS rows a target
            upto = Window.partitionBy("t").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            wanted = F.array(*[F.array(*[F.lit(r - below).cast("bigint") for r in rs]) for _, _, _, _, below, rs, _ in open_])
            hit = counts.withColumn("upto", F.sum("n").over(upto)).filter(
                F.exists(F.get(wanted, F.col("t")), lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto"))))
            following = []
            for row in hit.collect():
                c, v, _, _, below, rs, _ = open_[row.t]
                first = below + row.upto - row.n
                following.append((c, v, row.lo, row.hi, first, [r for r in rs if first <= r < first + row.n], row.n))
            open_ = following
    finally:
        src.unpersist()


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy / pandas / DuckDB
    ``quantile_cont`` semantics) of many columns -> (column, p, value); a column
    without a value has no row."""
    from math import ceil, floor
    at = lambda n: [(p, p * (n - 1)) for p in probs]
    found = order_statistics(df, columns, lambda n: [r for _, h in at(n) for r in (floor(h), ceil(h))])
    rows = [(c, float(p), value[floor(h)] + (h - floor(h)) * (value[ceil(h)] - value[floor(h)]) if ceil(h) > floor(h) else value[floor(h)])
            for c, (n, value) in found.items() for p, h in at(n)]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
