"""Skew-proof ordered windows: cut every key's series into bounded stretches.

A plain ``Window.partitionBy(team)`` puts a team's whole history in one task;
if one team (or pair) held a third of all rows, that task would hold a third
of the data.  Here a series is first cut by calendar month, which spreads a hot
key over as many tasks as its history has months.  Places and expanding sums (season,
venue and pair rates) are prefixes inside the months plus a carry-in from the months
before: a table of one row per key and month, pre-aggregated and joined on exactly
the columns the rows are already clustered by, so they are shuffled once and never
sorted globally.

Frames bounded by rows (last n games, lag, the EWMA's lookback) need the rows
before, however many months ago.  For them the places are cut into segments of at
most ``chunk_rows`` rows, and each segment also receives the ``halo`` rows just
before it (copies flagged ``_halo``, dropped afterwards), so a frame that reaches
back across a segment boundary sees exactly the rows it would see unsplit.

Results are identical to the unsplit windows; no window group exceeds a key's month
or ``chunk_rows + halo`` rows.  Series are ordered by a date first.

Short series gain nothing from this: a team with a game a month would have as many
month rows as games.  So the series are counted first (``longest``), and only if one
is longer than CHUNK_ROWS are they cut.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1 << 16
# Rows of a task that sorts or gathers them: tasks grow in number with the table, not in size.
ROWS_PER_TASK = 1 << 17
UNBOUNDED = Window.unboundedPreceding


def extent(df: DataFrame, *key: str) -> tuple[int, int]:
    """Rows of the longest series, and of all: counts per key, pre-aggregated; two
    numbers reach the driver."""
    most, rows = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"), F.sum("_n")).first()
    return most or 0, rows or 0


def sides(games: DataFrame) -> DataFrame:
    return games.select(F.explode(F.array("HOME_TEAM_ID", "VISITOR_TEAM_ID")).alias("team"))


def longest_team(games: DataFrame) -> int:
    """Games of the team that has most; no pair has more."""
    return extent(sides(games), "team")[0]


def tasks(spark, rows: int) -> int:
    """Tasks of ROWS_PER_TASK for so many rows, but no fewer than there are cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def unbuffered_tasks(spark, rows: int) -> int:
    """``tasks``, but no more than a shuffle may have whose rows go straight to a file per
    task.  Beyond that a task holds all rows it sends in memory and sorts them, as many as
    a file split has: for the shuffles of scans, whose splits no count of rows bounds."""
    return min(tasks(spark, rows), max(1, int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))))


def spread(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df`` clustered by ``key`` over as many tasks as ``rows``, about its number of
    rows, call for.  The session's number of shuffle partitions would be the same for
    any size of the table, and adaptive execution would merge them further."""
    return df.repartition(tasks(df.sparkSession, rows), *key)


def month_of(date: str) -> Column:
    """The month of a date; rows without a date come first, like in the order."""
    return F.coalesce(F.trunc(F.col(date), "month"), F.lit("0001-01-01").cast("date"))


def numbered(df: DataFrame, key: list[str], order: list[str], measures: dict[str, Column] | None = None,
             inner: str | None = None, include_current: bool = False, keep_month: bool = False) -> DataFrame:
    """Adds _pos, the 0-based place of every row in its key's series (``order`` begins
    with a date), and for each measure ``_p_<name>``: its sum over the earlier rows of
    the key (and of the same value of ``inner``), or up to and including the row."""
    measures = measures or {}
    d = df.withColumn("_month", month_of(order[0]))
    value = F.col(inner) if inner else F.lit(0)
    part = [*key, "_month"]
    rows = Window.partitionBy(*part).orderBy(*order)
    upto = (Window.partitionBy(*part, inner).orderBy(*order) if inner else rows).rowsBetween(UNBOUNDED, 0 if include_current else -1)
    before = Window.partitionBy(*key, "_i").orderBy("_month").rowsBetween(UNBOUNDED, -1)
    sizes = d.groupBy(*part, value.alias("_i")).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(k) for k, m in measures.items()])
    months = sizes.select(*part, "_n", F.struct("_i", *[F.sum(k).over(before).alias(k) for k in measures]).alias("_c")) if measures else \
        sizes.select(*part, "_n", F.struct("_i").alias("_c"))
    months = months.groupBy(*part).agg(F.sum("_n").alias("_n"), F.collect_list("_c").alias("_carry"))
    start = F.sum("_n").over(Window.partitionBy(*key).orderBy("_month").rowsBetween(UNBOUNDED, -1))
    months = months.select(*part, F.coalesce(start, F.lit(0)).alias("_start"), "_carry")
    out = d.select("*", (F.row_number().over(rows) - 1).alias("_inside"),
                   *[F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(f"_w_{k}") for k, m in measures.items()])
    own = F.get(F.filter("_carry", lambda c: c["_i"].eqNullSafe(value)), F.lit(0))
    out = out.join(months, part).withColumn("_own", own)
    return out.select(*df.columns, *(["_month"] if keep_month else []), (F.col("_start") + F.col("_inside")).cast("bigint").alias("_pos"), *[
        (F.col(f"_w_{k}") + F.coalesce(F.col("_own")[k], F.lit(0))).alias(f"_p_{k}") for k in measures])


def segment(df: DataFrame, halo: int, chunk_rows: int | None = None) -> DataFrame:
    """Numbered rows plus _seg (segment) and _halo (copy flag)."""
    chunk_rows = chunk_rows or CHUNK_ROWS
    if halo > chunk_rows:
        raise ValueError("halo must not exceed the segment size")
    idx = df.withColumn("_seg", F.expr(f"_pos div {chunk_rows}"))
    if not halo:
        return idx.withColumn("_halo", F.lit(False))
    # the last rows of a full segment also go to the next one
    near_end = F.expr(f"_pos % {chunk_rows}") >= chunk_rows - halo
    return idx.select("*", F.explode(F.when(near_end, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("_halo")) \
        .withColumn("_seg", F.when(F.col("_halo"), F.col("_seg") + 1).otherwise(F.col("_seg")))


def window(key: list[str], *extra: str) -> Window:
    """Window over a segment of the key's series, in series order."""
    return Window.partitionBy(*key, *extra, "_seg").orderBy("_pos")


def prior_last(seg: DataFrame, key: list[str], value: str, out: str,
               include_current: bool = False) -> DataFrame:
    """For every row, the last non-null ``value`` strictly before it (or up to
    it) in its key's series, across segments (as-of lookup on a split series):
    within the segment, ``last(ignorenulls)`` over the preceding rows; else
    the last value of the latest earlier segment that has one (a table of
    one row per (key, segment) with a prefix window over it)."""
    real = ~F.col("_halo")
    w = window(key).rowsBetween(UNBOUNDED, 0 if include_current else -1)
    within = F.last(F.when(real, F.col(value)), ignorenulls=True).over(w)
    # one row for every (key, segment) present -- also segments holding no
    # value at all, which must still inherit from the earlier segments
    lasts = seg.filter(real).groupBy(*key, "_seg").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col("_pos"))).alias("_lv"))
    wc = Window.partitionBy(*key).orderBy("_seg").rowsBetween(UNBOUNDED, -1)
    carry = lasts.select(*key, "_seg", F.last("_lv", ignorenulls=True).over(wc).alias("_cv")).filter("_cv IS NOT NULL")
    full = seg.select("*", within.alias("_wv")).join(carry, [*key, "_seg"], "left")
    return full.select(*seg.columns, F.coalesce(F.col("_wv"), F.col("_cv")).alias(out))
