"""Exploratory aggregates over games and feature tables.

All are declarative aggregates (partial aggregation before the shuffle); the
only ordered steps go through ``ordered`` (no single-partition window).
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from . import ordered


HISTOGRAM = "side string, bin int, lo double, hi double, count bigint, density double"
DENSITY = "side string, grid_idx int, x double, density double"


def label_distribution(games: DataFrame) -> DataFrame:
    """Share of each label value, with its name (0 = away win, 1 = home win)."""
    counts = games.groupBy(config.LABEL).agg(F.count(F.lit(1)).alias("n"))
    # the grouped table has one row per label value (two): a global window is size-safe
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(F.col(config.LABEL).cast("int").alias("label"),
                         C.label_name(config.LABEL).alias("outcome"),
                         (F.col("n") / total).alias("share"))


def season_summary(games: DataFrame) -> DataFrame:
    return games.groupBy("SEASON").agg(
        F.count(F.lit(1)).cast("bigint").alias("games"),
        F.avg(config.LABEL).alias("home_win_rate"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null share per column, one pass (``avg(isNull)`` per column) then unpivot."""
    cols = columns or df.columns
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in cols])))


def games_extent(games: DataFrame) -> DataFrame:
    return games.agg(
        F.count(F.lit(1)).cast("bigint").alias("games"),
        F.min("SEASON").alias("first_season"), F.max("SEASON").alias("last_season"),
        F.min("GAME_DATE_EST").alias("first_date"), F.max("GAME_DATE_EST").alias("last_date"),
        F.countDistinct("SEASON").cast("bigint").alias("seasons"))


def points_summary(games: DataFrame) -> DataFrame:
    return games.agg(F.avg("PTS_home").alias("mean_pts_home"),
                     F.avg("PTS_away").alias("mean_pts_away"))


def _auto_bins(n: int, lo: float, hi: float, q25: float, q75: float) -> int:
    """numpy's 'auto' rule: the smaller of the Sturges and Freedman-Diaconis
    widths (Sturges alone when the IQR is 0)."""
    span = hi - lo
    if span == 0:
        return 1
    sturges = span / (math.log2(n) + 1.0)
    fd = 2.0 * (q75 - q25) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return int(np.ceil(span / width))


def points_histogram(games: DataFrame) -> DataFrame:
    """Density-normalised histogram of home and away points, each side with
    its own automatic equal-width bins.  -> side, bin, lo, hi, count, density.

    Per side only four numbers reach the driver (n, min, max, quartiles) to
    fix the bin count; the counting itself is one grouped aggregate.
    """
    sides = [("home", "PTS_home"), ("away", "PTS_away")]
    q = ordered.exact_quantiles(games, [c for _, c in sides], [0.25, 0.75]).collect()
    quart = {(r["column"], r["p"]): r["value"] for r in q}
    stats = games.agg(*[x for _, c in sides for x in (
        F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    parts = []
    for side, c in sides:
        n, lo, hi = stats[f"n_{c}"], stats[f"lo_{c}"], stats[f"hi_{c}"]
        if not n:
            continue
        bins = _auto_bins(n, lo, hi, quart[(c, 0.25)], quart[(c, 0.75)])
        span = (hi - lo) or 1.0
        norm = bins / span  # numpy: index = (x - first_edge) * (bins / span)
        idx = F.least(F.lit(bins - 1), F.floor((F.col(c) - F.lit(lo)) * F.lit(norm)))
        width = span / bins
        h = (games.filter(F.col(c).isNotNull())
             .groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("count")))
        parts.append(h.select(
            F.lit(side).alias("side"), "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
            "count", (F.col("count") / F.lit(n * width)).alias("density")))
    out = games.sparkSession.createDataFrame([], HISTOGRAM)  # without games no side has bins
    for p in parts:
        out = out.unionByName(p)
    return out


def points_kde(games: DataFrame, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE of home / away points on a 200-point grid (Scott's rule:
    bandwidth = sample std * n^(-1/5); grid from min - 3 bw to max + 3 bw).

    The data are first reduced to a value-count table (points are few
    distinct values); each distinct value then emits its contribution to every
    grid point (a fixed-size ``sequence``, no join) and contributions are
    summed per grid point.  -> side, grid_idx, x, density
    """
    out = games.sparkSession.createDataFrame([], DENSITY)  # without games no side has a curve
    sides = (("home", "PTS_home"), ("away", "PTS_away"))
    # four numbers per side reach the driver (n, sample std, min, max)
    st = games.agg(*[x for _, c in sides for x in (
        F.count(c).alias(f"n_{c}"), F.stddev_samp(c).alias(f"sd_{c}"),
        F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    for side, c in sides:
        n, sd, lo, hi = st[f"n_{c}"], st[f"sd_{c}"], st[f"lo_{c}"], st[f"hi_{c}"]
        if not n or not sd:
            continue
        bw = sd * n ** -0.2
        start, stop = lo - cut * bw, hi + cut * bw
        step = (stop - start) / (gridsize - 1)
        counts = (games.filter(F.col(c).isNotNull())
                  .groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("k")))
        t = counts.select("v", "k", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_idx"))
        x = F.lit(start) + F.col("grid_idx") * F.lit(step)
        z = (x - F.col("v")) / F.lit(bw)
        contrib = F.col("k") * F.exp(F.lit(-0.5) * z * z)
        d = t.groupBy("grid_idx").agg(F.sum(contrib).alias("_s"))
        d = d.select(F.lit(side).alias("side"), F.col("grid_idx").cast("int").alias("grid_idx"),
                     (F.lit(start) + F.col("grid_idx") * F.lit(step)).alias("x"),
                     (F.col("_s") / F.lit(n * bw * math.sqrt(2 * math.pi))).alias("density"))
        out = out.unionByName(d)
    return out


def feature_correlation(features: DataFrame, feature_cols: list[str], top: int = config.TOP_CORRELATIONS) -> DataFrame:
    """Pairwise-complete Pearson r of each feature with the label, top-k by |r|.

    One aggregate computes every r; the ranking runs on the tiny result."""
    label = F.col(config.LABEL).cast("double")
    one = features.agg(*[F.corr(F.col(c).cast("double"), label).alias(c) for c in feature_cols])
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in feature_cols])))
    return long.filter(F.col("r").isNotNull()).orderBy(F.abs("r").desc(), "feature").limit(top)


def qcut_edges(values: DataFrame, col: str, q: int = 10) -> list[float]:
    """Distinct quantile edges (pandas qcut, duplicates dropped); q+1 numbers."""
    probs = np.linspace(0, 1, q + 1).tolist()
    rows = ordered.exact_quantiles(values, [col], probs).collect()
    edges = sorted({r["value"] for r in rows})
    return edges


def decile_rate(features: DataFrame, col: str = "diff_season_winrate", q: int = 10) -> DataFrame:
    """Home win rate per quantile bin of ``col`` (right-closed bins, lowest
    edge included, duplicate edges dropped).  -> bin, lo, hi, games, rate"""
    d = ordered.kept(features.filter(F.col(col).isNotNull()).select(col, config.LABEL))  # for edges and bins
    edges = qcut_edges(d, col, q)
    arr = F.array(*[F.lit(e) for e in edges])
    k = F.size(F.filter(arr, lambda e: e < F.col(col)))
    b = F.greatest(k, F.lit(1))
    g = d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("games"),
                                      F.avg(config.LABEL).alias("home_win_rate"))
    return g.select(F.col("bin").cast("int").alias("bin"),
                    F.element_at(arr, F.col("bin").cast("int")).alias("lo"),
                    F.element_at(arr, (F.col("bin") + 1).cast("int")).alias("hi"),
                    "games", "home_win_rate")


def first_games(games: DataFrame) -> DataFrame:
    """First game of every team (either side), by (date, GAME_ID).
    ``min(struct)`` aggregates map-side, so a team with a huge history is one
    partial row per task."""
    sides = games.select(F.inline(F.array(
        F.struct(F.col("HOME_TEAM_ID").alias("team"), "GAME_DATE_EST", "GAME_ID"),
        F.struct(F.col("VISITOR_TEAM_ID").alias("team"), "GAME_DATE_EST", "GAME_ID"))))
    first = sides.groupBy("team").agg(F.min(F.struct("GAME_DATE_EST", "GAME_ID")).alias("_f"))
    return first.select("team", F.col("_f.GAME_ID").alias("GAME_ID"),
                        F.col("_f.GAME_DATE_EST").alias("GAME_DATE_EST"))


def not_first_games(games: DataFrame) -> DataFrame:
    """Games that are no team's first game (anti join on the first-game ids)."""
    firsts = first_games(games).select("GAME_ID").distinct()
    return games.join(firsts, "GAME_ID", "left_anti")
