"""Binary classification metrics over a scored table (columns ``y``, ``prob``).

Everything starts from one grouped table -- (score, positives, negatives) --
built with partial aggregation, so a billion scored rows shrink to their
distinct scores before any shuffle.  Ranks for AUC / ROC come from the
distributed running sums in ``ordered`` (never a single-partition window).
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from . import ordered

EPS = float(np.finfo(np.float64).eps)


def score_groups(scored: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    return scored.groupBy(F.col(prob).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((F.lit(1) - F.col(y)).cast("long")).alias("neg"))


def classification_metrics(scored: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    """accuracy, precision / recall / F1 (0 when undefined), exact ROC-AUC
    (ties count one half), log-loss (probabilities clipped to [eps, 1-eps]),
    plus the four confusion counts.  Decision = prob >= threshold."""
    g = score_groups(scored, y, prob)
    g = ordered.running_sums(g, ["score"], ["neg"], inclusive=False)  # cum_neg: negatives below
    hit = C.decision("score") == 1
    p = F.least(F.greatest(F.col("score"), F.lit(EPS)), F.lit(1.0 - EPS))
    agg = g.agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
        F.sum(F.col("pos") * (F.col("cum_neg") + F.lit(0.5) * F.col("neg"))).alias("_auc_num"),
        F.sum(F.col("pos") * -F.log(p) + F.col("neg") * -F.log(F.lit(1.0) - p)).alias("_ll"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return agg.select(
        n.cast("bigint").alias("n"),
        ((tp + tn) / n).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(F.col("_auc_num"), (tp + fn) * (fp + tn)).alias("roc_auc"),
        (F.col("_ll") / n).alias("log_loss"),
        *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
    )


def confusion_matrix(scored: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    """All four cells (zeros included) from one aggregate + stack."""
    pred = C.decision(prob)
    yy = F.col(y)
    one = scored.agg(*[F.sum(((yy == a) & (pred == b)).cast("long")).alias(f"c{a}{b}")
                       for a in (0, 1) for b in (0, 1)])
    return one.select(F.expr(
        "stack(4, 0, 0, coalesce(c00, 0L), 0, 1, coalesce(c01, 0L), "
        "1, 0, coalesce(c10, 0L), 1, 1, coalesce(c11, 0L)) AS (actual, predicted, count)"))


def roc_points(scored: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    """ROC curve: one point per distinct score (descending), collinear
    interior points with equal steps dropped, origin prepended (threshold
    null).  The scores are sorted once; neighbours come from lag / lead inside
    each range partition, and across its ends from the table of partition
    totals (one row per partition).  With only one class present the rate of
    the other is null.
    -> threshold, fpr, tpr"""
    g = score_groups(scored, y, prob)
    s = ordered.sorted_positions(g, [F.col("score").desc()])
    ends = s.groupBy("_pid").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
                                 F.min_by(F.struct("pos", "neg"), "_local").alias("_first"))
    by_pid = Window.orderBy("_pid")
    earlier = by_pid.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ends = ends.select(
        "_pid", F.sum("_p").over(earlier).alias("_p0"), F.sum("_n").over(earlier).alias("_n0"),
        F.lead("_first").over(by_pid).alias("_next"), F.sum("_p").over(every).alias("_P"), F.sum("_n").over(every).alias("_N"))
    w = Window.partitionBy("_pid").orderBy("_local")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    j = s.join(F.broadcast(ends), "_pid")
    j = j.select("score", "pos", "neg", "_P", "_N",
                 (F.coalesce("_p0", zero) + F.sum("pos").over(upto)).alias("tp"),
                 (F.coalesce("_n0", zero) + F.sum("neg").over(upto)).alias("fp"),
                 (F.lag("pos").over(w).isNull() & F.col("_p0").isNull()).alias("_first_row"),
                 F.coalesce(F.lead("pos").over(w), F.col("_next.pos")).alias("_pos_next"),
                 F.coalesce(F.lead("neg").over(w), F.col("_next.neg")).alias("_neg_next"))
    # a point bends the curve if its own step differs from the next one
    bend = (F.col("_neg_next") != F.col("neg")) | (F.col("_pos_next") != F.col("pos"))
    pts = j.filter(F.col("_first_row") | F.col("_pos_next").isNull() | bend).select(
        F.col("score").alias("threshold"), F.try_divide(F.col("fp").cast("double"), F.col("_N")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("_P")).alias("tpr"))
    origin = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def area_under(points: DataFrame) -> DataFrame:
    """Trapezoids under a curve of points (``fpr``, ``tpr``) in the order of both -> area
    (one row).  The points stay where they lie: a point's neighbour comes from lead inside
    its range partition, and across the ends from a row per partition, like in
    ``roc_points``."""
    s = ordered.sorted_positions(points.select("fpr", "tpr"), ["fpr", "tpr"])
    ends = s.groupBy("_pid").agg(F.min_by(F.struct("fpr", "tpr"), "_local").alias("_first"))
    ends = ends.select("_pid", F.lead("_first").over(Window.orderBy("_pid")).alias("_next"))
    w = Window.partitionBy("_pid").orderBy("_local")
    after = F.coalesce(F.lead(F.struct("fpr", "tpr")).over(w), F.col("_next"))
    j = s.join(F.broadcast(ends), "_pid").select("fpr", "tpr", after.alias("_after"))
    step = (F.col("_after.fpr") - F.col("fpr")) * (F.col("_after.tpr") + F.col("tpr")) / 2
    return j.agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("area"))


def calibration(scored: DataFrame, y: str = "y", prob: str = "prob",
                bins: int = config.CALIBRATION_BINS) -> DataFrame:
    """Uniform bins on [0, 1]; bin = number of inner edges strictly below the
    probability (searchsorted left); empty bins omitted.
    -> bin, mean_predicted, fraction_positive, count"""
    inner = [float(e) for e in np.linspace(0.0, 1.0, bins + 1)[1:-1]]
    arr = F.array(*[F.lit(e) for e in inner])
    b = F.size(F.filter(arr, lambda e: e < F.col(prob)))
    return scored.groupBy(b.cast("int").alias("bin")).agg(
        F.avg(prob).alias("mean_predicted"),
        F.avg(F.col(y).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).cast("bigint").alias("count"))


def baselines(games: DataFrame, is_test: Column, label: str = config.LABEL) -> DataFrame:
    """Always-home and majority-class baselines; both score every test game
    with the train home-win rate.  One aggregate gives the positives and rows of
    either side; all metrics follow from those four numbers."""
    y, test = F.col(label).cast("long"), is_test
    one = games.agg(F.sum(F.when(~test, y)).alias("_tp"), F.sum(F.when(~test, 1)).alias("_tn"),
                    F.coalesce(F.sum(F.when(test, y)), F.lit(0)).alias("pos"), F.coalesce(F.sum(F.when(test, 1)), F.lit(0)).alias("n"))
    rate = F.try_divide(F.col("_tp"), F.col("_tn"))
    one = one.select("pos", "n", rate.alias("rate"), F.bround(rate).cast("int").alias("majority"))  # half to even
    rows = one.select("pos", "n", "rate", F.inline(F.array(
        F.struct(F.lit("always_home").alias("model"), F.lit(1).alias("pred")),
        F.struct(F.lit("majority_class").alias("model"), F.col("majority").alias("pred")))))
    p = F.least(F.greatest(F.col("rate"), F.lit(EPS)), F.lit(1.0 - EPS))
    pos, neg, hit = F.col("pos"), F.col("n") - F.col("pos"), F.col("pred") == 1
    zero = F.lit(0).cast("bigint")
    rows = rows.select("model", "n", F.try_divide(-(pos * F.log(p) + neg * F.log(F.lit(1.0) - p)), F.col("n")).alias("log_loss"),
                       F.when(hit, pos).otherwise(zero).alias("tp"), F.when(hit, neg).otherwise(zero).alias("fp"),
                       F.when(hit, zero).otherwise(pos).alias("fn"), F.when(hit, zero).otherwise(neg).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return rows.select(
        "model", F.col("n").cast("bigint").alias("n"), F.try_divide(tp + tn, F.col("n")).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.lit(0.5).alias("roc_auc"), "log_loss", *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])
