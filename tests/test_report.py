"""The report's second path at any number of rows."""
from __future__ import annotations

import random

import numpy as np
import pytest

from pregame import config
from pregame.operators import metrics
from pregame.plans import models, report


@pytest.mark.parametrize("parts", [1, 7])
def test_area_under_points_dealt_over_partitions(spark, parts):
    rng = random.Random(5)
    steps = [(rng.choice([0.0, rng.random()]), rng.choice([0.0, rng.random()])) for _ in range(500)]
    x, y = (np.cumsum([0.0, *s]) for s in zip(*steps))
    points = [(float(a / x[-1]), float(b / y[-1])) for a, b in zip(x, y)]
    shuffled = rng.sample(points, len(points))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = metrics.area_under(spark.createDataFrame(shuffled, "fpr double, tpr double").repartition(parts)).first().area
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx(sum((c - a) * (d + b) / 2 for (a, b), (c, d) in zip(points, points[1:])))
    assert metrics.area_under(spark.createDataFrame([], "fpr double, tpr double")).first().area == 0.0


def test_no_check_brings_the_curve_to_the_driver(spark, monkeypatch):
    """However many distinct scores, the checks collect tables of models, cells, bins and
    features."""
    rng = random.Random(6)
    cols = ["a", "b", "c"]

    def rows(n):
        x = [[rng.gauss(0, 1) for _ in cols] for _ in range(n)]
        return spark.createDataFrame([(*v, int(v[0] + rng.gauss(0, 1) > 0)) for v in x], f"a double, b double, c double, {config.LABEL} int").persist()
    train, test = rows(400), rows(1200)
    model = models.fit_logreg(train, cols)
    scored = models.probability(model.transform(test)).selectExpr(f"{config.LABEL} AS y", "prob")
    res = {"logistic_regression": {"model": model, "metrics": metrics.classification_metrics(scored).first().asDict()}}
    assert metrics.roc_points(scored).count() > 300
    kind, taken = type(train), []
    real = kind.collect

    def collect(df):
        out = real(df)
        taken.append(len(out))
        return out
    monkeypatch.setattr(kind, "collect", collect)
    monkeypatch.setattr(kind, "toPandas", lambda df: pytest.fail("a table was brought to the driver"))
    checks = {r["check"]: r for r in report.report_checks(spark, res, train, test, cols).collect()}
    assert max(taken) <= 50 and sum(r.differing for r in checks.values()) == 0 and checks["roc"].checked == 1
