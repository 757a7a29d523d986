"""End-to-end jobs: ingest, state tables, train-and-report, batch scoring.

Long lineages are cut with written tables in a shared folder: the feature
table is written once, partitioned by SEASON, and every later step (split,
medians, fits, evaluation) reads it back.  The time split then reads only
its own season folders (partition pruning), and a lost executor never
re-runs the Elo fold or the windows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import clean, state
from ..operators import features as feat
from ..sources import ingest, sinks
from . import models, report, scoring


def ingest_job(spark: SparkSession, landed: str, workdir: str, fmt: str = "parquet") -> DataFrame:
    """Landed two-row game logs of all seasons -> cleaned games table, written
    by season and read back."""
    games = clean.clean_games(ingest.ingest_seasons(spark, landed, fmt))
    sinks.write_table(games, f"{workdir}/games", "parquet", ["SEASON"])
    return spark.read.parquet(f"{workdir}/games")


def state_job(spark: SparkSession, games: DataFrame, workdir: str, append: bool = False) -> state.State:
    """Team and pair state after every game, written for ``score_job``.
    ``append``: ``games`` are new ones, folded onto the saved state; nothing
    earlier is read but the last state of every team and pair."""
    path = f"{workdir}/state"
    if append:
        state.save_state(games, path, state.read_state(spark, path), state.versions(spark, path))
    else:
        sinks.remove(spark, path)
        state.save_state(games, path)
    return state.read_state(spark, path)


def train_job(spark: SparkSession, games: DataFrame, workdir: str, tune: bool = True, **search) -> dict:
    """games -> features (written) -> warm-up drop -> time split -> three
    models -> comparison + diagnostics (written) -> best model + feature list
    (written).  Returns the report dict."""
    feats_path = f"{workdir}/features"
    sinks.write_features(feat.build_features(games), feats_path)
    table = spark.read.parquet(feats_path)
    cols = feat.feature_names()
    warm = feat.warmup_drop(table)
    train, test = feat.time_split(warm)
    results = models.train_all(train, test, cols, tune=tune, stored=True, **search)
    out = report.evaluate_report(spark, results, train, test, cols, f"{workdir}/reports")
    _, best = models.select_best(results)
    models.save_artifacts(spark, best["model"], cols, f"{workdir}/artifacts")
    return out


def score_job(spark: SparkSession, requests: DataFrame, teams: DataFrame,
              workdir: str, out_path: str | None = None) -> DataFrame:
    """Score match-up requests with the saved model and the saved state tables
    (``train_job`` and ``state_job`` of the same folder); optionally write them."""
    model, cols = models.load_artifacts(spark, f"{workdir}/artifacts")
    if cols != feat.feature_names():
        raise ValueError("saved feature list does not match this library's features")
    preds = scoring.score_matchups(requests, state.read_state(spark, f"{workdir}/state"), teams, model)
    if out_path:
        preds.write.mode("overwrite").parquet(out_path)
        return spark.read.parquet(out_path)
    return preds


def split_counts(spark: SparkSession, workdir: str) -> DataFrame:
    """Rows per side of the split, read straight from the written table."""
    t = feat.warmup_drop(spark.read.parquet(f"{workdir}/features"))
    return t.groupBy(F.when(F.col("SEASON") < config.TEST_SEASON_START, "train")
                     .otherwise("test").alias("split")).count()
