"""End-to-end train and score jobs over written tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from pregame.plans import jobs
from pregame.sources import sinks, tables
from small_data import SF_SMALL


def test_train_then_score(spark, games):
    work = sinks.scratch_path(spark, "jobs")
    out = jobs.train_job(spark, games, work, tune=False)
    comp = {r.model: r for r in out["comparison"].collect()}
    assert set(comp) == {"always_home", "majority_class", "logistic_regression", "decision_tree",
                         "gradient_boosted_trees"}
    assert out["verdict"].first().beats_baseline
    for name in ("comparison", "confusion_matrix", "roc_points", "feature_importance", "calibration"):
        assert spark.read.option("header", True).csv(f"{work}/reports/{name}").count() > 0
    counts = {r.split: r["count"] for r in jobs.split_counts(spark, work).collect()}
    assert counts["train"] > 0 and counts["test"] > 0
    teams = tables.teams_from_tables(spark, SF_SMALL)
    req = tables.requests_from_games(games)
    jobs.state_job(spark, games, work)
    preds = jobs.score_job(spark, req, teams, work, f"{work}/predictions")
    assert preds.count() == req.count()
    assert preds.filter(F.col("status") == "ok").filter(F.col("home_win_prob").isNull()).count() == 0


def test_ingest_job(spark, games):
    from pregame.sources import ingest
    work = sinks.scratch_path(spark, "ingest-job")
    ingest.land_game_log(ingest.game_log_from_games(games), f"{work}/landed")
    got = jobs.ingest_job(spark, f"{work}/landed", work)
    cols = ["GAME_ID", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "PTS_home", "HOME_TEAM_WINS"]
    assert got.count() == games.count() and got.select(*cols).exceptAll(games.select(*cols)).isEmpty()


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Spark started from an empty folder, the library on the driver's path only."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from pregame.session import local_session
from pregame import catalog
spark = local_session(cpus=2)
print("ROWS", catalog.QUERIES["elo_ratings"](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1105" in out.stdout, out.stderr[-2000:]
