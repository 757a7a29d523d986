"""What the parity audit and the saved state leave on disk."""
from __future__ import annotations

import datetime
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pregame.operators import segments, state
from pregame.plans import audit
from pregame.session import shuffles_dropped
from pregame.sources import sinks


@pytest.fixture(scope="module")
def played(spark):
    """Six leagues of four teams, one of which plays most games."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        lg = rng.choice([0, 0, 0, 1, 2, 3, 4, 5])
        home, away = rng.sample(range(4), 2)
        a, b = rng.sample(range(80, 130), 2)
        day = datetime.date(1997, 1, 1) + datetime.timedelta(days=rng.randrange(1500))
        rows.append((i, day, day.year, lg, lg * 10 + home, lg * 10 + away, float(a), float(b), int(a > b)))
    return spark.createDataFrame(rows, "GAME_ID bigint, GAME_DATE_EST date, SEASON int, LEAGUE bigint, HOME_TEAM_ID bigint, VISITOR_TEAM_ID bigint, "
                                       "PTS_home double, PTS_away double, HOME_TEAM_WINS int").persist()


def shuffled(spark) -> set:
    """Shuffle files of this session, once no more go."""
    def names():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {b for b in blocks if re.search(r"/shuffle_.*data$", b)}
    now = names()
    for _ in range(20):
        time.sleep(0.2)
        before, now = now, names()
        if before == now:
            break
    return now


def test_rounds_check_every_game(spark, played, monkeypatch):
    """Rounds of whole leagues find what one round finds, each with its teams' states
    alone."""
    served = state.build_state(played)
    wrong = served._replace(team=served.team.withColumn("elo_post", F.when(F.col("GAME_ID") % 7 == 0, F.col("elo_post") + 1).otherwise(F.col("elo_post"))))
    whole = audit.parity(played, wrong).first()
    assert whole.rows_checked == 400 and 20 < whole.differing < 400
    monkeypatch.setattr(audit, "GAMES_PER_ROUND", 201)
    seen, real = [], state.asof_features

    def looked(requests, own, bulk=False):
        seen.append(own.teams().count())
        return real(requests, own, bulk)
    monkeypatch.setattr(audit.state, "asof_features", looked)
    assert audit.parity(played, wrong).first() == whole
    assert len(seen) == 2 and all(seen) and sum(seen) == 800  # every state in one round


def test_compared_features_are_not_shuffled_again(spark, played, monkeypatch):
    """Served and built features lie by game over the same tasks."""
    monkeypatch.setattr(segments, "ROWS_PER_TASK", 60)
    served = state.build_state(played)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = audit.parity(played, served)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in plan and not re.search(r"hashpartitioning\(_[lr]#", plan)


def test_saving_a_state_leaves_its_tables_alone(spark, played):
    """The tables of ``build_state``; neither scratch rows nor shuffles stay."""
    path = sinks.scratch_path(spark, "state-saved")
    top = path.rsplit("/", 1)[0]
    _, fs = sinks._path(spark, top)
    before = shuffled(spark)
    state.save_state(played, path)
    assert not shuffled(spark) - before
    assert not [x for x in fs.listStatus(sinks._path(spark, top)[0]) if "state-rows" in x.getPath().getName()]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    got, want = state.read_state(spark, path), state.build_state(played)
    for a, b in zip(got, want):
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
    sinks.remove(spark, path)


def test_kept_tables_outlive_dropped_shuffles(spark):
    df = spark.range(100).repartition(5, "id").persist()
    with shuffles_dropped(spark):
        assert df.groupBy((F.col("id") % 3).alias("k")).count().count() == 3
    assert df.count() == 100 and df.repartition(3).distinct().count() == 100
    df.unpersist()


def test_a_game_without_an_id_or_twice_is_rated_as_before(spark, played):
    """A null id meets no rating and has no state, but counts for its team's next games;
    a repeated id is a row for each rating."""
    g = played.withColumn("GAME_ID", F.when(F.col("GAME_ID") != 5, F.col("GAME_ID")))
    rows = state.team_rows(g)
    assert rows.count() == 798 and rows.filter("GAME_ID IS NULL OR elo_post IS NULL").count() == 0
    twice = played.unionByName(played.filter("GAME_ID = 7"))
    assert state.team_rows(twice).filter("GAME_ID = 7").count() == 8
