"""Resolution, hypothetical games and batch scoring sanity."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pregame import config
from pregame.operators import features, resolve
from pregame.plans import models, scoring
from pregame.sources import tables
from small_data import SF_SMALL


@pytest.fixture(scope="module")
def teams(spark):
    return tables.teams_from_tables(spark, SF_SMALL).persist()


def _resolve(spark, teams, names):
    req = spark.createDataFrame(list(enumerate(names)), "REQUEST_ID int, name string")
    r = resolve.resolve_names(req, teams, "name", "team_id").orderBy("REQUEST_ID").collect()
    return [(x.team_id, x.team_id_how) for x in r]


def test_resolution_paths(spark, teams):
    got = _resolve(spark, teams, ["7", " 7 ", "Customer#000000007", "T7", "#00000001", "nobody", "99999"])
    assert got == [(7, "id"), (7, "id"), (7, "exact"), (7, "exact"), (10, "contains"),
                   (None, "unresolved"), (None, "unresolved")]


def test_requests_by_id_read_no_names(spark):
    read = F.udf(lambda i: 1 // 0 and "", "string")  # a name that can't be read
    dim = spark.range(20).select(F.col("id").alias("TEAM_ID"), *[read("id").alias(c) for c in resolve.NAME_COLUMNS])
    assert _resolve(spark, dim, ["7", " 07 ", "99", None]) == [(7, "id"), (7, "id"), (None, "unresolved"), (None, "unresolved")]
    with pytest.raises(Exception, match="ZeroDivisionError|division"):
        _resolve(spark, dim, ["7", "name"])


def test_teams_lie_in_a_part_for_every_core(spark, tmp_path):
    from pregame import catalog
    spark.createDataFrame([(i, f"Customer#{i}", 0, 0.0, "A") for i in range(50)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    got = catalog.teams_table(spark, str(tmp_path))
    assert got.count() == 50 and got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    got.unpersist()


def test_id_name_abbreviation_agree(spark, teams):
    row = teams.orderBy("TEAM_ID").first()
    got = _resolve(spark, teams, [str(row.TEAM_ID), row.FULL_NAME, row.ABBREVIATION])
    assert {g[0] for g in got} == {row.TEAM_ID}


def test_ambiguous_city_takes_lowest_id(spark, teams):
    city = teams.filter(F.col("TEAM_ID") == 3).first().CITY
    lowest = teams.filter(F.col("CITY") == city).agg(F.min("TEAM_ID")).first()[0]
    assert _resolve(spark, teams, [city.lower()])[0] == (lowest, "exact")


def test_hypothetical_dates(spark, games):
    req = spark.createDataFrame([(1, 10, 11, None), (2, 10, 11, dt.date(2000, 6, 15))],
                                "REQUEST_ID int, HOME_TEAM_ID long, VISITOR_TEAM_ID long, REQUEST_DATE date")
    h = {r.REQUEST_ID: r for r in resolve.hypothetical_games(req, games).collect()}
    ms = games.agg(F.max("SEASON")).first()[0]
    assert h[1].SEASON == ms + 1 and h[1].GAME_DATE_EST == dt.date(ms + 1, 10, 21)
    assert h[1].season_label == f"{ms + 1}-{(ms + 2) % 100:02d}"
    assert h[2].SEASON == ms and h[2].GAME_DATE_EST == dt.date(2000, 6, 15)


@pytest.fixture(scope="module")
def model(spark, feats):
    warm = features.warmup_drop(feats)
    train, _ = features.time_split(warm)
    return models.fit_logreg(train, features.feature_names())


@pytest.fixture(scope="module")
def served(spark, games):
    from pregame.plans import jobs
    from pregame.sources import sinks
    return jobs.state_job(spark, games, sinks.scratch_path(spark, "state-test"))


def test_no_fold_in_the_scoring_plan(spark, served, teams, model):
    req = spark.createDataFrame([(1, "10", "11", None)], "REQUEST_ID int, HOME string, AWAY string, REQUEST_DATE date")
    plan = scoring.score_matchups(req, served, teams, model)._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan


def test_scores_are_probabilities_and_guards(spark, served, teams, model):
    req = spark.createDataFrame(
        [(1, "10", "11", None), (2, "11", "10", None), (3, "10", "10", None), (4, "10", "nobody", None)],
        "REQUEST_ID int, HOME string, AWAY string, REQUEST_DATE date")
    out = {r.REQUEST_ID: r for r in scoring.score_matchups(req, served, teams, model).collect()}
    for i in (1, 2):
        p = out[i]
        assert p.status == "ok" and 0.0 <= p.home_win_prob <= 1.0
        assert p.home_win_prob + p.away_win_prob == pytest.approx(1.0)
        assert p.predicted_winner == ("home" if p.home_win_prob >= 0.5 else "away")
        assert [k.feature for k in p.key_features] == list(config.KEY_FEATURES)
    assert out[1].home_win_prob != pytest.approx(out[2].home_win_prob)
    assert out[3].status == "same team" and out[3].home_win_prob is None
    assert out[4].status == "unknown team"
    assert out[1].home_team == "Customer#000000010"


def test_single_call_interface(spark, served, teams, model):
    row = teams.orderBy("TEAM_ID").first()
    assert scoring.list_teams(teams).first().TEAM_ID == row.TEAM_ID
    assert scoring.resolve_team(teams, row.TEAM_ID) == scoring.resolve_team(teams, row.FULL_NAME) \
        == scoring.resolve_team(teams, row.ABBREVIATION) == row.TEAM_ID
    with pytest.raises(ValueError):
        scoring.resolve_team(teams, "Definitely Not A Real Team 12345")
    rec = scoring.predict_matchup(served, teams, model, 10, 11)
    assert 0.0 <= rec["home_win_prob"] <= 1.0
    assert rec["home_win_prob"] == pytest.approx(1.0 - rec["away_win_prob"])
    assert rec["predicted_winner"] in ("home", "away")
    swapped = scoring.predict_matchup(served, teams, model, 11, 10)
    assert swapped["home_win_prob"] != pytest.approx(rec["home_win_prob"])
    with pytest.raises(ValueError):
        scoring.predict_matchup(served, teams, model, 10, 10)
    with pytest.raises(ValueError):
        scoring.predict_matchup(served, teams, model, 10, "Definitely Not A Real Team 12345")
