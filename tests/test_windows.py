"""Hand-computed tables for the prior-only window operators."""
from __future__ import annotations

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pregame.operators import elo, views, windows

D = dt.date


def games_df(spark, rows):
    cols = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID",
            "PTS_home", "PTS_away", "HOME_TEAM_WINS"]
    return spark.createDataFrame(rows, "GAME_ID long, GAME_DATE_EST date, SEASON int, HOME_TEAM_ID long, "
                                       "VISITOR_TEAM_ID long, PTS_home double, PTS_away double, HOME_TEAM_WINS int")


# team 1 plays: g1 (home, win 100-90), g2 (away, loss 95-99 same day as g3? no),
# g3 same date as g2 with higher id (tie broken by id), g4 next season, g5 two seasons later
ROWS = [
    (1, D(2000, 1, 1), 2000, 1, 2, 100.0, 90.0, 1),
    (2, D(2000, 1, 3), 2000, 3, 1, 99.0, 95.0, 1),
    (3, D(2000, 1, 3), 2000, 1, 3, 110.0, 100.0, 1),
    (4, D(2001, 1, 4), 2001, 2, 1, 80.0, 90.0, 0),
    (5, D(2003, 1, 1), 2003, 1, 2, 70.0, 75.0, 0),
]


@pytest.fixture(scope="module")
def team1(spark):
    g = games_df(spark, ROWS)
    long = views.team_game_view(g)
    out = windows.team_features(long).filter(F.col("team") == 1).orderBy("GAME_DATE_EST", "GAME_ID")
    return out.toPandas()


def test_first_game_has_no_history(team1):
    r = team1.iloc[0]
    assert math.isnan(r.winrate_last5) and math.isnan(r.rest_days) and r.back_to_back == 0
    assert math.isnan(r.form_ptdiff_ewma) and math.isnan(r.season_winrate)


def test_rolling_prior_only(team1):
    # team 1: win (+10), loss (-4), win (+10), win (+10 away: 90-80)
    assert list(team1.winrate_last5.iloc[1:]) == [1.0, 0.5, 2 / 3, 0.75]
    assert team1.pt_diff_last5.iloc[2] == pytest.approx(3.0)


def test_same_day_tie_broken_by_id(team1):
    assert list(team1.GAME_ID) == [1, 2, 3, 4, 5]
    assert team1.rest_days.iloc[2] == 0  # same date as game 2
    assert team1.rest_days.iloc[1] == 2


def test_season_change_resets_season_rates(team1):
    assert math.isnan(team1.season_winrate.iloc[3])  # first game of 2001
    assert team1.season_winrate.iloc[2] == 0.5        # 2000: win, loss before game 3
    # venue: game 3 is home; prior home games in 2000: game 1 (win)
    assert team1.venue_winrate.iloc[2] == 1.0


def test_ewma_matches_pandas(team1):
    s = pd.Series([10.0, -4.0, 10.0, 10.0, -5.0])
    expect = s.shift(1).ewm(span=5, min_periods=1).mean()
    got = team1.form_ptdiff_ewma
    assert math.isnan(got.iloc[0])
    for a, b in zip(got.iloc[1:], expect.iloc[1:]):
        assert a == pytest.approx(b, rel=1e-12)


@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("values", [
    [100.0, None, 100.0, 100.0],
    [100.0] + [None] * 250 + [95.0, None, 120.0],       # longer than any block
    [None] * 3 + [90.0 + i % 17 for i in range(400)] + [None] * 120,
])
def test_ewma_carries_over_missing_values(spark, split, values, monkeypatch):
    from pregame.operators import segments
    monkeypatch.setattr(segments, "CHUNK_ROWS", 211)
    day = D(2000, 1, 1)
    rows = [(i, day + dt.timedelta(days=i), 2000, 1, 2, v, 90.0, 1) for i, v in enumerate(values)]
    long = views.team_game_view(games_df(spark, rows)).filter(F.col("team") == 1)
    got = windows.team_features(long, split=split).orderBy("GAME_ID").toPandas().form_ptdiff_ewma
    series = pd.Series([None if v is None else v - 90.0 for v in values], dtype=float)
    expect = series.shift(1).ewm(span=5, min_periods=1).mean()
    for a, b in zip(got, expect, strict=True):
        assert (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-12)


@pytest.mark.parametrize("split", [True, False])
def test_head_to_head_flips_to_home_view(spark, split):
    g = games_df(spark, ROWS)
    h = windows.with_head_to_head(g, split=split).orderBy("GAME_ID").toPandas().set_index("GAME_ID").h2h_home_winrate
    assert math.isnan(h[1]) and math.isnan(h[2])
    assert h[4] == 0.0   # pair (1,2): team 1 won game 1; game 4's home side is team 2
    assert h[5] == 1.0   # team 1 (home) won both earlier meetings (games 1 and 4)
    assert h[3] == 0.0   # pair (1,3): team 3 won game 2; team 1 is home in game 3


def test_rounds_keep_every_teams_order():
    import numpy as np
    r = np.random.default_rng(3)
    home = r.integers(0, 30, 400)
    away = (home + r.integers(1, 30, 400)) % 30
    at = np.empty(400, int)
    seen = []
    for k, games in enumerate(elo.rounds(home, away, 30)):
        at[games] = k
        seen += games.tolist()
        assert len(set(home[games]) | set(away[games])) == 2 * len(games)
    assert sorted(seen) == list(range(400))
    for t in range(30):
        own = at[(home == t) | (away == t)]
        assert (np.diff(own) > 0).all()


def test_leagues_from_the_team_graph(spark):
    """Without a league column, teams that ever met are one league."""
    rows = ROWS + [(9, D(2000, 2, 1), 2000, 12, 11, 80.0, 90.0, 0)]
    g = elo.with_league(games_df(spark, rows))
    assert {(r.HOME_TEAM_ID, r.LEAGUE) for r in g.collect()} == {(1, 1), (2, 1), (3, 1), (12, 11)}


def test_elo_fold_by_hand(spark):
    g = games_df(spark, ROWS)
    e = elo.elo_ratings(g).orderBy("GAME_ID").toPandas().set_index("GAME_ID")

    def expect(rh, ra):
        return 1 / (1 + 10 ** ((ra - (rh + 100)) / 400))
    e1 = expect(1500, 1500)
    r1, r2 = 1500 + 20 * (1 - e1), 1500 + 20 * ((1 - 1) - (1 - e1))
    assert e.loc[1, "home_elo_pre"] == 1500 and e.loc[1, "elo_prob_home"] == pytest.approx(e1)
    assert e.loc[1, "home_elo_post"] == pytest.approx(r1)
    # game 2: team 3 new (1500) at home vs team 1 (r1)
    assert e.loc[2, "away_elo_pre"] == pytest.approx(r1)
    # game 4 (2001): both sides regressed once toward 1500
    t1_after3 = e.loc[3, "home_elo_post"]
    assert e.loc[4, "away_elo_pre"] == pytest.approx(1500 + 0.75 * (t1_after3 - 1500))
    assert e.loc[4, "home_elo_pre"] == pytest.approx(1500 + 0.75 * (r2 - 1500))
    # game 5 (2003, one season skipped): regressed once, not twice
    assert e.loc[5, "home_elo_pre"] == pytest.approx(1500 + 0.75 * (e.loc[4, "away_elo_post"] - 1500))
    assert e.loc[4, "diff_elo"] == pytest.approx(e.loc[4, "home_elo_pre"] - e.loc[4, "away_elo_pre"])


@pytest.mark.parametrize("limit", [211, 1 << 16])
def test_layout_follows_the_longest_series(spark, limit, monkeypatch):
    """Short series run on plain windows, without month rows and checkpoints; a series
    longer than a segment is cut.  The values are the same."""
    from pregame.operators import segments
    monkeypatch.setattr(segments, "CHUNK_ROWS", limit)
    day = D(2000, 1, 1)
    rows = [(i, day + dt.timedelta(days=i % 450), 2000 + i % 450 // 365, 1 + i % 2, 2 - i % 2, 90.0 + i % 17, 95.0, i % 3 // 2) for i in range(500)]
    long = views.team_game_view(games_df(spark, rows))
    got = windows.team_features(long)
    plan = got._jdf.queryExecution().toString()
    assert ("_seg" in plan) == (limit == 211)
    names = ["GAME_ID", "team", *windows.engineered_names()]
    whole, cut = (windows.team_features(long, split=split).select(*names).orderBy("GAME_ID", "team").toPandas() for split in (False, True))
    pd.testing.assert_frame_equal(got.select(*names).orderBy("GAME_ID", "team").toPandas(), cut, check_dtype=False, rtol=1e-12)
    pd.testing.assert_frame_equal(whole, cut, check_dtype=False, rtol=1e-12)
    h = [windows.with_head_to_head(games_df(spark, rows), split=x).orderBy("GAME_ID").toPandas().h2h_home_winrate for x in (None, True)]
    pd.testing.assert_series_equal(*h, rtol=1e-12)


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Windows, ratings and the feature table run over as many tasks as their rows call
    for, whatever the session's number of shuffle partitions; the values stay."""
    from pregame.operators import elo, features, segments
    day = D(2000, 1, 1)
    rows = [(i, day + dt.timedelta(days=i % 450), 2000 + i % 450 // 365, i % 60, (i + 1) % 60, 90.0 + i % 17, 95.0, i % 3 // 2) for i in range(600)]
    games = games_df(spark, rows).withColumn("LEAGUE", F.lit(0).cast("bigint")).persist()
    before = features.build_features(games).orderBy("GAME_ID").toPandas()
    monkeypatch.setattr(segments, "ROWS_PER_TASK", 50)
    parts = lambda df: df.rdd.getNumPartitions()
    long = views.team_game_view(games)
    assert parts(windows.team_features(long)) == parts(windows.team_features(long, split=False)) == 24
    assert parts(windows.with_head_to_head(games)) == parts(elo.elo_ratings(games)) == 12
    got = features.build_features(games)
    assert parts(got) == 24
    pd.testing.assert_frame_equal(got.orderBy("GAME_ID").toPandas(), before, rtol=1e-12)
