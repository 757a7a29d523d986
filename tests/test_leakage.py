"""Leakage audits (first-game Elo, own outcome, appended future game,
train/serve parity) and invariance to input order and partitioning."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pregame.operators import features, ordered
from pregame.plans import audit


def test_cold_start(games, feats):
    r = audit.cold_start(games, feats).first()
    assert r.teams_checked > 0 and r.violations == 0


def test_own_outcome_does_not_leak(games):
    r = audit.counterfactual(games).first()
    assert r.own_row_changed == 0
    assert r.later_rows_changed > 0


def test_appended_future_game_is_non_invasive(games):
    r = audit.append_invariance(games).first()
    assert (r.rows_checked, r.existing_rows_changed, r.synthetic_rows) == (games.count(), 0, 1)


def test_train_serve_parity(games):
    r = audit.parity(games).first()
    assert (r.rows_checked, r.differing) == (games.count(), 0)


def test_order_and_partitioning_invariance(games, feats):
    cols = features.feature_names()
    shuffled = games.orderBy(F.rand(7)).repartition(7)
    one = games.coalesce(1)
    for g in (shuffled, one):
        other = features.build_features(g)
        assert audit.differing(feats, other, cols).filter("differs").isEmpty()


def test_feature_columns_and_order(feats):
    cols = features.feature_columns(feats)
    assert len(cols) == 43
    assert cols[:3] == ["home_winrate_last5", "away_winrate_last5", "diff_winrate_last5"]
    assert "diff_back_to_back" not in cols
    assert cols[-5:] == ["h2h_home_winrate", "home_elo_pre", "away_elo_pre", "elo_prob_home", "diff_elo"]


def _few_teams(games):
    """The same games played by three teams, so series are hundreds of rows long."""
    return games.withColumns({"HOME_TEAM_ID": F.col("GAME_ID") % 3, "VISITOR_TEAM_ID": (F.col("GAME_ID") % 3 + 1 + F.col("GAME_ID") % 2) % 3,
                              "LEAGUE": F.lit(1).cast("bigint")})


def test_split_windows_equal_plain(games, monkeypatch):
    """Series split into 211-row segments (each cut several times, with a halo of
    192 rows) give the unsplit values."""
    from pregame.operators import segments
    cols = features.feature_names()
    monkeypatch.setattr(segments, "CHUNK_ROWS", 211)
    hot = _few_teams(games)
    a = ordered.kept(features.build_features(hot))
    b = features.build_features(hot, split=False)
    assert a.count() == games.count() and audit.differing(a, b, cols).filter("differs").isEmpty()


@pytest.mark.parametrize("bulk", [True, False])
def test_asof_parity_in_both_ways(games, monkeypatch, bulk):
    """As-of lookups, ordered on 211-row segments or by interval, serve exactly the
    pre-game features of every historical game."""
    from pregame.operators import segments
    monkeypatch.setattr(segments, "CHUNK_ROWS", 211)
    for g in (games, _few_teams(games)):
        r = audit.parity(g, bulk=bulk).first()
        assert (r.rows_checked, r.differing) == (games.count(), 0)


def test_differing_sees_values_nulls_and_missing_games(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (5, None)], "GAME_ID long, x double")
    b = spark.createDataFrame([(1, 1.0 + 1e-12), (2, 2.0), (4, 3.0), (5, None)], "GAME_ID long, x double")
    got = {r.GAME_ID: r.differs for r in audit.differing(a, b, ["x"]).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True, 5: False}


def test_advanced_boxscore_features_extend_the_table(games, feats):
    """With the optional box-score stats on, their rolling means join the
    table (home/away/diff) and the 43 default features are unchanged."""
    cols = features.feature_names()
    adv = features.build_features(games, advanced=True)
    extra = [c for c in adv.columns if c not in feats.columns]
    assert {"home_fg_pct_last5", "away_ast_last10", "diff_fg_pct_last10"} <= set(extra)
    assert audit.differing(adv, feats, cols).filter("differs").isEmpty()
