"""Profiles of a games table without games."""
from __future__ import annotations

from pregame.operators import profile


def test_empty_games(games):
    none = games.limit(0)
    assert profile.points_histogram(none).collect() == [] and profile.points_kde(none).collect() == []
    assert profile.points_histogram(none).columns == profile.points_histogram(games).columns
    assert profile.points_kde(none).columns == profile.points_kde(games).columns
    assert profile.decile_rate(none.withColumn("diff_season_winrate", none["PTS_home"])).collect() == []
