"""Pre-game Elo ratings: an ordered recurrence over each league's games.

Both sides' ratings feed each other, so neither team nor date partitioning is
independent; the independent unit is the league, a closed set of teams (derived
from the connected components of the team graph where the table has no league
column).  Games are narrowed to the seven columns the recurrence needs, hashed
by league and sorted by (date, GAME_ID) within the partition.

Each Arrow batch is worked off in rounds: a round takes every game that is the
next one of both its teams -- games of different teams do not touch each other
-- and rates them all with a few array operations.  A partition holds many
leagues, so a round rates a few games of each.  State is one rating and one
season per team and is carried from batch to batch; nothing is materialised per
group.  A single connected league stays one stream: its games per round are at
most half its teams.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from . import segments
from .components import components

ELO_SCHEMA = T.StructType([
    T.StructField("GAME_ID", T.LongType()),
    T.StructField("home_elo_pre", T.DoubleType()),
    T.StructField("away_elo_pre", T.DoubleType()),
    T.StructField("elo_prob_home", T.DoubleType()),
    T.StructField("diff_elo", T.DoubleType()),
    T.StructField("home_elo_post", T.DoubleType()),
    T.StructField("away_elo_post", T.DoubleType()),
])
NEEDED = [config.LEAGUE, "GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", config.LABEL]


def rounds(home, away, teams: int):
    """Splits ordered games (team numbers below ``teams``) into rounds: arrays
    of game numbers, each the next game of both its teams."""
    import numpy as np
    # every team's games in order: its stretch of ``queue``
    sides = np.column_stack((home, away)).ravel()
    queue = np.argsort(sides, kind="stable") // 2
    ends = np.cumsum(np.bincount(sides, minlength=teams))
    heads = np.concatenate(([0], ends[:-1]))
    waiting = np.unique(sides)
    following = np.full(teams, -1)
    while len(waiting):
        following[waiting] = queue[heads[waiting]]
        game = following[waiting]
        # seen from the home side, so each game comes up once
        ready = game[(home[game] == waiting) & (following[away[game]] == game)]
        yield ready
        np.add.at(heads, home[ready], 1)
        np.add.at(heads, away[ready], 1)
        following[waiting] = -1
        waiting = waiting[heads[waiting] < ends[waiting]]


def _rate(batches):
    import numpy as np
    import pandas as pd
    number: dict = {}
    rating, season_of = np.zeros(0), np.zeros(0, np.int64)

    for pdf in batches:
        if "_rating" in pdf:
            # ratings that games before these left behind: they sort before all games
            saved = pdf["_rating"].notna().to_numpy()
            for lg, team, value, year in pdf.loc[saved, [config.LEAGUE, "HOME_TEAM_ID", "_rating", "SEASON"]].itertuples(index=False):
                number[(lg, team)] = len(number)
                rating, season_of = np.append(rating, value), np.append(season_of, year)
            pdf = pdf[~saved]
            if not len(pdf):
                continue
        league, season = pdf[config.LEAGUE].to_numpy(), pdf["SEASON"].to_numpy().astype(np.int64)
        n, won = len(pdf), pdf[config.LABEL].to_numpy().astype(float)
        keys = pd.MultiIndex.from_arrays([np.concatenate((league, league)), np.concatenate(
            (pdf["HOME_TEAM_ID"].to_numpy(), pdf["VISITOR_TEAM_ID"].to_numpy()))])
        code, teams = pd.factorize(keys)
        slots = np.array([number.setdefault(t, len(number)) for t in teams], np.int64)[code]
        fresh = len(number) - len(rating)
        rating = np.concatenate((rating, np.full(fresh, config.ELO_INITIAL)))
        season_of = np.concatenate((season_of, np.full(fresh, np.iinfo(np.int64).min)))
        home, away = slots[:n], slots[n:]
        before, after, prob = np.empty((2, n)), np.empty((2, n)), np.empty(n)
        for game in rounds(home, away, len(number)):
            year = season[game]
            for side, team in enumerate((home[game], away[game])):
                # part of the way back to the start, on a team's first game of another season
                new = (season_of[team] != year) & (season_of[team] != np.iinfo(np.int64).min)
                gap = rating[team] - config.ELO_INITIAL
                before[side, game] = np.where(new, config.ELO_INITIAL + config.ELO_SEASON_REGRESS * gap, rating[team])
            prob[game] = 1.0 / (1.0 + np.power(10.0, (before[1, game] - before[0, game] - config.ELO_HOME_ADVANTAGE) / 400.0))
            gain = config.ELO_K * (won[game] - prob[game])
            after[0, game], after[1, game] = before[0, game] + gain, before[1, game] - gain
            for side, team in enumerate((home[game], away[game])):
                rating[team], season_of[team] = after[side, game], year
        yield pd.DataFrame({"GAME_ID": pdf["GAME_ID"], "home_elo_pre": before[0], "away_elo_pre": before[1],
                            "elo_prob_home": prob, "diff_elo": before[0] - before[1],
                            "home_elo_post": after[0], "away_elo_post": after[1]})


def with_league(games: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """``games`` with a LEAGUE column: the one it has, or the connected
    component of its teams (named by the smallest team id).  ``saved``: teams of
    earlier games and their LEAGUE, which new games may connect."""
    if config.LEAGUE in games.columns:
        return games
    met = games.select(F.col("HOME_TEAM_ID").alias("a"), F.col("VISITOR_TEAM_ID").alias("b")).distinct()
    if saved is not None:  # a league's name is one of its teams
        met = met.union(saved.select("team", config.LEAGUE))
    found = components(met).select(F.col("node").alias("_team"), F.col("root").alias("_root"))
    return (games.join(found, games["HOME_TEAM_ID"] == found["_team"], "left")
            .withColumn(config.LEAGUE, F.coalesce("_root", "HOME_TEAM_ID").cast("bigint")).drop("_team", "_root"))


def elo_ratings(games: DataFrame, saved: DataFrame | None = None, count: int | None = None) -> DataFrame:
    """-> GAME_ID, home/away pre-game rating, expectation, difference (no home
    advantage), and post-game ratings (for the as-of state table).  ``saved``: (team,
    elo_post, SEASON) left behind by earlier games.  ``count``: of the games, else counted."""
    count = games.count() if count is None else count
    rows = with_league(games).select(*NEEDED)
    if saved is not None:
        sides = rows.select(config.LEAGUE, F.explode(F.array("HOME_TEAM_ID", "VISITOR_TEAM_ID")).alias("team")).distinct()
        known = sides.join(saved.select("team", "elo_post", "SEASON"), "team").select(
            config.LEAGUE, F.col("team").alias("HOME_TEAM_ID"), F.col("elo_post").alias("_rating"), "SEASON")
        rows = rows.withColumn("_rating", F.lit(None).cast("double")).unionByName(known, allowMissingColumns=True)
    ordered = segments.spread(rows, count, config.LEAGUE).sortWithinPartitions("GAME_DATE_EST", "GAME_ID")  # nulls first
    return ordered.mapInPandas(_rate, ELO_SCHEMA)


def with_elo(games: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Games plus the Elo columns, joined on GAME_ID: only the seven columns of
    the recurrence pass through Python, so a large league pulls no whole rows
    into one task."""
    g = with_league(games)
    return g.join(elo_ratings(g, saved), "GAME_ID")
