"""Leakage audits as Spark jobs (each reports violations; zero is a pass)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators import elo as elo_ops
from ..operators import features as feat
from ..operators import ordered, profile, segments, state
from ..session import shuffles_dropped

# Games that one round of the parity audit serves and compares: what lies on disk beside
# the saved state follows this, not the table.  Teams of a round that are sent to all tasks.
GAMES_PER_ROUND = 1 << 22
TEAMS_PER_ROUND = 1 << 20


def cold_start(games: DataFrame, features: DataFrame) -> DataFrame:
    """Every team's first game has the initial Elo for that team's side."""
    firsts = profile.first_games(games).select("team", "GAME_ID")
    j = firsts.join(features.select("GAME_ID", "HOME_TEAM_ID", "home_elo_pre", "away_elo_pre"), "GAME_ID")
    elo_pre = F.when(F.col("team") == F.col("HOME_TEAM_ID"), F.col("home_elo_pre")).otherwise(
        F.col("away_elo_pre"))
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("teams_checked"),
                 F.sum((elo_pre != F.lit(config.ELO_INITIAL)).cast("long")).cast("bigint").alias("violations"))


def differing(a: DataFrame, b: DataFrame, cols: list[str], within: float = 1e-9) -> DataFrame:
    """GAME_ID and differs (boolean) for every game of either table: one full
    join, nulls equal to nulls, a game that one table lacks differs.  ``within``
    is the relative difference that the order of floating-point sums may make."""
    left = a.select(F.col("GAME_ID").alias("_l"), *[F.col(c).cast("double").alias(f"l_{c}") for c in cols])
    right = b.select(F.col("GAME_ID").alias("_r"), *[F.col(c).cast("double").alias(f"r_{c}") for c in cols])
    same = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    for c in cols:
        x, y = F.col(f"l_{c}"), F.col(f"r_{c}")
        near = F.abs(x - y) <= within * F.greatest(F.lit(1.0), F.abs(x), F.abs(y))
        same = same & F.coalesce(near, x.isNull() & y.isNull())
    return left.join(right, F.col("_l") == F.col("_r"), "full").select(
        F.coalesce("_l", "_r").alias("GAME_ID"), (~same).alias("differs"))


def _count(flag) -> F.Column:
    return F.coalesce(F.sum(flag.cast("long")), F.lit(0)).cast("bigint")


def _served(state_: state.State, teams: DataFrame) -> state.State:
    """The states of ``teams`` and of their pairs."""
    def of(df: DataFrame, key: str) -> DataFrame:
        return df.join(F.broadcast(teams.withColumnRenamed("team", key)), key, "left_semi").select(*df.columns)
    return state.State(of(state_.team, "team"), of(state_.pair, "_lo"), of(state_.team_last, "team"), of(state_.pair_last, "_lo"))


def _parity(games: DataFrame, served: state.State, bulk: bool) -> DataFrame:
    f = feat.build_features(games)
    req = games.select(F.col("GAME_ID").alias("REQUEST_ID"), "GAME_ID", "GAME_DATE_EST", "SEASON",
                       "HOME_TEAM_ID", "VISITOR_TEAM_ID")
    # by the request's id, by which its features lie dealt like the games'
    a = state.asof_features(req, served, bulk=bulk).withColumn("GAME_ID", F.col("REQUEST_ID"))
    return differing(a, f, feat.feature_names()).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_checked"), _count(F.col("differs")).alias("differing"))


def parity(games: DataFrame, served: state.State | None = None, bulk: bool = True) -> DataFrame:
    """Train/serve parity: the as-of state served for every historical game
    (as a request with its own date and id) equals its pre-game features.
    Many games are compared in rounds of whole leagues, closed sets of teams that no
    other game reaches; what a round shuffles goes with it.
    -> rows_checked, differing"""
    games = elo_ops.with_league(games)
    served = served or state.build_state(games)
    rounds = -(-games.count() // GAMES_PER_ROUND)
    if rounds <= 1:
        return _parity(games, served, bulk)
    spark = games.sparkSession
    turn = F.pmod(F.xxhash64(config.LEAGUE), F.lit(rounds))
    found = []
    with shuffles_dropped(spark):
        for k in range(rounds):
            part = games.filter(turn == k)
            teams = ordered.kept(segments.sides(part).distinct())
            own = _served(served, teams) if teams.count() <= TEAMS_PER_ROUND else served
            found.append(_parity(part, own, bulk).first())
    return spark.createDataFrame([(sum(r.rows_checked for r in found), sum(r.differing for r in found))], "rows_checked bigint, differing bigint")


def synthetic_next_game(games: DataFrame) -> DataFrame:
    """A future game after the last one: next day, the last game's teams,
    latest season, no points, placeholder label 0."""
    last = games.orderBy(F.col("GAME_DATE_EST").desc(), F.col("GAME_ID").desc()).limit(1)
    max_season = games.select(F.max("SEASON")).scalar()
    row = last.select(
        F.lit(config.SYNTHETIC_GAME_ID).cast(games.schema["GAME_ID"].dataType).alias("GAME_ID"),
        F.date_add("GAME_DATE_EST", 1).alias("GAME_DATE_EST"), max_season.cast("int").alias("SEASON"),
        "HOME_TEAM_ID", "VISITOR_TEAM_ID", *([config.LEAGUE] if config.LEAGUE in games.columns else []),
        F.lit(None).cast("double").alias("PTS_home"), F.lit(None).cast("double").alias("PTS_away"),
        F.lit(0).alias(config.LABEL))
    return row


def append_invariance(games: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Appending a future game changes no existing row's features, and the
    appended game gets a row.
    -> rows_checked, existing_rows_changed, synthetic_rows"""
    before = feat.build_features(games) if before is None else before
    extended = games.unionByName(synthetic_next_game(games), allowMissingColumns=True)
    synthetic = F.col("GAME_ID") == config.SYNTHETIC_GAME_ID
    return differing(before, feat.build_features(extended), feat.feature_names()).agg(
        _count(~synthetic).alias("rows_checked"), _count(~synthetic & F.col("differs")).alias("existing_rows_changed"),
        _count(synthetic).alias("synthetic_rows"))


def counterfactual(games: DataFrame) -> DataFrame:
    """Swap the points and flip the label of a mid-history game whose teams
    both played before: its own feature row must not change, and some later
    game of one of its teams must.

    A game reaches no further than its league, a closed set of teams, so the
    features of that league alone are built twice; a semi-join proves that no game
    outside has one of its teams.
    -> target_game, own_row_changed, later_rows_changed, linked_outside"""
    games = elo_ops.with_league(games)
    cands = profile.not_first_games(games)
    pos = ordered.kept(ordered.row_index_by_date(cands.select(
        "GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID", config.LEAGUE), ["GAME_DATE_EST", "GAME_ID"], "_i"))
    target = pos.filter(F.col("_i") == pos.count() // 2).first()
    t = F.col("GAME_ID") == F.lit(target["GAME_ID"])
    inside = F.col(config.LEAGUE).eqNullSafe(F.lit(target[config.LEAGUE]))
    league = games.filter(inside)
    swap = {"PTS_home": F.col("PTS_away"), "PTS_away": F.col("PTS_home"), config.LABEL: F.lit(1) - F.col(config.LABEL)}
    flipped = league.select(*[F.when(t, swap[c]).otherwise(F.col(c)).alias(c) if c in swap else F.col(c) for c in games.columns])
    d = differing(feat.build_features(league), feat.build_features(flipped), feat.feature_names())
    teams = [target["HOME_TEAM_ID"], target["VISITOR_TEAM_ID"]]
    dated = league.select("GAME_ID", ((F.col("GAME_DATE_EST") > F.lit(target["GAME_DATE_EST"])) & (
        F.col("HOME_TEAM_ID").isin(teams) | F.col("VISITOR_TEAM_ID").isin(teams))).alias("later"))
    both = F.explode(F.array("HOME_TEAM_ID", "VISITOR_TEAM_ID")).alias("team")
    own = league.select(both).distinct()
    linked = games.filter(~inside).select(both).join(own, "team", "left_semi").agg(F.count(F.lit(1))).first()[0]
    return d.join(dated, "GAME_ID").agg(
        F.lit(target["GAME_ID"]).cast("bigint").alias("target_game"), _count(t & F.col("differs")).alias("own_row_changed"),
        _count(F.col("later") & F.col("differs")).alias("later_rows_changed"), F.lit(linked).cast("bigint").alias("linked_outside"))
