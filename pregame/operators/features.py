"""Assemble the one-row-per-game pre-game feature table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from . import elo as elo_ops
from . import segments, views, windows

ELO_COLUMNS = ["home_elo_pre", "away_elo_pre", "elo_prob_home", "diff_elo"]
NO_DIFF = {"back_to_back"}


def side_feature_names(engineered: list[str]) -> list[str]:
    out = []
    for c in engineered:
        out += [f"home_{c}", f"away_{c}"]
        if c not in NO_DIFF:
            out.append(f"diff_{c}")
    return out


def feature_names(advanced_stats=()) -> list[str]:
    eng = windows.engineered_names(advanced_stats)
    return side_feature_names(eng) + ["h2h_home_winrate"] + ELO_COLUMNS


def feature_columns(df: DataFrame) -> list[str]:
    """Everything except the base columns (ids, date, season, label, league)."""
    exclude = set(config.BASE_COLUMNS) | {config.LEAGUE}
    return [c for c in df.columns if c not in exclude]


def pivot_sides(long_features: DataFrame, engineered: list[str]) -> DataFrame:
    """Home and away rows of a game back into one row: one groupBy(GAME_ID)
    with a conditional struct per side (single shuffle, partial aggregation),
    instead of two filtered copies joined together."""
    packed = F.struct(*[F.col(c) for c in engineered])
    home = F.max(F.when(F.col("is_home") == 1, packed)).alias("_h")
    away = F.max(F.when(F.col("is_home") == 0, packed)).alias("_a")
    return long_features.groupBy("GAME_ID").agg(home, away)


def build_features(games: DataFrame, advanced: bool = False, split: bool | None = None) -> DataFrame:
    """Pre-game features for every game of a cleaned games table (one row per
    GAME_ID).

      games -> Elo (a narrow fold per league)
            -> head-to-head rate (narrow rows of the pair)
            -> team-game view -> prior-only team windows (narrow rows of the team)
            -> all of them, and the games' own columns, meet in one shuffle by
               GAME_ID and one aggregate.
    ``split``: team and pair series run on bounded stretches (``segments``), so
    no key, however hot, becomes one task; False is the plain layout for short series
    (same values).  By default the games of the busiest team say which.
    """
    games = elo_ops.with_league(games)
    if split is None:
        longest, both = segments.extent(segments.sides(games), "team")
        split = longest > segments.CHUNK_ROWS
    else:
        longest, both = None, 2 * games.count()
    stats = views.advanced_stats_present(games) if advanced else []
    eng = windows.engineered_names(stats)
    base = [c for c in config.BASE_COLUMNS + [config.LEAGUE] if c != "GAME_ID"]
    lf = windows.team_features(views.team_game_view(games, advanced=advanced), stats, split=split, longest=longest, rows=both)
    meetings = games.select("GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID", config.LABEL)
    pair = windows.with_head_to_head(meetings, split=split, rows=both // 2)
    side = F.struct(*eng)
    parts = [
        games.select("GAME_ID", F.struct(*base).alias("_g")),
        elo_ops.elo_ratings(games, count=both // 2).select("GAME_ID", F.struct(*ELO_COLUMNS).alias("_e")),
        pair.select("GAME_ID", F.col("h2h_home_winrate").alias("_r")),
        lf.select("GAME_ID", F.when(F.col("is_home") == 1, side).alias("_h"), F.when(F.col("is_home") == 0, side).alias("_a")),
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    # clustered and sorted by game once; each column has a value in one row of a game
    whole = segments.spread(every, both, "GAME_ID").groupBy("GAME_ID").agg(*[F.max(c).alias(c) for c in ("_g", "_e", "_r", "_h", "_a")])
    cols = []
    for c in eng:
        h, a = F.col(f"_h.{c}"), F.col(f"_a.{c}")
        cols += [h.alias(f"home_{c}"), a.alias(f"away_{c}")]
        if c not in NO_DIFF:
            cols.append((h - a).alias(f"diff_{c}"))
    own = [F.col("GAME_ID") if c == "GAME_ID" else F.col(f"_g.{c}").alias(c) for c in config.BASE_COLUMNS + [config.LEAGUE]]
    return whole.select(*own, *cols, F.col("_r").alias("h2h_home_winrate"), *[F.col(f"_e.{c}").alias(c) for c in ELO_COLUMNS])


def warmup_drop(features: DataFrame) -> DataFrame:
    """Drop games where a side has no prior game at all (diff_winrate_* null)."""
    keys = [c for c in feature_columns(features) if c.startswith("diff_winrate")]
    return features.dropna(subset=keys)


def time_split(df: DataFrame, cut: int = config.TEST_SEASON_START):
    """Train = seasons before the cut, test = the cut and later (never random).
    With the feature table written partitioned by SEASON, each side reads
    only its own season folders."""
    return df.filter(F.col("SEASON") < cut), df.filter(F.col("SEASON") >= cut)
