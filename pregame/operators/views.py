"""Game <-> team-game reshaping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config

def advanced_stats_present(games: DataFrame) -> list[str]:
    return [name for name, (h, a) in config.ADVANCED_STATS.items()
            if h in games.columns and a in games.columns]


def team_game_view(games: DataFrame, advanced: bool = False, pairs: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """One row per (game, side): both sides come out of one scan through
    ``inline(array(home, away))`` -- no union, no second read.

    A side's values are one table: output -> (home side's column, away side's
    column), from which both sides are made.  ``win`` is the label for the home row
    and 1 - label for the away row; ``pt_diff`` = points for - points against.  With
    ``advanced`` the box-score stats present in the table are carried per side too,
    and ``pairs`` adds further such columns.
    """
    stats = advanced_stats_present(games) if advanced else []
    label, lit = F.col(config.LABEL), F.lit
    of = {k: (F.col(h), F.col(a)) for k, (h, a) in {
        **{s: config.ADVANCED_STATS[s] for s in stats}, **(pairs or {}),
        "pts_for": ("PTS_home", "PTS_away"), "pts_against": ("PTS_away", "PTS_home"),
        "team": ("HOME_TEAM_ID", "VISITOR_TEAM_ID"), "opponent": ("VISITOR_TEAM_ID", "HOME_TEAM_ID")}.items()}
    of |= {"is_home": (lit(1), lit(0)), "win": (label, lit(1) - label)}
    sides = F.array(*[F.struct(*[values[k].alias(name) for name, values in of.items()]) for k in (0, 1)])
    league = [config.LEAGUE] if config.LEAGUE in games.columns else []
    return games.select("GAME_ID", "GAME_DATE_EST", "SEASON", *league, F.inline(sides)).withColumn(
        "pt_diff", F.col("pts_for") - F.col("pts_against"))
