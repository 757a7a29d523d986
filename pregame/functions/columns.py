"""Scalar column expressions (all JVM-side built-ins, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season_label(season: str | Column) -> Column:
    """2026 -> '2026-27'; the two-digit part wraps (2099 -> '2099-00')."""
    s = col_(season)
    return F.concat(s.cast("string"), F.lit("-"),
                    F.lpad(((s + 1) % 100).cast("string"), 2, "0"))


def elo_expected(home_rating: str | Column, away_rating: str | Column) -> Column:
    """Home win expectation; home advantage enters only here."""
    h, a = col_(home_rating), col_(away_rating)
    return F.lit(1.0) / (F.lit(1.0) + F.pow(
        F.lit(10.0), (a - (h + F.lit(config.ELO_HOME_ADVANTAGE))) / F.lit(400.0)))


def elo_regressed(rating: str | Column) -> Column:
    r = col_(rating)
    return F.lit(config.ELO_INITIAL) + F.lit(config.ELO_SEASON_REGRESS) * (
        r - F.lit(config.ELO_INITIAL))


def back_to_back(rest_days: str | Column) -> Column:
    """1 when the team played the day before; an unknown rest counts as 0."""
    return F.coalesce(col_(rest_days) == 1, F.lit(False)).cast("int")


def pair_low(home: str | Column, away: str | Column) -> Column:
    return F.least(col_(home), col_(away))


def pair_high(home: str | Column, away: str | Column) -> Column:
    return F.greatest(col_(home), col_(away))


def low_team_won(home: str | Column, away: str | Column, label: str | Column) -> Column:
    """1 when the lower team id of the pair won the game."""
    h, a = col_(home), col_(away)
    winner = F.when(col_(label) == 1, h).otherwise(a)
    return (winner == F.least(h, a)).cast("int")


def home_view(rate_of_low: str | Column, home: str | Column, away: str | Column) -> Column:
    """Flip a pair rate stored for the lower id into the home side's view."""
    r = col_(rate_of_low)
    return F.when(col_(home) == F.least(col_(home), col_(away)), r).otherwise(F.lit(1.0) - r)


def decision(prob: str | Column) -> Column:
    """Single place where a probability becomes a 0/1 decision (>= threshold)."""
    return (col_(prob) >= F.lit(config.DECISION_THRESHOLD)).cast("int")


def winner_name(prob: str | Column) -> Column:
    return F.when(col_(prob) >= F.lit(config.DECISION_THRESHOLD), F.lit("home")).otherwise(
        F.lit("away"))


def label_name(label: str | Column) -> Column:
    return F.when(col_(label) == 1, F.lit("home win")).otherwise(F.lit("away win"))


def strip_text(c: str | Column) -> Column:
    """Python-style strip(): remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def is_digits(c: str | Column) -> Column:
    return col_(c).rlike(r"^[0-9]+$")


def season_opening_date(season: str | Column) -> Column:
    return F.make_date(col_(season), F.lit(config.SEASON_OPENING_MONTH),
                       F.lit(config.SEASON_OPENING_DAY))
