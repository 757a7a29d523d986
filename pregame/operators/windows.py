"""Prior-only per-team windows (the leakage-free feature core).

Every frame ends at ``-1`` (the row before the current game) over the total
order (GAME_DATE_EST, GAME_ID), so a game's own result never reaches its own
features and same-day ties are broken the same way in every run.

All team windows share one partitioning (team), so Catalyst plans one shuffle
and one sort for the whole family; the season / venue windows refine the
partition key, which adds a sort but no shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from . import segments
from .ordered import kept

ORDER = ("GAME_DATE_EST", "GAME_ID")
ROLL_STATS = ("win", "pts_for", "pts_against", "pt_diff")


def by_team(*extra: str) -> Window:
    return Window.partitionBy("team", *extra).orderBy(*ORDER)


def rolling_name(stat: str, n: int) -> str:
    return f"winrate_last{n}" if stat == "win" else f"{stat}_last{n}"


def rolling_columns(stats=ROLL_STATS, windows=config.ROLL_WINDOWS, upto: int = -1,
                    base: Window | None = None) -> list[Column]:
    """Mean of the previous n games (>= 1 non-null value, else null).

    ``upto=-1`` gives the pre-game value; ``upto=0`` the value after the game
    (used by the as-of state table).  ``base``: the ordered window (default:
    the team's whole series; ``segments.window`` for the split layout).
    """
    base = base or by_team()
    out = []
    for n in windows:
        frame = base.rowsBetween(upto - n + 1, upto)
        for s in stats:
            out.append(F.avg(F.col(s)).over(frame).alias(rolling_name(s, n)))
    return out


def ewma_through(df: DataFrame, key: list[str], pos: str, value: str = "pt_diff", times: str | None = None,
                 whole: Window | None = None) -> DataFrame:
    """Adds _ew_now: at rows that have a value, the adjusted EWMA (alpha = 1/3,
    weights by position) of the series up to and including the row; and _ew_weight,
    the sum of its weights as seen from the row (1 for the row itself).

    Weights grow by 1/decay from a block's start, so a running sum inside the
    block is the weighted sum up to a factor that cancels.  Blocks of twice the
    lookback come in two layers, half a block apart; each row takes the layer in
    which at least the lookback lies before it.  ``pos`` numbers the rows of a
    series without gaps.  ``times``: a column of what a row counts (one otherwise).
    ``whole``: the ordered window of series of at most EWMA_WHOLE rows each; they are
    one block, and need no sort besides that window's.
    """
    back, block = config.EWMA_LOOKBACK, 2 * config.EWMA_LOOKBACK
    x = F.col(value).cast("double")

    def layer(place, base):
        weight = F.pow(F.lit(1.0 / config.EWMA_DECAY), place)
        own = weight * F.col(times) if times else weight
        w = base.rowsBetween(Window.unboundedPreceding, 0)
        total = F.sum(F.when(x.isNotNull(), own)).over(w)
        return F.try_divide(F.sum(x * own).over(w), total), F.coalesce(total, F.lit(0.0)) / weight

    if whole is not None:
        now, total = layer(F.col(pos), whole)
    else:
        places = [F.col(pos) + shift for shift in (0, back)]
        layers = [layer(F.pmod(at, F.lit(block)), Window.partitionBy(*key, F.floor(at / block)).orderBy(pos)) for at in places]
        now, total = (F.when(F.pmod(F.col(pos), F.lit(block)) >= back, a).otherwise(b) for a, b in zip(*layers))
    return df.withColumns({"_ew_now": F.when(x.isNotNull(), now), "_ew_weight": total})


def with_ewma(df: DataFrame, value: str = "pt_diff", upto: int = -1, name: str = "form_ptdiff_ewma",
              whole: bool = False) -> DataFrame:
    """Adds the EWMA of the games before the row (``upto=-1``) or through it
    (0).  Missing values decay all weights alike and add nothing, exactly like
    pandas' ``ewm(adjust=True, ignore_na=False)``: the average at a row is that
    at the last row with a value, however long ago.  ``whole``: no series has more
    than EWMA_WHOLE rows."""
    d = ewma_through(df.withColumn("_pos", F.row_number().over(by_team())), ["team"], "_pos", value,
                     whole=by_team() if whole else None)
    seen = by_team().rowsBetween(Window.unboundedPreceding, upto)
    return d.withColumn(name, F.last("_ew_now", ignorenulls=True).over(seen)).drop("_pos", "_ew_now", "_ew_weight")


def rest_columns(base: Window | None = None) -> list[Column]:
    prev = F.lag("GAME_DATE_EST", 1).over(base or by_team())
    rest = F.datediff(F.col("GAME_DATE_EST"), prev)
    return [rest.alias("rest_days"), C.back_to_back(rest).alias("back_to_back")]


def season_winrate_column(upto: int = -1) -> Column:
    frame = by_team("SEASON").rowsBetween(Window.unboundedPreceding, upto)
    return F.avg("win").over(frame).alias("season_winrate")


def venue_winrate_column(upto: int = -1) -> Column:
    """Off the season's window, so that it needs no sort of its own."""
    frame = by_team("SEASON").rowsBetween(Window.unboundedPreceding, upto)
    home = F.col("is_home") == 1
    at_home, away = (F.avg(F.when(side, F.col("win"))).over(frame) for side in (home, ~home))
    return F.when(home, at_home).otherwise(away).alias("venue_winrate")


def engineered_names(extra_stats=()) -> list[str]:
    names = [rolling_name(s, n) for n in config.ROLL_WINDOWS for s in ROLL_STATS + tuple(extra_stats)]
    return names + ["rest_days", "back_to_back", "form_ptdiff_ewma", "season_winrate",
                    "venue_winrate"]


def team_features(long: DataFrame, extra_stats=(), split: bool | None = None, longest: int | None = None, rows: int | None = None) -> DataFrame:
    """All 13 per-team pre-game values (plus rolling means of optional stats).

    ``split``: computed on bounded segments of each team's series (see
    ``segments``): no window group is larger than a segment, however many rows
    one team has.  ``split=False`` is for series that fit a task: one shuffle, two
    sorts, nothing written.  By default the longest series (``longest``, else
    counted) says which.  The values are the same.  ``rows``: of ``long``, else counted.
    """
    stats = ROLL_STATS + tuple(extra_stats)
    if split is None:
        if longest is None:
            longest, rows = segments.extent(long, "team")
        split = longest > segments.CHUNK_ROWS
    if not split:
        rows = long.count() if rows is None else rows
        d = segments.spread(long.filter(F.col("team").isNotNull()), rows, "team").select("*", *rolling_columns(stats), *rest_columns())
        d = with_ewma(d, whole=longest is not None and longest <= config.EWMA_WHOLE)
        return d.select("*", season_winrate_column(), venue_winrate_column())
    win, home = F.col("win"), F.col("is_home") == 1
    seen = F.when(win.isNotNull(), 1).otherwise(0)
    rows = segments.numbered(long, ["team"], list(ORDER), {
        "s": win, "n": seen,
        "hs": F.when(home, win), "hn": F.when(home, seen),
        "as": F.when(~home, win), "an": F.when(~home, seen)}, inner="SEASON")
    seg = segments.segment(rows, halo=2 * config.EWMA_LOOKBACK)
    w = segments.window(["team"])
    seg = seg.select("*", *rolling_columns(stats, base=w), *rest_columns(base=w))
    # kept: read for the carry between segments and for the rows
    seg = kept(ewma_through(seg, ["team", "_seg"], "_pos"))
    seg = segments.prior_last(seg, ["team"], "_ew_now", "form_ptdiff_ewma")

    def rate(num, den):
        return F.when(F.col(den) > 0, F.col(num) / F.col(den))
    venue = F.when(home, rate("_p_hs", "_p_hn")).otherwise(rate("_p_as", "_p_an"))
    out = seg.filter(~F.col("_halo")).withColumn("season_winrate", rate("_p_s", "_p_n")) \
        .withColumn("venue_winrate", venue)
    return out.drop("_pos", "_seg", "_halo", "_ew_now", "_ew_weight", *[c for c in out.columns if c.startswith("_p_")])


def with_head_to_head(games: DataFrame, split: bool | None = None, rows: int | None = None) -> DataFrame:
    """Games plus h2h_home_winrate: the prior win rate of the pair's lower id
    over all earlier meetings (no season limit), flipped to the home side's view.
    ``split``: each pair's series is cut by months (``segments``); by default if a
    team has more games than a segment holds rows.  ``rows``: of ``games``, else counted."""
    if split is None:
        most, both = segments.extent(segments.sides(games), "team")
        split, rows = most > segments.CHUNK_ROWS, both // 2
    lo = C.pair_low("HOME_TEAM_ID", "VISITOR_TEAM_ID")
    hi = C.pair_high("HOME_TEAM_ID", "VISITOR_TEAM_ID")
    won = C.low_team_won("HOME_TEAM_ID", "VISITOR_TEAM_ID", config.LABEL)
    if not split:
        w = Window.partitionBy("_lo", "_hi").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
        rate = F.avg(won).over(w)
        rows = games.count() if rows is None else rows
        g = segments.spread(games.filter(lo.isNotNull()).withColumns({"_lo": lo, "_hi": hi}), rows, "_lo", "_hi")
        return g.withColumn("h2h_home_winrate", C.home_view(rate, "HOME_TEAM_ID", "VISITOR_TEAM_ID")).drop("_lo", "_hi")
    g = games.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_won", won)
    g = segments.numbered(g, ["_lo", "_hi"], list(ORDER), {"w": F.col("_won"), "n": F.lit(1)})
    rate = F.when(F.col("_p_n") > 0, F.col("_p_w") / F.col("_p_n"))
    return g.select(*games.columns, C.home_view(rate, "HOME_TEAM_ID", "VISITOR_TEAM_ID").alias("h2h_home_winrate"))
