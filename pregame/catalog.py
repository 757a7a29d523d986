"""Registered queries: key -> (Spark callable, oracle SQL or None).

Every query reads the driver's tables (``sf_dir``) and derives the games
from them, so its work grows with the data.  Doubles are rounded to 6 places
at the very end (comparison only; the library keeps full precision).
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import config
from . import oracle as O
from .operators import clean, elo, features, ordered, segments, state, views, windows
from .sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def round6(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.round(F.col(f.name), O.R) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---- shared building blocks -------------------------------------------------

def raw_games(spark, sf_dir):
    return tables.games_from_tables(spark, sf_dir)


_GAMES: dict = {}


def clean_games(spark, sf_dir):
    """The cleaned games table, derived from the driver's tables once per
    session and kept (memory, spilling to disk) as the pipeline's input
    table -- every query starts from it."""
    from pyspark import StorageLevel
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GAMES:
        _GAMES[key] = clean.clean_games(raw_games(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    return _GAMES[key]


_TEAMS: dict = {}


def teams_table(spark, sf_dir):
    """The team dimension, derived once per session and kept (it is read by
    every resolution and naming step of the scoring queries) in as many parts as
    its rows call for: a name's aliases and stretches are made where it lies, and a
    file of a million teams is one or two splits."""
    from pyspark import StorageLevel
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TEAMS:
        teams = tables.teams_from_tables(spark, sf_dir)
        _TEAMS[key] = segments.spread(teams, tables.read_table(spark, sf_dir, "customer").count(), "TEAM_ID").persist(StorageLevel.MEMORY_AND_DISK)
    return _TEAMS[key]


_STATE: dict = {}


def state_tables(spark, sf_dir):
    """The saved state tables of the games, written once per session to the
    shared folder; every scoring query reads them."""
    from .sources import sinks
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STATE:
        path = sinks.scratch_path(spark, "state")
        state.save_state(clean_games(spark, sf_dir), path)
        _STATE[key] = state.read_state(spark, path)
    return _STATE[key]


def feature_table(spark, sf_dir):
    return features.build_features(clean_games(spark, sf_dir))


def read_back(df, path):
    """``df``, read from the scratch folder ``path``, computed; the folder goes."""
    from .sources import sinks
    out = ordered.kept(df)
    sinks.remove(df.sparkSession, path)
    return out


GAME_COLS = ["GAME_ID", "GAME_DATE_EST", "SEASON", "LEAGUE", "HOME_TEAM_ID", "VISITOR_TEAM_ID",
             "PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "AST_home", "AST_away",
             "HOME_TEAM_WINS"]
GAME_DOUBLES = {"PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "AST_home", "AST_away"}


# ---- S: scans ---------------------------------------------------------------

@register("scan_games", O.with_(O.GAMES_RAW) + f"SELECT {O.round_all(GAME_COLS, GAME_DOUBLES)} FROM games_raw")
def q_scan_games(spark, sf_dir):
    return round6(raw_games(spark, sf_dir))


TEAM_COLS = ["TEAM_ID", "ABBREVIATION", "NICKNAME", "CITY", "FULL_NAME"]


@register("scan_teams", O.with_(O.TEAMS) + "SELECT * FROM teams")
def q_scan_teams(spark, sf_dir):
    return tables.teams_from_tables(spark, sf_dir)


# ---- F: cleaning ------------------------------------------------------------

@register("clean_games", O.with_(O.GAMES_RAW, O.CLEAN) + f"SELECT {O.round_all(GAME_COLS, GAME_DOUBLES)} FROM clean")
def q_clean_games(spark, sf_dir):
    return round6(clean_games(spark, sf_dir))


@register("clean_counts", O.with_(O.GAMES_RAW) + """
SELECT CAST(count(*) AS BIGINT) AS rows_in,
       CAST(sum(CASE WHEN GAME_DATE_EST IS NULL OR HOME_TEAM_ID IS NULL OR VISITOR_TEAM_ID IS NULL OR SEASON IS NULL
                 OR PTS_home IS NULL OR PTS_away IS NULL OR HOME_TEAM_WINS IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS rows_kept,
       CAST(sum(CASE WHEN GAME_DATE_EST IS NULL OR HOME_TEAM_ID IS NULL OR VISITOR_TEAM_ID IS NULL OR SEASON IS NULL
                 OR PTS_home IS NULL OR PTS_away IS NULL OR HOME_TEAM_WINS IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_dropped
FROM games_raw""")
def q_clean_counts(spark, sf_dir):
    return clean.clean_counts(raw_games(spark, sf_dir))


@register("dedup_games", O.with_(O.GAMES_RAW) + f"""
, dups AS (
  SELECT *, 0 AS INGEST_SEQ FROM games_raw
  UNION ALL
  SELECT * REPLACE (PTS_home + 1 AS PTS_home), 1 AS INGEST_SEQ FROM games_raw WHERE GAME_ID % 50 = 0
), kept AS (
  SELECT * FROM dups
  WHERE GAME_DATE_EST IS NOT NULL AND HOME_TEAM_ID IS NOT NULL AND VISITOR_TEAM_ID IS NOT NULL
    AND SEASON IS NOT NULL AND PTS_home IS NOT NULL AND PTS_away IS NOT NULL AND HOME_TEAM_WINS IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY GAME_ID ORDER BY INGEST_SEQ) = 1
)
SELECT {O.round_all(GAME_COLS, GAME_DOUBLES)} FROM kept""")
def q_dedup_games(spark, sf_dir):
    dups = tables.games_with_duplicates(raw_games(spark, sf_dir))
    return round6(clean.clean_games(dups))


# ---- U1 / P9-P11: team-game view ---------------------------------------------

LONG_COLS = ["GAME_ID", "GAME_DATE_EST", "SEASON", "LEAGUE", "team", "opponent", "is_home",
             "pts_for", "pts_against", "win", "pt_diff"]


@register("team_game_view", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + f"""
SELECT GAME_ID, GAME_DATE_EST, SEASON, LEAGUE, team, opponent, CAST(is_home AS INT) AS is_home,
       round(pts_for, 6) AS pts_for, round(pts_against, 6) AS pts_against, CAST(win AS INT) AS win,
       round(pt_diff, 6) AS pt_diff FROM long""")
def q_team_game_view(spark, sf_dir):
    return round6(views.team_game_view(clean_games(spark, sf_dir)).select(*LONG_COLS))


@register("advanced_boxscore", O.with_(O.GAMES_RAW, O.CLEAN) + """
, adv AS (
  SELECT GAME_ID, GAME_DATE_EST, HOME_TEAM_ID AS team, FG_PCT_home AS fg_pct, AST_home AS ast FROM clean
  UNION ALL
  SELECT GAME_ID, GAME_DATE_EST, VISITOR_TEAM_ID, FG_PCT_away, AST_away FROM clean
)
SELECT GAME_ID, team,
  round(avg(fg_pct) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS fg_pct_last5,
  round(avg(ast) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS ast_last5,
  round(avg(fg_pct) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS fg_pct_last10,
  round(avg(ast) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS ast_last10
FROM adv""")
def q_advanced_boxscore(spark, sf_dir):
    names = [windows.rolling_name(st, n) for n in config.ROLL_WINDOWS for st in ("fg_pct", "ast")]
    return round6(team_windows(spark, sf_dir, advanced=True).select("GAME_ID", "team", *names))


# ---- W: windows ---------------------------------------------------------------

def team_windows(spark, sf_dir, advanced=False):
    """Team-game view with the prior-only columns (the unused ones are pruned)."""
    g = clean_games(spark, sf_dir)
    stats = views.advanced_stats_present(g) if advanced else []
    return windows.team_features(views.team_game_view(g, advanced=advanced), stats)


ROLL_NAMES = [windows.rolling_name(s, n) for n in config.ROLL_WINDOWS for s in windows.ROLL_STATS]


@register("rolling_form", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + f"""
SELECT GAME_ID, team, CAST(is_home AS INT) AS is_home,
       {", ".join(f"round({c}, 6) AS {c}" for c in ROLL_NAMES)}
FROM (SELECT GAME_ID, team, is_home, {O._rolling_sql()} FROM long)""")
def q_rolling_form(spark, sf_dir):
    return round6(team_windows(spark, sf_dir)
                  .select("GAME_ID", "team", "is_home", *ROLL_NAMES))


@register("rest_days", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + """
SELECT GAME_ID, team, rest_days, CAST(CASE WHEN rest_days = 1 THEN 1 ELSE 0 END AS INT) AS back_to_back
FROM (SELECT GAME_ID, team,
             CAST(date_diff('day', lag(GAME_DATE_EST) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID), GAME_DATE_EST) AS INT) AS rest_days
      FROM long)""")
def q_rest_days(spark, sf_dir):
    return team_windows(spark, sf_dir).select(
        "GAME_ID", "team", "rest_days", "back_to_back")


@register("ewma_form", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + f"""
SELECT GAME_ID, team, {O.rnd(O._ewma_expr('_ew'), 'form_ptdiff_ewma')}
FROM (SELECT GAME_ID, team, list(pt_diff) OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _ew FROM long)""")
def q_ewma_form(spark, sf_dir):
    return round6(team_windows(spark, sf_dir).select(
        "GAME_ID", "team", "form_ptdiff_ewma"))


@register("season_winrate", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + """
SELECT GAME_ID, team, SEASON, round(avg(win) OVER (PARTITION BY team, SEASON ORDER BY GAME_DATE_EST, GAME_ID
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS season_winrate FROM long""")
def q_season_winrate(spark, sf_dir):
    return round6(team_windows(spark, sf_dir).select(
        "GAME_ID", "team", "SEASON", "season_winrate"))


@register("venue_winrate", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG) + """
SELECT GAME_ID, team, CAST(is_home AS INT) AS is_home, round(avg(win) OVER (PARTITION BY team, SEASON, is_home ORDER BY GAME_DATE_EST, GAME_ID
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS venue_winrate FROM long""")
def q_venue_winrate(spark, sf_dir):
    return round6(team_windows(spark, sf_dir).select(
        "GAME_ID", "team", "is_home", "venue_winrate"))


@register("head_to_head", O.with_(O.GAMES_RAW, O.CLEAN, O.H2H) +
          "SELECT GAME_ID, round(h2h_home_winrate, 6) AS h2h_home_winrate FROM h2h")
def q_head_to_head(spark, sf_dir):
    return round6(windows.with_head_to_head(clean_games(spark, sf_dir)).select("GAME_ID", "h2h_home_winrate"))


ELO_OUT = ["GAME_ID", "home_elo_pre", "away_elo_pre", "elo_prob_home", "diff_elo",
           "home_elo_post", "away_elo_post"]


@register("elo_ratings", O.with_(O.GAMES_RAW, O.CLEAN, O.ELO) +
          f"SELECT GAME_ID, {', '.join(O.rnd(c, c) for c in ELO_OUT[1:])} FROM elo")
def q_elo_ratings(spark, sf_dir):
    return round6(elo.elo_ratings(clean_games(spark, sf_dir)))


# ---- J2/J3/P18: the feature table --------------------------------------------

FEATURE_OUT = config.BASE_COLUMNS + [config.LEAGUE] + features.feature_names()
INT_FEATURES = {"home_rest_days", "away_rest_days", "diff_rest_days", "home_back_to_back",
                "away_back_to_back"}
FEATURE_DOUBLES = {c for c in features.feature_names() if c not in INT_FEATURES}


@register("build_features", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG, O.TEAMFEAT, O.H2H, O.ELO, O.FEATURES) +
          f"SELECT {O.round_all(FEATURE_OUT, FEATURE_DOUBLES)} FROM features")
def q_build_features(spark, sf_dir):
    return round6(feature_table(spark, sf_dir))


@register("warmup_drop", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG, O.TEAMFEAT, O.H2H, O.ELO, O.FEATURES, O.WARM) +
          f"SELECT {O.round_all(FEATURE_OUT, FEATURE_DOUBLES)} FROM warm")
def q_warmup_drop(spark, sf_dir):
    return round6(features.warmup_drop(feature_table(spark, sf_dir)))


@register("time_split", O.with_(O.GAMES_RAW, O.CLEAN, O.LONG, O.TEAMFEAT, O.H2H, O.ELO, O.FEATURES, O.WARM) + f"""
SELECT CASE WHEN SEASON < {config.TEST_SEASON_START} THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS games, round(avg(HOME_TEAM_WINS), 6) AS home_win_rate,
       min(SEASON) AS first_season, max(SEASON) AS last_season
FROM warm GROUP BY 1""")
def q_time_split(spark, sf_dir):
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    side = F.when(F.col("SEASON") < config.TEST_SEASON_START, "train").otherwise("test")
    return round6(warm.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).cast("bigint").alias("games"), F.avg(config.LABEL).alias("home_win_rate"),
        F.min("SEASON").alias("first_season"), F.max("SEASON").alias("last_season")))


# ---- A: profiling aggregates ---------------------------------------------------

from .operators import metrics, profile  # noqa: E402

CLEAN_SQL = O.with_(O.GAMES_RAW, O.CLEAN)
FEAT_SQL = O.with_(O.GAMES_RAW, O.CLEAN, O.LONG, O.TEAMFEAT, O.H2H, O.ELO, O.FEATURES, O.WARM)


@register("label_distribution", CLEAN_SQL + """
SELECT CAST(HOME_TEAM_WINS AS INT) AS label,
       CASE WHEN HOME_TEAM_WINS = 1 THEN 'home win' ELSE 'away win' END AS outcome,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM clean GROUP BY HOME_TEAM_WINS""")
def q_label_distribution(spark, sf_dir):
    return round6(profile.label_distribution(clean_games(spark, sf_dir)))


@register("season_summary", CLEAN_SQL + """
SELECT SEASON, CAST(count(*) AS BIGINT) AS games, round(avg(HOME_TEAM_WINS), 6) AS home_win_rate
FROM clean GROUP BY SEASON""")
def q_season_summary(spark, sf_dir):
    return round6(profile.season_summary(clean_games(spark, sf_dir)))


def _null_profile_sql(cols: list[str], table: str) -> str:
    sel = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}" for c in cols)
    return (f"SELECT name AS \"column\", round(null_share, 6) AS null_share FROM "
            f"(UNPIVOT (SELECT {sel} FROM {table}) ON {', '.join(cols)} INTO NAME name VALUE null_share)")


@register("null_profile", FEAT_SQL + _null_profile_sql(FEATURE_OUT, "features"))
def q_null_profile(spark, sf_dir):
    return round6(profile.null_profile(feature_table(spark, sf_dir)))


@register("games_extent", CLEAN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS games, min(SEASON) AS first_season, max(SEASON) AS last_season,
       min(GAME_DATE_EST) AS first_date, max(GAME_DATE_EST) AS last_date,
       CAST(count(DISTINCT SEASON) AS BIGINT) AS seasons FROM clean""")
def q_games_extent(spark, sf_dir):
    return profile.games_extent(clean_games(spark, sf_dir))


@register("points_summary", CLEAN_SQL + """
SELECT round(avg(PTS_home), 6) AS mean_pts_home, round(avg(PTS_away), 6) AS mean_pts_away FROM clean""")
def q_points_summary(spark, sf_dir):
    return round6(profile.points_summary(clean_games(spark, sf_dir)))


def _hist_sql(side: str, c: str) -> str:
    return f"""
SELECT '{side}' AS side, bin, {O.rnd('lo + bin * width', 'lo')}, {O.rnd('lo + (bin + 1) * width', 'hi')},
       CAST(count(*) AS BIGINT) AS count, {O.rnd('count(*) / (n * width)', 'density')}
FROM (
  SELECT CAST(least(bins - 1, floor(({c} - lo) * (bins / span))) AS INT) AS bin, lo, width, n
  FROM clean, (
    SELECT *, span / bins AS width FROM (
      SELECT *, CAST(ceil(span / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) AS INT) AS bins
      FROM (
        SELECT n, lo, hi - lo AS span, (hi - lo) / (log2(n) + 1.0) AS sturges,
               2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) AS fd
        FROM (SELECT count({c}) AS n, min({c}) AS lo, max({c}) AS hi,
                     quantile_cont({c}, 0.25::DOUBLE) AS q1, quantile_cont({c}, 0.75::DOUBLE) AS q3 FROM clean))))
  WHERE {c} IS NOT NULL)
GROUP BY bin, lo, width, n"""


@register("points_histogram", CLEAN_SQL + _hist_sql("home", "PTS_home") + "\nUNION ALL\n" + _hist_sql("away", "PTS_away"))
def q_points_histogram(spark, sf_dir):
    return round6(profile.points_histogram(clean_games(spark, sf_dir)))


def _kde_sql(side: str, c: str) -> str:
    return f"""
SELECT '{side}' AS side, CAST(i AS INT) AS grid_idx, {O.rnd('start + i * step', 'x')},
       {O.rnd('sum(k * exp(-0.5 * ((start + i * step - v) / bw) * ((start + i * step - v) / bw))) / (n * bw * sqrt(2 * pi()))', 'density')}
FROM (SELECT {c} AS v, count(*) AS k FROM clean WHERE {c} IS NOT NULL GROUP BY {c}) vc,
     (SELECT *, (stop - start) / 199 AS step FROM (
        SELECT *, lo - 3.0 * bw AS start, hi + 3.0 * bw AS stop FROM (
          SELECT n, lo, hi, sd * pow(n, -0.2) AS bw FROM (
            SELECT count({c}) AS n, stddev_samp({c}) AS sd, min({c}) AS lo, max({c}) AS hi FROM clean)))) st,
     range(0, 200) g(i)
GROUP BY i, start, step, n, bw"""


@register("points_kde", CLEAN_SQL + _kde_sql("home", "PTS_home") + "\nUNION ALL\n" + _kde_sql("away", "PTS_away"))
def q_points_kde(spark, sf_dir):
    return round6(profile.points_kde(clean_games(spark, sf_dir)))


FEATURES_43 = features.feature_names()


def _corr_sql() -> str:
    sel = ", ".join(f"corr(CAST({c} AS DOUBLE), CAST(HOME_TEAM_WINS AS DOUBLE)) AS {c}" for c in FEATURES_43)
    return (f"SELECT feature, {O.rnd('r', 'r')} FROM (UNPIVOT (SELECT {sel} FROM features) ON {', '.join(FEATURES_43)} "
            f"INTO NAME feature VALUE r) WHERE r IS NOT NULL AND NOT isnan(r) "
            f"ORDER BY abs(r) DESC, feature LIMIT {config.TOP_CORRELATIONS}")


@register("feature_correlation", FEAT_SQL + _corr_sql())
def q_feature_correlation(spark, sf_dir):
    return round6(profile.feature_correlation(feature_table(spark, sf_dir), FEATURES_43))


def _linspace_sql(q: int = 10) -> str:
    import numpy as np
    return "[" + ", ".join(f"{float(p)!r}::DOUBLE" for p in np.linspace(0, 1, q + 1)) + "]"


@register("decile_rate", FEAT_SQL + f"""
, d AS (SELECT diff_season_winrate AS x, HOME_TEAM_WINS AS y FROM features WHERE diff_season_winrate IS NOT NULL),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, {_linspace_sql()}))) AS edges FROM d)
SELECT bin, {O.rnd('edges[bin]', 'lo')}, {O.rnd('edges[bin + 1]', 'hi')}, CAST(count(*) AS BIGINT) AS games,
       {O.rnd('avg(y)', 'home_win_rate')}
FROM (SELECT CAST(greatest(len(list_filter(edges, lambda v: v < x)), 1) AS INT) AS bin, y, edges FROM d, e)
GROUP BY bin, edges""")
def q_decile_rate(spark, sf_dir):
    return round6(profile.decile_rate(feature_table(spark, sf_dir)))


@register("first_games", CLEAN_SQL + """
SELECT team, GAME_ID, GAME_DATE_EST FROM (
  SELECT team, GAME_ID, GAME_DATE_EST FROM (
    SELECT HOME_TEAM_ID AS team, GAME_ID, GAME_DATE_EST FROM clean
    UNION ALL SELECT VISITOR_TEAM_ID, GAME_ID, GAME_DATE_EST FROM clean)
  QUALIFY row_number() OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID) = 1)""")
def q_first_games(spark, sf_dir):
    return profile.first_games(clean_games(spark, sf_dir))


@register("first_games_anti", CLEAN_SQL + """
SELECT GAME_ID, GAME_DATE_EST, HOME_TEAM_ID, VISITOR_TEAM_ID FROM clean
WHERE GAME_ID NOT IN (
  SELECT GAME_ID FROM (
    SELECT HOME_TEAM_ID AS team, GAME_ID, GAME_DATE_EST FROM clean
    UNION ALL SELECT VISITOR_TEAM_ID, GAME_ID, GAME_DATE_EST FROM clean)
  QUALIFY row_number() OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID) = 1)""")
def q_first_games_anti(spark, sf_dir):
    return profile.not_first_games(clean_games(spark, sf_dir)).select(
        "GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID")


# ---- E / R4: evaluation with the Elo probability as the scorer -------------------

SCORED_SQL = FEAT_SQL + f""", sc AS (
  SELECT HOME_TEAM_WINS AS y, elo_prob_home AS prob, GAME_ID FROM warm WHERE SEASON >= {config.TEST_SEASON_START})
"""


def elo_scored(spark, sf_dir):
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    _, test = features.time_split(warm)
    return test.select(F.col(config.LABEL).alias("y"), F.col("elo_prob_home").alias("prob"), "GAME_ID")


_EPS = repr(metrics.EPS)


@register("classification_metrics", SCORED_SQL + f"""
, g AS (SELECT prob AS score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY prob),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg,
             least(greatest(score, {_EPS}), 1.0 - {_EPS}) AS p FROM g),
a AS (SELECT sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.5 THEN neg ELSE 0 END) AS fp,
             sum(CASE WHEN score >= 0.5 THEN 0 ELSE pos END) AS fn, sum(CASE WHEN score >= 0.5 THEN 0 ELSE neg END) AS tn,
             sum(pos * (cum_neg + 0.5 * neg)) AS auc_num, sum(pos * -ln(p) + neg * -ln(1.0 - p)) AS ll FROM r)
SELECT CAST(tp + fp + fn + tn AS BIGINT) AS n, {O.rnd('(tp + tn) / (tp + fp + fn + tn)', 'accuracy')},
       {O.rnd('coalesce(tp / nullif(tp + fp, 0), 0.0)', 'precision')},
       {O.rnd('coalesce(tp / nullif(tp + fn, 0), 0.0)', 'recall')},
       {O.rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)', 'f1')},
       {O.rnd('auc_num / ((tp + fn) * (fp + tn))', 'roc_auc')}, {O.rnd('ll / (tp + fp + fn + tn)', 'log_loss')},
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn
FROM a""")
def q_classification_metrics(spark, sf_dir):
    return round6(metrics.classification_metrics(elo_scored(spark, sf_dir)))


@register("confusion_matrix", SCORED_SQL + """
SELECT a AS actual, b AS predicted,
       CAST((SELECT count(*) FROM sc WHERE y = a AND CAST(prob >= 0.5 AS INT) = b) AS BIGINT) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b)""")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(elo_scored(spark, sf_dir))


@register("roc_points", SCORED_SQL + """
, g AS (SELECT prob AS score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY prob),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             row_number() OVER (ORDER BY score DESC) - 1 AS i FROM g),
t AS (SELECT sum(pos) AS P, sum(neg) AS N, count(*) AS m FROM g),
k AS (SELECT c.*, lag(tp) OVER (ORDER BY i) AS tp_prev, lead(tp) OVER (ORDER BY i) AS tp_next,
             lag(fp) OVER (ORDER BY i) AS fp_prev, lead(fp) OVER (ORDER BY i) AS fp_next FROM c)
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT round(score, 6) + 0.0, round(fp / N, 6) + 0.0, round(tp / P, 6) + 0.0 FROM k, t
WHERE i = 0 OR i = m - 1 OR (fp_next - 2 * fp + fp_prev) <> 0 OR (tp_next - 2 * tp + tp_prev) <> 0""")
def q_roc_points(spark, sf_dir):
    return round6(metrics.roc_points(elo_scored(spark, sf_dir)))


@register("roc_auc", SCORED_SQL + """
, g AS (SELECT prob AS score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY prob),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM g)
SELECT round(sum(pos * (cum_neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) + 0.0 AS roc_auc FROM r""")
def q_roc_auc(spark, sf_dir):
    return round6(metrics.classification_metrics(elo_scored(spark, sf_dir)).select("roc_auc"))


def _inner_edges_sql() -> str:
    import numpy as np
    return "[" + ", ".join(f"{float(e)!r}::DOUBLE" for e in np.linspace(0, 1, config.CALIBRATION_BINS + 1)[1:-1]) + "]"


@register("calibration", SCORED_SQL + f"""
SELECT CAST(len(list_filter({_inner_edges_sql()}, lambda e: e < prob)) AS INT) AS bin,
       {O.rnd('avg(prob)', 'mean_predicted')}, {O.rnd('avg(CAST(y AS DOUBLE))', 'fraction_positive')},
       CAST(count(*) AS BIGINT) AS count
FROM sc GROUP BY 1""")
def q_calibration(spark, sf_dir):
    return round6(metrics.calibration(elo_scored(spark, sf_dir)))


@register("baselines", FEAT_SQL + f"""
, tr AS (SELECT avg(HOME_TEAM_WINS) AS rate FROM warm WHERE SEASON < {config.TEST_SEASON_START}),
te AS (SELECT HOME_TEAM_WINS AS y FROM warm WHERE SEASON >= {config.TEST_SEASON_START}),
base AS (SELECT 'always_home' AS model, 1 AS pred UNION ALL
         SELECT 'majority_class', CAST(round_even((SELECT rate FROM tr), 0) AS INT)),
cnt AS (SELECT model, sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
               sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn,
               avg(-(y * ln(least(greatest(rate, {_EPS}), 1.0 - {_EPS})) + (1 - y) * ln(1.0 - least(greatest(rate, {_EPS}), 1.0 - {_EPS})))) AS ll
        FROM base, te, tr GROUP BY model)
SELECT model, CAST(tp + fp + fn + tn AS BIGINT) AS n, {O.rnd('(tp + tn) / (tp + fp + fn + tn)', 'accuracy')},
       {O.rnd('coalesce(tp / nullif(tp + fp, 0), 0.0)', 'precision')},
       {O.rnd('coalesce(tp / nullif(tp + fn, 0), 0.0)', 'recall')},
       {O.rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)', 'f1')},
       0.5 AS roc_auc, {O.rnd('ll', 'log_loss')},
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn
FROM cnt""")
def q_baselines(spark, sf_dir):
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    return round6(metrics.baselines(warm, F.col("SEASON") >= config.TEST_SEASON_START))


@register("elo_baseline", SCORED_SQL + """
SELECT GAME_ID, round(prob, 6) + 0.0 AS home_win_prob, round(1.0 - prob, 6) + 0.0 AS away_win_prob,
       CASE WHEN prob >= 0.5 THEN 'home' ELSE 'away' END AS predicted_winner, y AS actual FROM sc""")
def q_elo_baseline(spark, sf_dir):
    from .functions import columns as C
    s = elo_scored(spark, sf_dir)
    return round6(s.select("GAME_ID", F.col("prob").alias("home_win_prob"),
                           (F.lit(1.0) - F.col("prob")).alias("away_win_prob"),
                           C.winner_name("prob").alias("predicted_winner"), F.col("y").alias("actual")))


@register("elo_expected", O.with_(O.GAMES_RAW, O.CLEAN, O.ELO) + """
SELECT GAME_ID, round(1.0 / (1.0 + pow(10.0, (away_elo_pre - (home_elo_pre + 100.0)) / 400.0)), 6) + 0.0 AS elo_expected,
       round(home_elo_pre - away_elo_pre, 6) + 0.0 AS diff_elo FROM elo""")
def q_elo_expected(spark, sf_dir):
    from .functions import columns as C
    e = elo.elo_ratings(clean_games(spark, sf_dir))
    return round6(e.select("GAME_ID", C.elo_expected("home_elo_pre", "away_elo_pre").alias("elo_expected"),
                           (F.col("home_elo_pre") - F.col("away_elo_pre")).alias("diff_elo")))


@register("season_label", CLEAN_SQL + """
SELECT s AS season, concat(CAST(s AS VARCHAR), '-', lpad(CAST((s + 1) % 100 AS VARCHAR), 2, '0')) AS season_label
FROM (SELECT DISTINCT SEASON AS s FROM clean UNION SELECT DISTINCT SEASON + 100 FROM clean)""")
def q_season_label(spark, sf_dir):
    from .functions import columns as C
    seasons = clean_games(spark, sf_dir).select(F.col("SEASON").alias("season"))
    seasons = seasons.unionByName(seasons.select((F.col("season") + 100).alias("season"))).distinct()
    return seasons.select("season", C.season_label("season").alias("season_label"))


# ---- J8 / R1 / J5-J7: requests, resolution, as-of features -------------------------

from .operators import resolve  # noqa: E402

ASOF_SQL = O.with_(O.GAMES_RAW, O.CLEAN, O.LONG, O.ELO, O.STATE, O.HYP, O.ASOF)
ASOF_OUT = ["REQUEST_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID"] + FEATURES_43


def resolved_requests(spark, sf_dir, games):
    """The per-league requests, resolved through the name path (digits).  They are
    kept, as resolving them reads them several times, and all games with them."""
    teams = teams_table(spark, sf_dir)
    req = ordered.kept(tables.requests_from_games(games))
    return resolve.resolve_sides(req, teams, {"HOME": "HOME_TEAM_ID", "AWAY": "VISITOR_TEAM_ID"})


def scored_requests(spark, sf_dir):
    g = clean_games(spark, sf_dir)
    served = state_tables(spark, sf_dir)
    # kept: the lookup reads the requests three times
    hyp = resolve.hypothetical_games(ordered.kept(resolved_requests(spark, sf_dir, g)), served.team_last)
    return state.asof_features(hyp, served)


@register("asof_team_state", ASOF_SQL + f"SELECT {O.round_all(ASOF_OUT, FEATURE_DOUBLES)} FROM asof_feat")
def q_asof_team_state(spark, sf_dir):
    return round6(scored_requests(spark, sf_dir).select(*ASOF_OUT))


@register("hypothetical_games", O.with_(O.GAMES_RAW, O.CLEAN, O.HYP) + """
SELECT REQUEST_ID, GAME_ID, GAME_DATE_EST, SEASON, HOME_TEAM_ID, VISITOR_TEAM_ID,
       concat(CAST(SEASON AS VARCHAR), '-', lpad(CAST((SEASON + 1) % 100 AS VARCHAR), 2, '0')) AS season_label
FROM hyp""")
def q_hypothetical_games(spark, sf_dir):
    g = clean_games(spark, sf_dir)
    return resolve.hypothetical_games(resolved_requests(spark, sf_dir, g), g)


KEY_SQL_SIDES = "\nUNION ALL\n".join(
    f"SELECT REQUEST_ID, '{k}' AS feature, {O.rnd(k, 'value')} FROM asof_feat" for k in config.KEY_FEATURES)


@register("key_features", ASOF_SQL + KEY_SQL_SIDES)
def q_key_features(spark, sf_dir):
    from .plans import scoring
    return round6(scoring.key_features(scored_requests(spark, sf_dir)))


@register("explain_features", ASOF_SQL + ", kf AS (" + KEY_SQL_SIDES + """)
SELECT kf.REQUEST_ID, kf.feature, kf.value, coalesce(x.label, kf.feature) AS label, coalesce(x.text, '') AS text
FROM kf LEFT JOIN (VALUES """ + ", ".join(
    "('{}', '{}', '{}')".format(k, lab.replace("'", "''"), txt.replace("'", "''"))
    for k, (lab, txt) in __import__("pregame.plans.scoring", fromlist=["x"]).EXPLANATIONS.items()) + """) x(feature, label, text)
ON x.feature = kf.feature""")
def q_explain_features(spark, sf_dir):
    from .plans import scoring
    return round6(scoring.explain(scoring.key_features(scored_requests(spark, sf_dir))))


NAMES_SQL = O.with_(O.TEAMS) + r"""
, names AS (
  SELECT TEAM_ID AS REQUEST_ID, CASE CAST(TEAM_ID % 8 AS INT)
    WHEN 0 THEN lower(FULL_NAME) WHEN 1 THEN lower(ABBREVIATION) WHEN 2 THEN CAST(TEAM_ID AS VARCHAR)
    WHEN 3 THEN upper(NICKNAME) WHEN 4 THEN '  ' || lower(CITY) || ' ' WHEN 5 THEN lpad(CAST(TEAM_ID AS VARCHAR), 8, '0')
    WHEN 6 THEN substr(FULL_NAME, 9, 9) ELSE 'nobody' || TEAM_ID END AS name
  FROM teams
), n AS (
  SELECT REQUEST_ID, name, lower(regexp_replace(name, '^\s+|\s+$', '', 'g')) AS t,
         regexp_matches(regexp_replace(name, '^\s+|\s+$', '', 'g'), '^[0-9]+$') AS dig FROM names
), r AS (
  SELECT REQUEST_ID, name, dig,
    (SELECT TEAM_ID FROM teams WHERE dig AND TEAM_ID = TRY_CAST(t AS BIGINT)) AS by_id,
    (SELECT TEAM_ID FROM (
        SELECT TEAM_ID, 0 AS p FROM teams WHERE lower(FULL_NAME) = t
        UNION ALL SELECT TEAM_ID, 1 FROM teams WHERE lower(NICKNAME) = t
        UNION ALL SELECT TEAM_ID, 2 FROM teams WHERE lower(ABBREVIATION) = t
        UNION ALL SELECT TEAM_ID, 3 FROM teams WHERE lower(CITY) = t) ORDER BY p, TEAM_ID LIMIT 1) AS by_exact,
    (SELECT min(TEAM_ID) FROM teams WHERE contains(lower(FULL_NAME), t)) AS by_sub
  FROM n)
SELECT REQUEST_ID, name,
  CASE WHEN dig THEN by_id WHEN by_exact IS NOT NULL THEN by_exact ELSE by_sub END AS team_id,
  CASE WHEN dig THEN (CASE WHEN by_id IS NOT NULL THEN 'id' ELSE 'unresolved' END)
       WHEN by_exact IS NOT NULL THEN 'exact' WHEN by_sub IS NOT NULL THEN 'contains' ELSE 'unresolved' END AS team_id_how
FROM r"""


def name_requests(teams):
    """One request a team, in eight kinds: names of every column, ids, padded
    digits, a part of the full name, and nobody's."""
    tid = F.col("TEAM_ID").cast("string")
    kinds = [F.lower("FULL_NAME"), F.lower("ABBREVIATION"), tid, F.upper("NICKNAME"),
             F.concat(F.lit("  "), F.lower("CITY"), F.lit(" ")), F.lpad(tid, 8, "0"),
             F.substring("FULL_NAME", 9, 9), F.concat(F.lit("nobody"), tid)]
    name = kinds[-1]
    for k, x in reversed(list(enumerate(kinds[:-1]))):
        name = F.when(F.col("TEAM_ID") % 8 == k, x).otherwise(name)
    return teams.select(F.col("TEAM_ID").alias("REQUEST_ID"), name.alias("name"))


@register("resolve_team", NAMES_SQL)
def q_resolve_team(spark, sf_dir):
    teams = teams_table(spark, sf_dir)
    return resolve.resolve_names(name_requests(teams), teams, "name", "team_id").select(
        "REQUEST_ID", "name", "team_id", "team_id_how")


@register("team_names", ASOF_SQL + "," + O.TEAMS + """
SELECT q.REQUEST_ID, coalesce(h.FULL_NAME, CAST(q.HOME_TEAM_ID AS VARCHAR)) AS home_team,
       coalesce(a.FULL_NAME, CAST(q.VISITOR_TEAM_ID AS VARCHAR)) AS away_team
FROM hyp q LEFT JOIN teams h ON h.TEAM_ID = q.HOME_TEAM_ID LEFT JOIN teams a ON a.TEAM_ID = q.VISITOR_TEAM_ID""")
def q_team_names(spark, sf_dir):
    g = clean_games(spark, sf_dir)
    hyp = resolve.hypothetical_games(resolved_requests(spark, sf_dir, g), g)
    teams = teams_table(spark, sf_dir)
    out = resolve.team_names(hyp, teams, "HOME_TEAM_ID", "home_team")
    out = resolve.team_names(out, teams, "VISITOR_TEAM_ID", "away_team")
    return out.select("REQUEST_ID", "home_team", "away_team")


@register("conform_teams", O.with_(O.TEAMS) + "SELECT * FROM teams")
def q_conform_teams(spark, sf_dir):
    raw = tables.teams_from_tables(spark, sf_dir).select(
        F.col("TEAM_ID").alias("id"), F.col("ABBREVIATION").alias("abbreviation"),
        F.col("NICKNAME").alias("nickname"), F.col("CITY").alias("city"),
        F.col("FULL_NAME").alias("full_name"))
    return resolve.conform_teams(raw)


@register("teams_sorted", O.with_(O.TEAMS) + """
SELECT TEAM_ID, FULL_NAME, CAST(row_number() OVER (ORDER BY FULL_NAME, TEAM_ID) - 1 AS BIGINT) AS position FROM teams""")
def q_teams_sorted(spark, sf_dir):
    t = tables.teams_from_tables(spark, sf_dir).select("TEAM_ID", "FULL_NAME")
    return ordered.row_index(t, ["FULL_NAME", "TEAM_ID"], "position")


@register("games_head", CLEAN_SQL + f"SELECT {O.round_all(GAME_COLS, GAME_DOUBLES)} FROM clean ORDER BY GAME_DATE_EST, GAME_ID LIMIT 5")
def q_games_head(spark, sf_dir):
    return round6(clean_games(spark, sf_dir).orderBy("GAME_DATE_EST", "GAME_ID").limit(5))


@register("row_index", CLEAN_SQL + """
SELECT GAME_ID, CAST(row_number() OVER (ORDER BY GAME_DATE_EST, GAME_ID) - 1 AS BIGINT) AS row_idx FROM clean""")
def q_row_index(spark, sf_dir):
    return ordered.row_index_by_date(clean_games(spark, sf_dir).select("GAME_ID", "GAME_DATE_EST"),
                                     ["GAME_DATE_EST", "GAME_ID"]).select("GAME_ID", "row_idx")


@register("time_series_folds", FEAT_SQL + f"""
, tr AS (SELECT GAME_ID, CAST(row_number() OVER (ORDER BY GAME_DATE_EST, GAME_ID) - 1 AS BIGINT) AS row_idx
         FROM warm WHERE SEASON < {config.TEST_SEASON_START}),
sz AS (SELECT count(*) // {config.CV_SPLITS + 1} AS ts, count(*) - {config.CV_SPLITS} * (count(*) // {config.CV_SPLITS + 1}) AS st FROM tr)
SELECT GAME_ID, row_idx, CAST(CASE WHEN row_idx >= st THEN (row_idx - st) // ts END AS INT) AS test_fold FROM tr, sz""")
def q_time_series_folds(spark, sf_dir):
    from .plans import models
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    train, _ = features.time_split(warm)
    return models.time_series_folds(train).select("GAME_ID", "row_idx", "test_fold")


def _unpivot_train_sql() -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES_43)
    return (f", tr AS (SELECT {casts} FROM warm WHERE SEASON < {config.TEST_SEASON_START}),\n"
            f"u AS (UNPIVOT tr ON {', '.join(FEATURES_43)} INTO NAME feature VALUE value),\n"
            f"med AS (SELECT feature, quantile_cont(value, 0.5) AS m FROM u GROUP BY feature)\n")


@register("impute_median", FEAT_SQL + _unpivot_train_sql() + f"SELECT feature, {O.rnd('m', 'median')} FROM med")
def q_impute_median(spark, sf_dir):
    from .plans import models
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    train, _ = features.time_split(warm)
    return round6(models.train_medians(train, FEATURES_43))


@register("standardize", FEAT_SQL + _unpivot_train_sql() + f"""
, imp AS (SELECT {', '.join(f"coalesce({c}, (SELECT m FROM med WHERE feature = '{c}')) AS {c}" for c in FEATURES_43)} FROM tr),
ui AS (UNPIVOT imp ON {', '.join(FEATURES_43)} INTO NAME feature VALUE value)
SELECT feature, {O.rnd('avg(value)', 'mean')}, {O.rnd('stddev_pop(value)', 'std')} FROM ui GROUP BY feature""")
def q_standardize(spark, sf_dir):
    from .plans import models
    warm = features.warmup_drop(feature_table(spark, sf_dir))
    train = ordered.kept(features.time_split(warm)[0].select(*FEATURES_43))  # for medians, then moments
    med = models.train_medians(train, FEATURES_43)
    return round6(models.standardization(train, FEATURES_43, med))


# ---- L: audits -------------------------------------------------------------------

@register("audit_cold_start", FEAT_SQL + """
, firsts AS (
  SELECT team, GAME_ID FROM (
    SELECT HOME_TEAM_ID AS team, GAME_ID, GAME_DATE_EST FROM clean
    UNION ALL SELECT VISITOR_TEAM_ID, GAME_ID, GAME_DATE_EST FROM clean)
  QUALIFY row_number() OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID) = 1)
SELECT CAST(count(*) AS BIGINT) AS teams_checked,
       CAST(sum(CASE WHEN (CASE WHEN f.team = x.HOME_TEAM_ID THEN x.home_elo_pre ELSE x.away_elo_pre END) <> 1500.0
                THEN 1 ELSE 0 END) AS BIGINT) AS violations
FROM firsts f JOIN features x ON x.GAME_ID = f.GAME_ID""")
def q_audit_cold_start(spark, sf_dir):
    from .plans import audit
    g = clean_games(spark, sf_dir)
    return audit.cold_start(g, features.build_features(g))


# ---- S5/S6/S7/J1: ingest and sinks ---------------------------------------------------

from .sources import ingest, sinks  # noqa: E402

INGEST_OUT = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID",
              "PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "FT_PCT_home", "FT_PCT_away",
              "FG3_PCT_home", "FG3_PCT_away", "AST_home", "AST_away", "REB_home", "REB_away", "HOME_TEAM_WINS"]
INGEST_DOUBLES = {c for c in INGEST_OUT if c.endswith(("_home", "_away"))}

LOG_SQL = CLEAN_SQL + """
, log AS (
  SELECT lpad(CAST(GAME_ID AS VARCHAR), 10, '0') AS GAME_ID, strftime(GAME_DATE_EST, '%Y-%m-%d') AS GAME_DATE, SEASON,
         HOME_TEAM_ID AS TEAM_ID, 'T' || HOME_TEAM_ID || ' vs. T' || VISITOR_TEAM_ID AS MATCHUP,
         CASE WHEN HOME_TEAM_WINS = 1 THEN 'W' ELSE 'L' END AS WL, PTS_home AS PTS, FG_PCT_home AS FG_PCT,
         CAST(NULL AS DOUBLE) AS FT_PCT, CAST(NULL AS DOUBLE) AS FG3_PCT, AST_home AS AST, CAST(NULL AS DOUBLE) AS REB
  FROM clean
  UNION ALL
  SELECT lpad(CAST(GAME_ID AS VARCHAR), 10, '0'), strftime(GAME_DATE_EST, '%Y-%m-%d'), SEASON,
         VISITOR_TEAM_ID, 'T' || VISITOR_TEAM_ID || ' @ T' || HOME_TEAM_ID,
         CASE WHEN HOME_TEAM_WINS = 0 THEN 'W' ELSE 'L' END, PTS_away, FG_PCT_away,
         NULL, NULL, AST_away, NULL
  FROM clean
), paired AS (
  SELECT CAST(h.GAME_ID AS BIGINT) AS GAME_ID, CAST(h.GAME_DATE AS DATE) AS GAME_DATE_EST, h.SEASON,
         h.TEAM_ID AS HOME_TEAM_ID, a.TEAM_ID AS VISITOR_TEAM_ID,
         h.PTS AS PTS_home, a.PTS AS PTS_away, h.FG_PCT AS FG_PCT_home, a.FG_PCT AS FG_PCT_away,
         h.FT_PCT AS FT_PCT_home, a.FT_PCT AS FT_PCT_away, h.FG3_PCT AS FG3_PCT_home, a.FG3_PCT AS FG3_PCT_away,
         h.AST AS AST_home, a.AST AS AST_away, h.REB AS REB_home, a.REB AS REB_away,
         CAST(coalesce(h.WL = 'W', false) AS INT) AS HOME_TEAM_WINS
  FROM (SELECT * FROM log WHERE contains(MATCHUP, 'vs.')) h
  JOIN (SELECT * FROM log WHERE NOT contains(MATCHUP, 'vs.')) a ON a.GAME_ID = h.GAME_ID
)
"""


@register("pair_game_log", LOG_SQL + f"SELECT {O.round_all(INGEST_OUT, INGEST_DOUBLES)} FROM paired")
def q_pair_game_log(spark, sf_dir):
    log = ingest.game_log_from_games(clean_games(spark, sf_dir))
    return round6(ingest.pair_game_log(log).select(*INGEST_OUT))


@register("ingest_seasons", LOG_SQL + """
SELECT CAST(count(*) AS BIGINT) AS games, CAST(count(DISTINCT SEASON) AS BIGINT) AS seasons FROM paired""")
def q_ingest_seasons(spark, sf_dir):
    path = sinks.scratch_path(spark, "landed-log")
    ingest.land_game_log(ingest.game_log_from_games(clean_games(spark, sf_dir)), path)
    return read_back(ingest.ingest_summary(ingest.ingest_seasons(spark, path)), path)


@register("table_roundtrip", FEAT_SQL + f"SELECT {O.round_all(FEATURE_OUT, FEATURE_DOUBLES)} FROM features")
def q_table_roundtrip(spark, sf_dir):
    path = sinks.scratch_path(spark, "features")
    sinks.write_features(feature_table(spark, sf_dir), path)
    return read_back(round6(spark.read.parquet(path).select(*FEATURE_OUT)), path)


@register("teams_csv_roundtrip", O.with_(O.TEAMS) + "SELECT * FROM teams")
def q_teams_csv_roundtrip(spark, sf_dir):
    path = sinks.scratch_path(spark, "teams-csv")
    sinks.write_table(teams_table(spark, sf_dir), path, "csv")
    return read_back(sinks.load_teams(spark, path, "csv"), path)


@register("games_csv_roundtrip", CLEAN_SQL + f"SELECT {O.round_all(GAME_COLS, GAME_DOUBLES)} FROM clean")
def q_games_csv_roundtrip(spark, sf_dir):
    path = sinks.scratch_path(spark, "games-csv")
    sinks.write_table(raw_games(spark, sf_dir), path, "csv")
    return read_back(round6(sinks.load_games(spark, path, "csv").select(*GAME_COLS)), path)


# ---- L2-L4: audits (what they checked, and that nothing differs) ------------------------

@register("audit_parity", CLEAN_SQL + "SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(0 AS BIGINT) AS differing FROM clean")
def q_audit_parity(spark, sf_dir):
    from .plans import audit
    return audit.parity(clean_games(spark, sf_dir), state_tables(spark, sf_dir))


@register("append_invariance", CLEAN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(0 AS BIGINT) AS existing_rows_changed,
       CAST(1 AS BIGINT) AS synthetic_rows FROM clean""")
def q_append_invariance(spark, sf_dir):
    from .plans import audit
    return audit.append_invariance(clean_games(spark, sf_dir))


@register("audit_counterfactual", CLEAN_SQL + """
, sides AS (
  SELECT HOME_TEAM_ID AS team, GAME_ID, GAME_DATE_EST FROM clean
  UNION ALL SELECT VISITOR_TEAM_ID, GAME_ID, GAME_DATE_EST FROM clean
), firsts AS (
  SELECT GAME_ID FROM sides QUALIFY row_number() OVER (PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID) = 1
), later AS (
  SELECT GAME_ID, row_number() OVER (ORDER BY GAME_DATE_EST, GAME_ID) - 1 AS i, count(*) OVER () AS n
  FROM clean WHERE GAME_ID NOT IN (SELECT GAME_ID FROM firsts))
SELECT GAME_ID AS target_game, CAST(0 AS BIGINT) AS own_row_changed, 1 AS later_rows_change, CAST(0 AS BIGINT) AS linked_outside
FROM later WHERE i = n // 2""")
def q_audit_counterfactual(spark, sf_dir):
    from .plans import audit
    r = audit.counterfactual(clean_games(spark, sf_dir))
    return r.select("target_game", "own_row_changed", (F.col("later_rows_changed") > 0).cast("int").alias("later_rows_change"), "linked_outside")


# ---- M / E6 / E8 / R2 / S9: models -----------------------------------------------------

_TRAINED: dict = {}


def trained(spark, sf_dir):
    """Three fitted models + test metrics for this table, trained once per
    session (the later model queries reuse them, like load_or_train).  The feature
    table is written to the shared folder, like in ``jobs.train_job``, and read back."""
    from .plans import models
    from .sources import sinks
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        path = sinks.scratch_path(spark, "trained")
        sinks.write_features(feature_table(spark, sf_dir), path)
        train, test = features.time_split(features.warmup_drop(spark.read.parquet(path)))
        res = models.train_all(train, test, FEATURES_43, tune=False, stored=True)
        _TRAINED[key] = (res, train, test)
    return _TRAINED[key]


def consistent(prob: str = "home_win_prob"):
    """Is the probability one, its complement too, and the decision theirs?"""
    p = F.col(prob)
    return (p.between(0, 1) & (F.abs(p + F.col("away_win_prob") - 1) < 1e-9)
            & (F.col("predicted_winner") == F.when(p >= config.DECISION_THRESHOLD, "home").otherwise("away"))).cast("int")


def _model_scores(spark, sf_dir, name):
    """Every test game's scores, and its probability recomputed by plain expressions
    from the coefficients or the leaf table."""
    from .plans import certify
    res, _, test = trained(spark, sf_dir)
    return round6(certify.recomputed(res[name]["model"], test, FEATURES_43).select(
        "GAME_ID", config.LABEL, "home_win_prob", "away_win_prob", "predicted_winner", "recomputed_prob"))


@register("logreg_scores")
def q_logreg_scores(spark, sf_dir):
    return _model_scores(spark, sf_dir, "logistic_regression")


@register("dtree_scores")
def q_dtree_scores(spark, sf_dir):
    return _model_scores(spark, sf_dir, "decision_tree")


@register("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    return _model_scores(spark, sf_dir, "gradient_boosted_trees")


_ROWS_SQL = FEAT_SQL + f"""
, n AS (SELECT CAST(count(*) FILTER (SEASON < {config.TEST_SEASON_START}) AS BIGINT) AS train_rows,
               CAST(count(*) FILTER (SEASON >= {config.TEST_SEASON_START}) AS BIGINT) AS test_rows FROM warm)
"""


@register("logreg_certificate", _ROWS_SQL + "SELECT 1 AS optimal, test_rows, CAST(0 AS BIGINT) AS differing FROM n")
def q_logreg_certificate(spark, sf_dir):
    """The fitted coefficients are the stated objective's optimum (gradient below
    1e-4 in every part), and give every test game's score."""
    from .plans import certify
    res, train, test = trained(spark, sf_dir)
    model = res["logistic_regression"]["model"]
    optimal = certify.logreg_gradient(model, train, FEATURES_43) < 1e-4
    return certify.differing_scores(model, test, FEATURES_43).select(F.lit(int(optimal)).alias("optimal"), "test_rows", "differing")


@register("dtree_certificate", _ROWS_SQL + """
SELECT 'leaves' AS what, train_rows AS checked, CAST(0 AS BIGINT) AS wrong FROM n
UNION ALL SELECT 'scores', test_rows, CAST(0 AS BIGINT) FROM n""")
def q_dtree_certificate(spark, sf_dir):
    """Every leaf holds 20 train rows or more, as many as the model says, and
    predicts their share of home wins; the leaf table gives every test game's score."""
    from .plans import certify
    res, train, test = trained(spark, sf_dir)
    model = res["decision_tree"]["model"]
    leaves = certify.wrong_leaves(model, train, FEATURES_43)
    scores = certify.differing_scores(model, test, FEATURES_43)
    return leaves.select(F.lit("leaves").alias("what"), F.col("train_rows").alias("checked"), F.col("bad_leaves").alias("wrong")).union(
        scores.select(F.lit("scores"), "test_rows", "differing"))


@register("gbt_certificate", _ROWS_SQL + "SELECT test_rows, CAST(0 AS BIGINT) AS differing FROM n")
def q_gbt_certificate(spark, sf_dir):
    """The trees' leaf table gives every test game's score."""
    from .plans import certify
    res, _, test = trained(spark, sf_dir)
    return certify.differing_scores(res["gradient_boosted_trees"]["model"], test, FEATURES_43)


@register("report_checks", f"""
SELECT * FROM (VALUES ('metrics', 18::BIGINT, 0::BIGINT), ('best', 1, 0), ('verdict', 1, 0), ('confusion', 3, 0), ('roc', 1, 0),
                      ('calibration', 2, 0), ('importance', {config.TOP_IMPORTANCES}, 0)) t("check", checked, differing)""")
def q_report_checks(spark, sf_dir):
    """The report's numbers against a second path (``report.report_checks``)."""
    from .plans import report
    res, train, test = trained(spark, sf_dir)
    return report.report_checks(spark, res, train, test, FEATURES_43)


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    from .plans import models
    res, train, test = trained(spark, sf_dir)
    table = models.comparison_table(spark, res)
    both = train.unionByName(test)
    base = metrics.baselines(both, F.col("SEASON") >= config.TEST_SEASON_START).select(*table.columns)
    return round6(base.unionByName(table))


@register("select_best")
def q_select_best(spark, sf_dir):
    from .plans import models
    res, _, _ = trained(spark, sf_dir)
    name, entry = models.select_best(res)
    return spark.createDataFrame([(name, float(entry["metrics"]["roc_auc"]))], "model string, roc_auc double")


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    from .plans import models
    res, _, _ = trained(spark, sf_dir)
    from .plans import certify
    _, entry = models.select_best(res)
    again = certify.importances(entry["model"], FEATURES_43)
    other = F.create_map(*[F.lit(x) for kv in again.items() for x in kv])[F.col("feature")]
    return round6(models.feature_importance(entry["model"], FEATURES_43).withColumn("recomputed", other))


@register("model_roundtrip", FEAT_SQL + f"""
SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(0 AS BIGINT) AS changed FROM warm WHERE SEASON >= {config.TEST_SEASON_START}""")
def q_model_roundtrip(spark, sf_dir):
    """Save the best model + feature list, load both back, rescore: test games
    compared, and those whose probability changed."""
    from .plans import models
    res, _, test = trained(spark, sf_dir)
    _, entry = models.select_best(res)
    path = sinks.scratch_path(spark, "model")
    models.save_artifacts(spark, entry["model"], FEATURES_43, path)
    model, cols = models.load_artifacts(spark, path)
    assert cols == FEATURES_43
    a = models.score(entry["model"], test).select("GAME_ID", F.col("prob").alias("a"))
    b = models.score(model, test).select("GAME_ID", F.col("prob").alias("b"))
    changed = ~F.col("a").eqNullSafe(F.col("b"))
    return read_back(a.join(b, "GAME_ID", "full").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_checked"),
        F.coalesce(F.sum(changed.cast("long")), F.lit(0)).cast("bigint").alias("changed")), path)


SERVED_KEYS = list(config.KEY_FEATURES)


@register("score_matchups", ASOF_SQL + "," + O.TEAMS + f"""
SELECT q.REQUEST_ID, q.HOME_TEAM_ID, q.VISITOR_TEAM_ID, 'ok' AS status, CAST(q.GAME_DATE_EST AS VARCHAR) AS game_date,
       concat(CAST(q.SEASON AS VARCHAR), '-', lpad(CAST((q.SEASON + 1) % 100 AS VARCHAR), 2, '0')) AS season_label,
       h.FULL_NAME AS home_team, a.FULL_NAME AS away_team, 1 AS consistent, {', '.join(O.rnd('f.' + k, k) for k in SERVED_KEYS)}
FROM hyp q JOIN asof_feat f ON f.REQUEST_ID = q.REQUEST_ID
JOIN teams h ON h.TEAM_ID = q.HOME_TEAM_ID JOIN teams a ON a.TEAM_ID = q.VISITOR_TEAM_ID
UNION ALL
SELECT -1 - l.LEAGUE, l.LEAGUE * 10, CASE WHEN k = 0 THEN l.LEAGUE * 10 END, CASE WHEN k = 0 THEN 'same team' ELSE 'unknown team' END,
       NULL, NULL, t.FULL_NAME, CASE WHEN k = 0 THEN t.FULL_NAME END, NULL, {', '.join('NULL' for _ in SERVED_KEYS)}
FROM (SELECT DISTINCT LEAGUE, CAST(LEAGUE % 2 AS INT) AS k FROM clean) l JOIN teams t ON t.TEAM_ID = l.LEAGUE * 10""")
def q_score_matchups(spark, sf_dir):
    """The requests of every league, and one each that a guard stops: the same
    team twice, or a team that nobody knows."""
    from .plans import models, scoring
    res, _, _ = trained(spark, sf_dir)
    _, entry = models.select_best(res)
    g = clean_games(spark, sf_dir)
    lg = F.col(config.LEAGUE)
    stopped = g.select(lg).distinct().select(
        (-1 - lg).alias("REQUEST_ID"), (lg * 10).cast("string").alias("HOME"),
        F.when(lg % 2 == 0, (lg * 10).cast("string")).otherwise("nobody").alias("AWAY"), F.lit(None).cast("date").alias("REQUEST_DATE"))
    out = scoring.score_matchups(tables.requests_from_games(g).unionByName(stopped), state_tables(spark, sf_dir),
                                 teams_table(spark, sf_dir), entry["model"])
    return round6(out.select(
        "REQUEST_ID", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "status", F.col("GAME_DATE_EST").cast("string").alias("game_date"),
        "season_label", "home_team", "away_team", consistent().alias("consistent"), *[F.col("key_features")[i]["value"].alias(k) for i, k in enumerate(SERVED_KEYS)]))


@register("evaluate_report")
def q_evaluate_report(spark, sf_dir):
    from .plans import report
    res, train, test = trained(spark, sf_dir)
    path = sinks.scratch_path(spark, "reports")
    out = report.evaluate_report(spark, res, train, test, FEATURES_43, path)
    return read_back(round6(report.long_table(out, spark)), path)


@register("stream_ingest", LOG_SQL + """
SELECT CAST(count(*) AS BIGINT) AS games, CAST(count(DISTINCT SEASON) AS BIGINT) AS seasons FROM paired""")
def q_stream_ingest(spark, sf_dir):
    """Landed logs through the Structured Streaming pairing (available-now
    trigger), summarised from the table the stream wrote."""
    from .streaming import landed_logs
    work = sinks.scratch_path(spark, "stream")
    ingest.land_game_log(ingest.game_log_from_games(clean_games(spark, sf_dir)), f"{work}/landed")
    landed_logs.start_ingest(spark, f"{work}/landed", f"{work}/games", work).awaitTermination()
    return read_back(ingest.ingest_summary(landed_logs.read_games(spark, f"{work}/games")), work)
