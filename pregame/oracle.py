"""Independent DuckDB SQL for the correctness gate.

Each entry re-derives its result from the raw parquet views (``orders``,
``lineitem``, ``customer``, ``nation``) with plain SQL, so a Spark result and
its oracle share nothing but the rules.  Doubles are rounded to 6 places on
both sides; counts are BIGINT, flags INT.
"""
from __future__ import annotations

from . import config

R = 6  # rounding places for doubles

GAMES_RAW = """
games_raw AS (
SELECT o.o_orderkey AS GAME_ID, CAST(o.o_orderdate AS DATE) AS GAME_DATE_EST,
       CAST(year(o.o_orderdate) AS INT) AS SEASON,
       CAST(floor(o.o_custkey / 10.0) AS BIGINT) AS LEAGUE,
       o.o_custkey AS HOME_TEAM_ID,
       CAST(floor(o.o_custkey / 10.0) AS BIGINT) * 10 + (o.o_custkey % 10 + 1 + o.o_orderkey % 9) % 10 AS VISITOR_TEAM_ID,
       CAST(83 + CAST(l.q1 AS BIGINT) % 61 + 3 * (o.o_custkey % 10) AS DOUBLE) AS PTS_home,
       CAST(80 + CAST(l.q0 AS BIGINT) % 61 + 3 * ((o.o_custkey % 10 + 1 + o.o_orderkey % 9) % 10) AS DOUBLE) AS PTS_away,
       round(0.40 + l.d1, 4) AS FG_PCT_home, round(0.40 + l.d0, 4) AS FG_PCT_away,
       CAST(l.n1 AS DOUBLE) AS AST_home, CAST(l.n0 AS DOUBLE) AS AST_away,
       CAST(CASE WHEN l.q1 IS NULL OR l.q0 IS NULL THEN NULL
            WHEN 83 + CAST(l.q1 AS BIGINT) % 61 + 3 * (o.o_custkey % 10)
               > 80 + CAST(l.q0 AS BIGINT) % 61 + 3 * ((o.o_custkey % 10 + 1 + o.o_orderkey % 9) % 10)
            THEN 1 ELSE 0 END AS INT) AS HOME_TEAM_WINS
FROM orders o LEFT JOIN (
  SELECT l_orderkey,
         sum(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity END) AS q1, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END) AS q0,
         max(CASE WHEN l_linenumber % 2 = 1 THEN l_discount END) AS d1, max(CASE WHEN l_linenumber % 2 = 0 THEN l_discount END) AS d0,
         sum(CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS n0
  FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
)"""

CLEAN = """
clean AS (
SELECT * FROM games_raw
WHERE GAME_DATE_EST IS NOT NULL AND HOME_TEAM_ID IS NOT NULL AND VISITOR_TEAM_ID IS NOT NULL
  AND SEASON IS NOT NULL AND PTS_home IS NOT NULL AND PTS_away IS NOT NULL AND HOME_TEAM_WINS IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY GAME_ID ORDER BY GAME_DATE_EST) = 1
)"""

TEAMS = """
teams AS (
SELECT c.c_custkey AS TEAM_ID, concat('T', CAST(c.c_custkey AS VARCHAR)) AS ABBREVIATION,
       c.c_mktsegment AS NICKNAME, n.n_name AS CITY, c.c_name AS FULL_NAME
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

LONG = """
long AS (
SELECT GAME_ID, GAME_DATE_EST, SEASON, LEAGUE, HOME_TEAM_ID AS team, VISITOR_TEAM_ID AS opponent, 1 AS is_home,
       PTS_home AS pts_for, PTS_away AS pts_against, HOME_TEAM_WINS AS win, PTS_home - PTS_away AS pt_diff
FROM clean
UNION ALL
SELECT GAME_ID, GAME_DATE_EST, SEASON, LEAGUE, VISITOR_TEAM_ID, HOME_TEAM_ID, 0,
       PTS_away, PTS_home, 1 - HOME_TEAM_WINS, PTS_away - PTS_home
FROM clean
)"""

_WT = "PARTITION BY team ORDER BY GAME_DATE_EST, GAME_ID"
_DECAY = "(1.0 - 2.0 / 6.0)"


def _roll(stat: str, n: int, name: str, upto: int = 1) -> str:
    """upto=1 -> frame ends 1 PRECEDING; upto=0 -> CURRENT ROW."""
    end = "1 PRECEDING" if upto == 1 else "CURRENT ROW"
    start = n if upto == 1 else n - 1
    return f"avg({stat}) OVER ({_WT} ROWS BETWEEN {start} PRECEDING AND {end}) AS {name}"


def _rolling_sql(upto: int = 1) -> str:
    parts = []
    for n in config.ROLL_WINDOWS:
        for s in ("win", "pts_for", "pts_against", "pt_diff"):
            name = f"winrate_last{n}" if s == "win" else f"{s}_last{n}"
            parts.append(_roll(s, n, name, upto))
    return ",\n       ".join(parts)


def _ewma_expr(lst: str) -> str:
    w = f"pow({_DECAY}, len({lst}) - i)"
    return (f"CASE WHEN len({lst}) > 0 AND list_sum(list_transform({lst}, lambda x, i: CASE WHEN x IS NULL THEN 0.0 ELSE {w} END)) > 0 "
            f"THEN list_sum(list_transform({lst}, lambda x, i: coalesce(x, 0.0) * {w})) / "
            f"list_sum(list_transform({lst}, lambda x, i: CASE WHEN x IS NULL THEN 0.0 ELSE {w} END)) END")


TEAMFEAT = f"""
teamfeat0 AS (
SELECT *,
       {_rolling_sql()},
       CAST(date_diff('day', lag(GAME_DATE_EST) OVER ({_WT}), GAME_DATE_EST) AS INT) AS rest_days,
       list(pt_diff) OVER ({_WT} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _ew,
       avg(win) OVER (PARTITION BY team, SEASON ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS season_winrate,
       avg(win) OVER (PARTITION BY team, SEASON, is_home ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS venue_winrate
FROM long
),
teamfeat AS (
SELECT * EXCLUDE (_ew),
       CAST(CASE WHEN rest_days = 1 THEN 1 ELSE 0 END AS INT) AS back_to_back,
       {_ewma_expr('_ew')} AS form_ptdiff_ewma
FROM teamfeat0
)"""

H2H = """
h2h AS (
SELECT GAME_ID,
       CASE WHEN HOME_TEAM_ID = least(HOME_TEAM_ID, VISITOR_TEAM_ID) THEN r ELSE 1.0 - r END AS h2h_home_winrate
FROM (
  SELECT GAME_ID, HOME_TEAM_ID, VISITOR_TEAM_ID,
         avg(CASE WHEN (CASE WHEN HOME_TEAM_WINS = 1 THEN HOME_TEAM_ID ELSE VISITOR_TEAM_ID END)
                       = least(HOME_TEAM_ID, VISITOR_TEAM_ID) THEN 1 ELSE 0 END)
           OVER (PARTITION BY least(HOME_TEAM_ID, VISITOR_TEAM_ID), greatest(HOME_TEAM_ID, VISITOR_TEAM_ID)
                 ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM clean)
)"""

# Elo: recursive CTE stepping the k-th game of every league at once; state per
# league = two 10-slot lists (rating, last season) indexed by team - 10*league.
_NULL10D = "CAST([NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL] AS DOUBLE[])"
_NULL10I = "CAST([NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL] AS INTEGER[])"
ELO = f"""
elo_in AS (
SELECT LEAGUE, GAME_ID, SEASON, HOME_TEAM_WINS AS y,
       CAST(HOME_TEAM_ID - 10 * LEAGUE + 1 AS INTEGER) AS hi,
       CAST(VISITOR_TEAM_ID - 10 * LEAGUE + 1 AS INTEGER) AS ai,
       row_number() OVER (PARTITION BY LEAGUE ORDER BY GAME_DATE_EST, GAME_ID) AS k
FROM clean
),
elo_run AS (
SELECT LEAGUE, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS GAME_ID,
       CAST(NULL AS DOUBLE) AS hpre, CAST(NULL AS DOUBLE) AS apre, CAST(NULL AS DOUBLE) AS e,
       CAST(NULL AS DOUBLE) AS hpost, CAST(NULL AS DOUBLE) AS apost,
       {_NULL10D} AS r, {_NULL10I} AS s
FROM (SELECT DISTINCT LEAGUE FROM elo_in)
UNION ALL
SELECT LEAGUE, k, GAME_ID, hpre, apre, e, hpost, apost,
       list_transform(r, lambda x, i: CASE WHEN i = hi THEN hpost WHEN i = ai THEN apost ELSE x END),
       list_transform(s, lambda x, i: CASE WHEN i = hi OR i = ai THEN SEASON ELSE x END)
FROM (
  SELECT *, hpre + 20.0 * (y - e) AS hpost, apre + 20.0 * ((1 - y) - (1 - e)) AS apost
  FROM (
    SELECT *, 1.0 / (1.0 + pow(10.0, (apre - (hpre + 100.0)) / 400.0)) AS e
    FROM (
      SELECT g.LEAGUE, g.k, g.GAME_ID, g.SEASON, CAST(g.y AS DOUBLE) AS y, g.hi, g.ai, p.r, p.s,
             CASE WHEN p.r[g.hi] IS NULL THEN 1500.0
                  WHEN p.s[g.hi] <> g.SEASON THEN 1500.0 + 0.75 * (p.r[g.hi] - 1500.0)
                  ELSE p.r[g.hi] END AS hpre,
             CASE WHEN p.r[g.ai] IS NULL THEN 1500.0
                  WHEN p.s[g.ai] <> g.SEASON THEN 1500.0 + 0.75 * (p.r[g.ai] - 1500.0)
                  ELSE p.r[g.ai] END AS apre
      FROM elo_run p JOIN elo_in g ON g.LEAGUE = p.LEAGUE AND g.k = p.k + 1
    ) a
  ) b
) c
),
elo AS (
SELECT GAME_ID, hpre AS home_elo_pre, apre AS away_elo_pre, e AS elo_prob_home,
       hpre - apre AS diff_elo, hpost AS home_elo_post, apost AS away_elo_post
FROM elo_run WHERE k > 0
)"""

ENGINEERED = ([f"winrate_last{n}" if s == "win" else f"{s}_last{n}"
               for n in config.ROLL_WINDOWS for s in ("win", "pts_for", "pts_against", "pt_diff")]
              + ["rest_days", "back_to_back", "form_ptdiff_ewma", "season_winrate", "venue_winrate"])


def _feature_select() -> str:
    cols = []
    for c in ENGINEERED:
        cols += [f"h.{c} AS home_{c}", f"a.{c} AS away_{c}"]
        if c != "back_to_back":
            cols.append(f"h.{c} - a.{c} AS diff_{c}")
    return ", ".join(cols)


FEATURES = f"""
features AS (
SELECT g.GAME_ID, g.GAME_DATE_EST, g.SEASON, g.HOME_TEAM_ID, g.VISITOR_TEAM_ID, g.HOME_TEAM_WINS, g.LEAGUE,
       {_feature_select()},
       x.h2h_home_winrate, e.home_elo_pre, e.away_elo_pre, e.elo_prob_home, e.diff_elo
FROM clean g
LEFT JOIN teamfeat h ON h.GAME_ID = g.GAME_ID AND h.is_home = 1
LEFT JOIN teamfeat a ON a.GAME_ID = g.GAME_ID AND a.is_home = 0
LEFT JOIN h2h x ON x.GAME_ID = g.GAME_ID
LEFT JOIN elo e ON e.GAME_ID = g.GAME_ID
)"""

WARM = f"""
warm AS (
SELECT * FROM features WHERE diff_winrate_last5 IS NOT NULL AND diff_winrate_last10 IS NOT NULL
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"


def rnd(expr: str, alias: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's decimal rounding never
    # yields -0.0)
    return f"(round({expr}, {R}) + 0.0) AS {alias}"


def round_all(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(rnd(c, c) if c in doubles else c for c in cols)


def _okey(date: str, gid: str) -> str:
    """(date, id) as one sortable number for DuckDB's ASOF join."""
    return f"(date_diff('day', DATE '1970-01-01', {date}) * 1000000000 + {gid} + 1)"


_WTC = "PARTITION BY l.team ORDER BY l.GAME_DATE_EST, l.GAME_ID"
_STATE_ROLL = ",\n       ".join(
    f"avg({s}) OVER ({_WTC} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS "
    + (f"winrate_last{n}" if s == "win" else f"{s}_last{n}")
    for n in config.ROLL_WINDOWS for s in ("win", "pts_for", "pts_against", "pt_diff"))

STATE = f"""
state0 AS (
SELECT l.team, l.GAME_DATE_EST AS sdate, l.SEASON AS sseason, {_okey('l.GAME_DATE_EST', 'l.GAME_ID')} AS okey,
       {_STATE_ROLL},
       list(pt_diff) OVER ({_WTC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _ew,
       avg(win) OVER (PARTITION BY team, l.SEASON ORDER BY l.GAME_DATE_EST, l.GAME_ID ROWS UNBOUNDED PRECEDING) AS season_winrate,
       avg(CASE WHEN is_home = 1 THEN win END) OVER (PARTITION BY team, l.SEASON ORDER BY l.GAME_DATE_EST, l.GAME_ID ROWS UNBOUNDED PRECEDING) AS home_venue,
       avg(CASE WHEN is_home = 0 THEN win END) OVER (PARTITION BY team, l.SEASON ORDER BY l.GAME_DATE_EST, l.GAME_ID ROWS UNBOUNDED PRECEDING) AS away_venue,
       CASE WHEN is_home = 1 THEN e.home_elo_post ELSE e.away_elo_post END AS elo_post
FROM long l JOIN (SELECT GAME_ID AS eg, home_elo_post, away_elo_post FROM elo) e ON e.eg = l.GAME_ID
),
state AS (SELECT * EXCLUDE (_ew), {_ewma_expr('_ew')} AS form_ptdiff_ewma FROM state0),
pstate AS (
SELECT least(HOME_TEAM_ID, VISITOR_TEAM_ID) AS lo, greatest(HOME_TEAM_ID, VISITOR_TEAM_ID) AS hi,
       {_okey('GAME_DATE_EST', 'GAME_ID')} AS okey,
       avg(CASE WHEN (CASE WHEN HOME_TEAM_WINS = 1 THEN HOME_TEAM_ID ELSE VISITOR_TEAM_ID END)
                     = least(HOME_TEAM_ID, VISITOR_TEAM_ID) THEN 1 ELSE 0 END)
         OVER (PARTITION BY least(HOME_TEAM_ID, VISITOR_TEAM_ID), greatest(HOME_TEAM_ID, VISITOR_TEAM_ID)
               ORDER BY GAME_DATE_EST, GAME_ID ROWS UNBOUNDED PRECEDING) AS low_rate
FROM clean
)"""

# three requests per league: both orders with no date, one with a date
HYP = f"""
req AS (
SELECT LEAGUE * 3 + k AS REQUEST_ID, CASE WHEN k = 1 THEN LEAGUE * 10 + 1 ELSE LEAGUE * 10 END AS HOME_TEAM_ID,
       CASE WHEN k = 1 THEN LEAGUE * 10 ELSE LEAGUE * 10 + 1 END AS VISITOR_TEAM_ID,
       CASE WHEN k = 2 THEN DATE '2000-06-15' END AS REQUEST_DATE
FROM (SELECT DISTINCT LEAGUE FROM clean), range(0, 3) t(k)
),
hyp AS (
SELECT REQUEST_ID, CAST(-1 AS BIGINT) AS GAME_ID,
       CASE WHEN REQUEST_DATE IS NULL THEN make_date(CAST(ms + 1 AS BIGINT), 10, 21) ELSE REQUEST_DATE END AS GAME_DATE_EST,
       CAST(CASE WHEN REQUEST_DATE IS NULL THEN ms + 1 ELSE ms END AS INT) AS SEASON,
       CAST(HOME_TEAM_ID AS BIGINT) AS HOME_TEAM_ID, CAST(VISITOR_TEAM_ID AS BIGINT) AS VISITOR_TEAM_ID
FROM req, (SELECT max(SEASON) AS ms FROM clean)
)"""

_SIDE_ENG = ([f"winrate_last{n}" if s == "win" else f"{s}_last{n}"
              for n in config.ROLL_WINDOWS for s in ("win", "pts_for", "pts_against", "pt_diff")])

ASOF = f"""
rs AS (
SELECT REQUEST_ID, HOME_TEAM_ID AS team, 1 AS is_home, GAME_DATE_EST, SEASON, {_okey('GAME_DATE_EST', 'GAME_ID')} AS okey FROM hyp
UNION ALL
SELECT REQUEST_ID, VISITOR_TEAM_ID, 0, GAME_DATE_EST, SEASON, {_okey('GAME_DATE_EST', 'GAME_ID')} FROM hyp
),
side AS (
SELECT r.REQUEST_ID, r.is_home, {', '.join('s.' + c for c in _SIDE_ENG)},
       CAST(date_diff('day', s.sdate, r.GAME_DATE_EST) AS INT) AS rest_days,
       CAST(CASE WHEN date_diff('day', s.sdate, r.GAME_DATE_EST) = 1 THEN 1 ELSE 0 END AS INT) AS back_to_back,
       s.form_ptdiff_ewma,
       CASE WHEN s.sseason = r.SEASON THEN s.season_winrate END AS season_winrate,
       CASE WHEN s.sseason = r.SEASON THEN (CASE WHEN r.is_home = 1 THEN s.home_venue ELSE s.away_venue END) END AS venue_winrate,
       CASE WHEN s.team IS NULL THEN 1500.0 WHEN s.sseason <> r.SEASON THEN 1500.0 + 0.75 * (s.elo_post - 1500.0)
            ELSE s.elo_post END AS elo_pre
FROM rs r ASOF LEFT JOIN state s ON r.team = s.team AND r.okey > s.okey
),
hh AS (
SELECT h.REQUEST_ID, p.low_rate FROM
  (SELECT REQUEST_ID, least(HOME_TEAM_ID, VISITOR_TEAM_ID) AS lo, greatest(HOME_TEAM_ID, VISITOR_TEAM_ID) AS hi,
          {_okey('GAME_DATE_EST', 'GAME_ID')} AS okey FROM hyp) h
  ASOF LEFT JOIN pstate p ON h.lo = p.lo AND h.hi = p.hi AND h.okey > p.okey
),
asof_feat AS (
SELECT q.REQUEST_ID, q.GAME_DATE_EST, q.SEASON, q.HOME_TEAM_ID, q.VISITOR_TEAM_ID,
       {_feature_select()},
       CASE WHEN q.HOME_TEAM_ID = least(q.HOME_TEAM_ID, q.VISITOR_TEAM_ID) THEN x.low_rate ELSE 1.0 - x.low_rate END AS h2h_home_winrate,
       h.elo_pre AS home_elo_pre, a.elo_pre AS away_elo_pre,
       1.0 / (1.0 + pow(10.0, (a.elo_pre - (h.elo_pre + 100.0)) / 400.0)) AS elo_prob_home,
       h.elo_pre - a.elo_pre AS diff_elo
FROM hyp q
LEFT JOIN side h ON h.REQUEST_ID = q.REQUEST_ID AND h.is_home = 1
LEFT JOIN side a ON a.REQUEST_ID = q.REQUEST_ID AND a.is_home = 0
LEFT JOIN hh x ON x.REQUEST_ID = q.REQUEST_ID
)"""
