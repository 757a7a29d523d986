"""Constants shared by every job.

Fixed values that must equal the original pipeline's (label name, rolling
windows, Elo parameters, key-feature list) are kept together here.
"""
from __future__ import annotations

# --- fixed values (must match the original pipeline) -----------------------
LABEL = "HOME_TEAM_WINS"
ROLL_WINDOWS = (5, 10)
ELO_INITIAL = 1500.0
ELO_K = 20.0
ELO_HOME_ADVANTAGE = 100.0
ELO_SEASON_REGRESS = 0.75
EWMA_SPAN = 5
RANDOM_STATE = 42
SEASON_OPENING_MONTH = 10
SEASON_OPENING_DAY = 21
DECISION_THRESHOLD = 0.5
KEY_FEATURES = (
    "elo_prob_home",
    "diff_elo",
    "diff_season_winrate",
    "diff_winrate_last10",
    "diff_winrate_last5",
    "h2h_home_winrate",
)
# gradient-boosting random search space: name -> four candidate values
GBT_SEARCH_SPACE = {
    "n_estimators": [100, 150, 200, 300],
    "max_depth": [3, 4, 5, 6],
    "learning_rate": [0.03, 0.05, 0.1, 0.15],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
    "reg_lambda": [1.0, 2.0, 5.0, 10.0],
}
GBT_SEARCH_DRAWS = 25
CV_SPLITS = 3
TOP_IMPORTANCES = 20
TOP_CORRELATIONS = 12
CALIBRATION_BINS = 10
# Columns every games table must carry.
REQUIRED_COLUMNS = [
    "GAME_DATE_EST",
    "HOME_TEAM_ID",
    "VISITOR_TEAM_ID",
    "SEASON",
    "PTS_home",
    "PTS_away",
    LABEL,
]
BASE_COLUMNS = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", LABEL]
# optional box-score stats: long-view name -> (home column, away column)
ADVANCED_STATS = {
    "fg_pct": ("FG_PCT_home", "FG_PCT_away"),
    "fg3_pct": ("FG3_PCT_home", "FG3_PCT_away"),
    "ft_pct": ("FT_PCT_home", "FT_PCT_away"),
    "ast": ("AST_home", "AST_away"),
    "reb": ("REB_home", "REB_away"),
}
# ---------------------------------------------------------------------------

# Seasons of the derived fixture run 1995-2001, so the hold-out starts at 2000
# (the original data used 2024 for its own seasons).
TEST_SEASON_START = 2000

# EWMA with alpha = 2 / (span + 1) = 1/3: weights (2/3)^k.
EWMA_DECAY = 1.0 - 2.0 / (EWMA_SPAN + 1)
# A row that has a value is averaged with at least this many rows before it.
# What lies further back weighs less than (2/3)^96 = 1e-17 of that row's own
# value, below the last bit of a double.
EWMA_LOOKBACK = 96
# A series of at most so many rows needs no blocks: weights reach 1.5^1024 = 1e180.
EWMA_WHOLE = 1024

# LEAGUE is our extra grouping column: the independent unit of the Elo fold.
LEAGUE = "LEAGUE"
SYNTHETIC_GAME_ID = -1
