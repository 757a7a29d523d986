"""Every registered query with a SQL twin matches DuckDB on sf0.001."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from pregame import catalog
from oracle_check import compare, duck
from small_data import SF_SMALL

# the corpus operators have tests of their own
KEYS = sorted(k for k in E.oracle_sql() if k in catalog.SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 6 + 1 + 43
    assert df.count() > 0


SPLIT_KEYS = ["rolling_form", "rest_days", "ewma_form", "season_winrate", "venue_winrate",
              "head_to_head", "advanced_boxscore", "build_features", "asof_team_state"]


@pytest.mark.parametrize("key", SPLIT_KEYS)
def test_matches_oracle_with_every_series_split(spark, con, key, monkeypatch):
    """The split layout with 211-row segments (so
    every team and pair series is cut many times) still matches DuckDB."""
    from pregame.operators import segments
    from pregame import catalog
    monkeypatch.setattr(segments, "CHUNK_ROWS", 211)
    monkeypatch.setattr(catalog, "_STATE", {})
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["rows"] == r["oracle_rows"] and r["hash_match"], r
