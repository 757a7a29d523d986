"""How often the Elo recurrence runs in a query (once for each feature table)."""
from __future__ import annotations

import pytest

from small_data import SF_SMALL
from pregame import catalog
from pregame.operators import elo


@pytest.fixture()
def counted(spark, monkeypatch):
    """Rows that went through the recurrence."""
    rows = spark.sparkContext.accumulator(0)
    rate = elo._rate

    def counting(batches):
        def seen():
            for b in batches:
                rows.add(len(b))
                yield b
        return rate(seen())
    monkeypatch.setattr(elo, "_rate", counting)
    return rows


@pytest.mark.parametrize("key,times", [
    ("build_features", 1), ("time_split", 1), ("baselines", 1), ("roc_points", 1), ("decile_rate", 1), ("standardize", 1),
    ("impute_median", 1), ("audit_parity", 1), ("append_invariance", 2), ("audit_counterfactual", 0), ("asof_team_state", 0)])  # the audit: one league, twice
def test_runs_of_the_recurrence(spark, games, counted, key, times):
    catalog.state_tables(spark, SF_SMALL)  # built once a session
    before = counted.value
    catalog.QUERIES[key](spark, SF_SMALL).collect()
    # the appended game of append_invariance is one row more
    assert (counted.value - before) // games.count() == times
