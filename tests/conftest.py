"""Shared fixtures: one local session, the derived games at sf0.001."""
from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from small_data import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pregame.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="pregame-tests")
    yield s


@pytest.fixture(scope="session")
def games(spark):
    from pregame import catalog
    return catalog.clean_games(spark, SF_SMALL).persist()


@pytest.fixture(scope="session")
def feats(games):
    from pregame.operators import features
    return features.build_features(games).persist()
