"""Streaming ingest of landed logs equals the batch pairing."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pregame.sources import ingest, sinks
from pregame.streaming import landed_logs


@pytest.mark.parametrize("one_by_one", [False, True])
def test_stream_pairs_like_batch(spark, games, one_by_one):
    """All files at once, and one file per trigger with the newest season first
    and home and away rows in different files."""
    work = sinks.scratch_path(spark, "stream-test")
    landed = f"{work}/landed"
    log = ingest.game_log_from_games(games)
    if one_by_one:
        side = F.when(F.col("MATCHUP").contains("vs."), 0).otherwise(1)
        log.repartition(2, side).write.partitionBy("SEASON").parquet(landed)
        files = sorted((os.path.join(d, f) for d, _, fs in os.walk(landed.removeprefix("file:")) for f in fs if f.endswith(".parquet")), reverse=True)
        for i, f in enumerate(files):  # oldest season has the newest time stamp
            os.utime(f, (1_000_000 + 1000 * i,) * 2)
    else:
        ingest.land_game_log(log, landed)
    q = landed_logs.start_ingest(spark, landed, f"{work}/games", work, max_files_per_trigger=1 if one_by_one else None)
    q.awaitTermination(300)
    got, want = landed_logs.read_games(spark, f"{work}/games"), ingest.ingest_seasons(spark, landed)
    assert got.count() == want.count() == games.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_csv_logs_twice(spark, games):
    path = sinks.scratch_path(spark, "csv-log")
    ingest.game_log_from_games(games).write.option("header", True).csv(path)
    for _ in range(2):
        assert ingest.ingest_seasons(spark, path, "csv").count() == games.count()
    assert len(ingest.LOG_SCHEMA) == 11
