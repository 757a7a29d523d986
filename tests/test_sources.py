"""Sources, validation, cleaning and ingest."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pregame.operators import clean
from pregame.sources import ingest, sinks, tables
from small_data import SF_SMALL


def test_missing_required_column_raises(spark):
    g = tables.games_from_tables(spark, SF_SMALL).drop("PTS_away")
    with pytest.raises(ValueError, match="PTS_away"):
        clean.clean_games(g)


def test_missing_file_raises(spark):
    with pytest.raises(FileNotFoundError):
        sinks.load_games(spark, "/tmp/definitely-not-here-pregame", "csv")


def test_drop_happens_before_dedup(spark):
    rows = [(1, None, 0), (1, 5.0, 1), (2, 3.0, 0)]
    df = spark.createDataFrame(rows, "GAME_ID long, PTS_home double, INGEST_SEQ int")
    for c, v in (("GAME_DATE_EST", "2000-01-01"), ("SEASON", 2000), ("HOME_TEAM_ID", 1),
                 ("VISITOR_TEAM_ID", 2), ("PTS_away", 1.0), ("HOME_TEAM_WINS", 1)):
        df = df.withColumn(c, F.lit(v))
    out = {r.GAME_ID: r.PTS_home for r in clean.clean_games(df).collect()}
    assert out == {1: 5.0, 2: 3.0}


def test_clean_counts_single_pass(spark):
    r = clean.clean_counts(tables.games_from_tables(spark, SF_SMALL)).first()
    assert r.rows_in == 1500 and r.rows_kept == 1105 and r.rows_dropped == 395


def test_pair_log_roundtrip(games):
    log = ingest.game_log_from_games(games)
    assert log.count() == 2 * games.count()
    paired = ingest.pair_game_log(log)
    cols = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID",
            "PTS_home", "PTS_away", "HOME_TEAM_WINS"]
    assert paired.select(*cols).exceptAll(games.select(*cols)).count() == 0


def test_unpaired_rows_are_dropped(spark, games):
    log = ingest.game_log_from_games(games)
    one_side = log.filter(~F.col("MATCHUP").contains("vs."))
    assert ingest.pair_game_log(one_side).count() == 0


def test_scratch_tables_live_under_the_checkpoint_folder(spark):
    from pregame.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    assert root and sinks.scratch_path(spark, "x").startswith(root.rstrip("/"))
    assert spark.sparkContext.getCheckpointDir() == root


def test_a_scans_shuffle_holds_no_rows(spark, monkeypatch, tmp_path):
    """Orders and items meet over no more tasks than a shuffle may have that writes its
    rows straight to files, however many there are; the rows stay whole."""
    from datetime import datetime

    from pregame.operators import segments
    monkeypatch.setattr(segments, "ROWS_PER_TASK", 1)
    spark.createDataFrame([(k, k % 30, datetime(1999, 1, 1 + k % 28)) for k in range(300)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, n, 10.0 * n, 0.1) for k in range(300) for n in (1, 2)],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    g = tables.games_from_tables(spark, str(tmp_path))
    assert g.rdd.getNumPartitions() <= 200
    rows = g.collect()
    assert sorted(r.GAME_ID for r in rows) == list(range(300))
    assert all(r.PTS_home == 93 + 3 * (r.GAME_ID % 10) and r.AST_home == r.AST_away == 1 for r in rows)
