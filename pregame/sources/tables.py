"""Derive the match data model from the driver's star-schema tables.

One order = one game, the ordering customer = the home team, ten customers =
one league, points from the order's line items (odd line numbers score for
the home side, even for the visitors).  The same rule is spelled out as SQL in
``pregame.oracle`` so DuckDB can rebuild it independently.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import segments


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def games_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games table (one row per order) with the optional box-score columns."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    odd = (F.col("l_linenumber") % 2) == 1
    even = (F.col("l_linenumber") % 2) == 0
    # orders and their items meet over as many tasks as they are (the counts are read
    # from the files' footers) and a scan can feed without holding its split in memory;
    # items of no order count for no game
    tasks = segments.unbuffered_tasks(spark, max(2 * orders.count(), li.count()))
    orders = orders.repartition(tasks, "o_orderkey")
    sides = li.filter("l_orderkey IS NOT NULL").repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(
        F.sum(F.when(odd, F.col("l_quantity"))).alias("q1"),
        F.sum(F.when(even, F.col("l_quantity"))).alias("q0"),
        F.max(F.when(odd, F.col("l_discount"))).alias("d1"),
        F.max(F.when(even, F.col("l_discount"))).alias("d0"),
        F.sum(F.when(odd, 1).otherwise(0)).alias("n1"),
        F.sum(F.when(even, 1).otherwise(0)).alias("n0"),
    )
    g = orders.join(sides, orders.o_orderkey == sides.l_orderkey, "left")
    cust = F.col("o_custkey")
    league = F.floor(cust / F.lit(10.0)).cast("bigint")
    home_slot = cust % 10
    away_slot = (cust % 10 + 1 + F.col("o_orderkey") % 9) % 10
    pts_home = (F.lit(83) + F.col("q1").cast("bigint") % 61 + 3 * home_slot).cast("double")
    pts_away = (F.lit(80) + F.col("q0").cast("bigint") % 61 + 3 * away_slot).cast("double")
    return g.select(
        F.col("o_orderkey").alias("GAME_ID"),
        F.col("o_orderdate").cast("date").alias("GAME_DATE_EST"),
        F.year("o_orderdate").cast("int").alias("SEASON"),
        league.alias(config.LEAGUE),
        cust.alias("HOME_TEAM_ID"),
        (league * 10 + away_slot).alias("VISITOR_TEAM_ID"),
        pts_home.alias("PTS_home"),
        pts_away.alias("PTS_away"),
        F.round(F.lit(0.40) + F.col("d1"), 4).alias("FG_PCT_home"),
        F.round(F.lit(0.40) + F.col("d0"), 4).alias("FG_PCT_away"),
        F.col("n1").cast("double").alias("AST_home"),
        F.col("n0").cast("double").alias("AST_away"),
        F.when(F.col("q1").isNull() | F.col("q0").isNull(), F.lit(None))
        .when(pts_home > pts_away, 1).otherwise(0).cast("int").alias(config.LABEL),
    )


def teams_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: one row per customer (names deliberately ambiguous)."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is size-safe
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("TEAM_ID"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ABBREVIATION"),
        F.col("c_mktsegment").alias("NICKNAME"),
        F.col("n_name").alias("CITY"),
        F.col("c_name").alias("FULL_NAME"),
    )


def games_with_duplicates(games: DataFrame) -> DataFrame:
    """Re-delivered rows: every 50th game arrives again with one more home
    point; INGEST_SEQ orders the deliveries (lowest wins)."""
    first = games.withColumn("INGEST_SEQ", F.lit(0))
    again = (games.filter(F.col("GAME_ID") % 50 == 0)
             .withColumn("PTS_home", F.col("PTS_home") + 1)
             .withColumn("INGEST_SEQ", F.lit(1)))
    return first.unionByName(again)


def requests_from_games(games: DataFrame) -> DataFrame:
    """Three match-up requests per league: both orders without a date and one
    with an explicit date."""
    leagues = games.select(config.LEAGUE).distinct()
    lg = F.col(config.LEAGUE)
    reqs = F.array(
        F.struct(F.lit(0).alias("k"), (lg * 10).alias("home"), (lg * 10 + 1).alias("away"),
                 F.lit(None).cast("date").alias("date")),
        F.struct(F.lit(1).alias("k"), (lg * 10 + 1).alias("home"), (lg * 10).alias("away"),
                 F.lit(None).cast("date").alias("date")),
        F.struct(F.lit(2).alias("k"), (lg * 10).alias("home"), (lg * 10 + 1).alias("away"),
                 F.lit("2000-06-15").cast("date").alias("date")),
    )
    return leagues.select(lg, F.inline(reqs)).select(
        (lg * 3 + F.col("k")).alias("REQUEST_ID"),
        F.col("home").cast("string").alias("HOME"),
        F.col("away").cast("string").alias("AWAY"),
        F.col("date").alias("REQUEST_DATE"),
    )
