"""Landed game-log ingest: two rows per game (one per team) -> one row per game.

The log is read from landed files (any Spark source); each season's files
land in their own ``SEASON=<year>`` folder, so one read of the root discovers
every season as a partition column -- no per-season loop, no concatenation.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config

LOG_SCHEMA = T.StructType([
    T.StructField("GAME_ID", T.StringType()),
    T.StructField("GAME_DATE", T.StringType()),
    T.StructField("TEAM_ID", T.LongType()),
    T.StructField("MATCHUP", T.StringType()),
    T.StructField("WL", T.StringType()),
    T.StructField("PTS", T.DoubleType()),
    T.StructField("FG_PCT", T.DoubleType()),
    T.StructField("FT_PCT", T.DoubleType()),
    T.StructField("FG3_PCT", T.DoubleType()),
    T.StructField("AST", T.DoubleType()),
    T.StructField("REB", T.DoubleType()),
])
SEASON_LOG_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("SEASON", T.IntegerType())])
KEEP = [f.name for f in LOG_SCHEMA.fields]
STATS = ["PTS", "FG_PCT", "FT_PCT", "FG3_PCT", "AST", "REB"]


def game_log_from_games(games: DataFrame) -> DataFrame:
    """The two-row log a game feed would deliver for these games (ids as
    10-digit text, "A vs. B" for the home row, "B @ A" for the away row)."""
    def side(home: bool):
        me, other = ("HOME_TEAM_ID", "VISITOR_TEAM_ID") if home else ("VISITOR_TEAM_ID", "HOME_TEAM_ID")
        sep = " vs. " if home else " @ "
        won = (F.col(config.LABEL) == 1) if home else (F.col(config.LABEL) == 0)
        sfx = "home" if home else "away"
        return F.struct(
            F.col(me).cast("bigint").alias("TEAM_ID"),
            F.concat(F.lit("T"), F.col(me).cast("string"), F.lit(sep), F.lit("T"),
                     F.col(other).cast("string")).alias("MATCHUP"),
            F.when(won, F.lit("W")).otherwise(F.lit("L")).alias("WL"),
            F.col(f"PTS_{sfx}").alias("PTS"), F.col(f"FG_PCT_{sfx}").alias("FG_PCT"),
            F.lit(None).cast("double").alias("FT_PCT"), F.lit(None).cast("double").alias("FG3_PCT"),
            F.col(f"AST_{sfx}").alias("AST"), F.lit(None).cast("double").alias("REB"))
    log = games.select(
        F.lpad(F.col("GAME_ID").cast("string"), 10, "0").alias("GAME_ID"),
        F.date_format("GAME_DATE_EST", "yyyy-MM-dd").alias("GAME_DATE"), "SEASON",
        F.inline(F.array(side(True), side(False))))
    return log.select(*KEEP, "SEASON")


def pair_game_log(log: DataFrame, season=None) -> DataFrame:
    """Pair the home row ("vs." in MATCHUP) with the away row of each game.

    One groupBy(GAME_ID) with a conditional struct per side replaces the
    filter/filter/self-join: a single shuffle, partial aggregation, and a
    game keeps a row only when both sides arrived (inner-join semantics).
    ``season``: a literal for a single-season log; default = the SEASON
    column (partition folder) of the log.
    """
    log = log.select(*KEEP, *(["SEASON"] if "SEASON" in log.columns else []))
    is_home = F.col("MATCHUP").contains("vs.")
    fields = ["GAME_DATE", "TEAM_ID", "WL", *STATS] + (["SEASON"] if "SEASON" in log.columns else [])
    packed = F.struct(*[F.col(c) for c in fields])
    g = log.groupBy("GAME_ID").agg(F.max(F.when(is_home, packed)).alias("h"),
                                   F.max(F.when(~is_home, packed)).alias("a"))
    g = g.filter(F.col("h").isNotNull() & F.col("a").isNotNull())
    season_col = F.lit(season).cast("int") if season is not None else F.col("h.SEASON").cast("int")
    out = [
        F.col("GAME_ID").cast("bigint").alias("GAME_ID"),
        F.to_date(F.col("h.GAME_DATE")).alias("GAME_DATE_EST"),
        season_col.alias("SEASON"),
        F.col("h.TEAM_ID").alias("HOME_TEAM_ID"),
        F.col("a.TEAM_ID").alias("VISITOR_TEAM_ID"),
    ]
    for s in STATS:
        out += [F.col(f"h.{s}").alias(f"{s}_home"), F.col(f"a.{s}").alias(f"{s}_away")]
    out.append(F.coalesce(F.col("h.WL") == "W", F.lit(False)).cast("int").alias(config.LABEL))
    return g.select(*out)


def land_game_log(log: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a log with one folder per season (SEASON=<year>)."""
    log.write.mode("overwrite").partitionBy("SEASON").format(fmt).save(path)


def ingest_seasons(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One read over every landed season, paired into games."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).schema(SEASON_LOG_SCHEMA)
    return pair_game_log(reader.load(path))


def ingest_summary(games: DataFrame) -> DataFrame:
    return games.agg(F.count(F.lit(1)).cast("bigint").alias("games"),
                     F.countDistinct("SEASON").cast("bigint").alias("seasons"))
