"""Reading and writing the games / teams / features / report tables."""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import clean
from ..session import ensure_checkpoint_dir

GAME_TYPES = {
    "GAME_ID": "bigint", "GAME_DATE_EST": "date", "SEASON": "int", config.LEAGUE: "bigint",
    "HOME_TEAM_ID": "bigint", "VISITOR_TEAM_ID": "bigint", config.LABEL: "int",
    **{f"{s}_{side}": "double" for s in ("PTS", "FG_PCT", "FT_PCT", "FG3_PCT", "AST", "REB")
       for side in ("home", "away")},
}
TEAM_TYPES = {"TEAM_ID": "bigint", "ABBREVIATION": "string", "NICKNAME": "string",
              "CITY": "string", "FULL_NAME": "string"}


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    try:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            # names from the header, every value as text, typed by name below
            reader = reader.option("header", True).option("inferSchema", False)
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no table at {path}; land the data first") from e
        raise


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def load_games(spark: SparkSession, path: str, fmt: str = "parquet",
               drop_incomplete: bool = True) -> DataFrame:
    """Read a games table (typed by column name), validate the required
    columns before any job runs, then clean it."""
    df = _typed(_read(spark, path, fmt), GAME_TYPES)
    clean.validate_columns(df)
    return clean.clean_games(df, drop_nulls=drop_incomplete)


def load_teams(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _typed(_read(spark, path, fmt), TEAM_TYPES)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_features(features: DataFrame, path: str) -> None:
    """Feature table partitioned by SEASON: the time split then reads only
    its own season folders (partition pruning)."""
    write_table(features, path, "parquet", ["SEASON"])


def write_report(df: DataFrame, path: str, one_file: bool = True) -> None:
    """Report tables as CSV with header; those bounded by models, bins or
    features as one file."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote (scratch, superseded state)."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pregame-{name}-{uuid.uuid4().hex}"
