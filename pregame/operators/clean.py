"""Validation, incomplete-row drop, key dedup (the games cleaning step)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def validate_columns(df: DataFrame, required=config.REQUIRED_COLUMNS) -> DataFrame:
    """Raise ValueError listing the required columns a table lacks (no job runs)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"games table is missing required columns: {missing}")
    return df


def incomplete(required=config.REQUIRED_COLUMNS):
    cond = F.lit(False)
    for c in required:
        cond = cond | F.col(c).isNull()
    return cond


def drop_incomplete(df: DataFrame, required=config.REQUIRED_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(required))


def clean_counts(df: DataFrame, required=config.REQUIRED_COLUMNS) -> DataFrame:
    """Rows before / kept / dropped in one aggregate pass (no second scan)."""
    bad = incomplete(required)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_in"),
        F.sum(F.when(bad, 0).otherwise(1)).cast("bigint").alias("rows_kept"),
        F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias("rows_dropped"),
    )


def dedup_games(df: DataFrame, key: str = "GAME_ID", order_col: str = "INGEST_SEQ") -> DataFrame:
    """Keep one row per key: the lowest ``order_col`` (first delivery).

    ``min(struct(order, <all columns>))`` is a declarative aggregate, so Spark
    combines map-side before the shuffle: a key re-delivered billions of times
    still leaves each task as one partial row (no hot group in one task).  The
    remaining columns break ties, so the pick is deterministic.
    """
    others = [c for c in df.columns if c not in (key, order_col)]
    lead = [order_col] if order_col in df.columns else []
    packed = F.struct(*[F.col(c) for c in lead + others]).alias("_row")
    out = df.groupBy(key).agg(F.min(packed).alias("_row"))
    return out.select(key, *[F.col(f"_row.{c}").alias(c) for c in lead + others]).select(
        *df.columns)


def with_game_id(df: DataFrame, key: str = "GAME_ID") -> DataFrame:
    """A table without game ids gets its 0-based position in the total order
    (date, teams, then every other column) as GAME_ID -- a distributed row
    index, not a single-partition window."""
    if key in df.columns:
        return df
    from . import ordered
    lead = [c for c in ("GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID") if c in df.columns]
    order = lead + [c for c in df.columns if c not in lead]
    return ordered.row_index(df, order, key)


def clean_games(df: DataFrame, drop_nulls: bool = True, key: str = "GAME_ID",
                assume_unique: bool = False) -> DataFrame:
    """validate -> drop incomplete (before dedup) -> int label -> dedup.

    ``assume_unique`` skips the dedup shuffle for sources whose key is already
    guaranteed unique.  No global sort: every consumer orders within its own
    window by the total order (GAME_DATE_EST, GAME_ID), so a sort here would
    only add a shuffle.
    """
    validate_columns(df)
    if drop_nulls:
        df = drop_incomplete(df)
    df = df.withColumn(config.LABEL, F.col(config.LABEL).cast("int"))
    df = with_game_id(df, key)
    if not assume_unique:
        df = dedup_games(df, key)
    if "INGEST_SEQ" in df.columns:
        df = df.drop("INGEST_SEQ")
    return df
