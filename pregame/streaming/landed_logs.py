"""Landed game-log files as a stream (the batch ingest, incrementally).

Each game arrives as two rows (home "vs.", away "@"), possibly in different
files, micro-batches and seasons, in any order.  Every micro-batch pairs its
rows together with the rows still waiting from earlier ones; pairs are written
to the games table, the others wait on, however long their partner takes.  No
row is ever late: there is no event-time limit, and what is kept between
batches are the unpaired rows alone.

Both outputs of a batch go to folders named after its number and replace what a
failed attempt left there, so a restarted query neither loses nor repeats a
game.  The waiting rows of a batch stay until the one after the next has begun.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import ingest, sinks


def log_stream(spark: SparkSession, path: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of landed log files (one folder per SEASON)."""
    r = spark.readStream.schema(ingest.SEASON_LOG_SCHEMA).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _pair_batch(table_path: str, waiting_path: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        before = f"{waiting_path}/batch={batch_id - 1}"
        if sinks.exists(spark, before):
            rows = rows.unionByName(spark.read.schema(ingest.SEASON_LOG_SCHEMA).parquet(before))
        rows = rows.persist()  # read by both outputs
        games = ingest.pair_game_log(rows)
        games.write.mode("overwrite").partitionBy("SEASON").parquet(f"{table_path}/batch={batch_id}")
        sides = rows.groupBy("GAME_ID").agg(F.count_if(F.col("MATCHUP").contains("vs.")).alias("_h"),
                                            F.count_if(~F.col("MATCHUP").contains("vs.")).alias("_a"))
        alone = sides.filter("_h = 0 OR _a = 0").select("GAME_ID")
        rows.join(alone, "GAME_ID", "left_semi").select(*ingest.SEASON_LOG_SCHEMA.names).write.mode("overwrite").parquet(
            f"{waiting_path}/batch={batch_id}")
        rows.unpersist()
        sinks.remove(spark, f"{waiting_path}/batch={batch_id - 2}")
    return run


def start_ingest(spark: SparkSession, landed: str, table_path: str, work: str, fmt: str = "parquet",
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Pairs landed rows into the games table (folders batch=<n>/SEASON=<year>).
    ``work`` (a scratch folder) holds the stream's checkpoint and the rows that
    wait for their partner."""
    q = (log_stream(spark, landed, fmt, max_files_per_trigger).writeStream
         .foreachBatch(_pair_batch(table_path, f"{work}/waiting"))
         .option("checkpointLocation", f"{work}/checkpoint"))
    return (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")).start()


def read_games(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path).drop("batch")
