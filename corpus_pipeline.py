"""Corpus pipeline: quality rules, language ID, near-duplicate removal,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; the last returns
one row per packed piece.  ``run`` writes each stage's result as Parquet in the
shared folder and reads it back, so a lost executor never re-runs an earlier
stage; a stage's folder goes once the next one is written.

Edge cases, stage by stage: a null, empty or blank text fails the quality rules, and
so never reaches a later stage (alone, it would be no language, fingerprint zero,
clean, and one end id); very long texts are read whole by every stage and cut into
pieces only by the last; repeated rows are one group of near copies, of which one
row stays; of rows with the same smallest id that of the smallest content hash
stays; a null id, language or source is kept as it is; an empty table gives an empty
result; extra columns, whatever their names, come out of all stages but the last as
they went in.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pregame.llm import decontaminate, langid, packing, quality, simhash
from pregame.session import ensure_checkpoint_dir
from pregame.sources import sinks


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble a language."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return simhash.near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: XXH64 fingerprints, trained models and tokenisers are beyond SQL; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            sinks.remove(spark, before)
        before = path
    return docs
