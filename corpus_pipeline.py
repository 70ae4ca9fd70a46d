"""The corpus pipeline: documents in, a deduplicated, mixed and encoded corpus out.

STAGES are run in order; each gets the rows that its predecessor kept, written as Parquet
and read again, and all but the last return the columns of ``documents``. A stage's own
staged tables are deleted when the next stage begins, as its result is written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.llm import exact_dedup, mixing, ngram_join, pieces, quality
from reelcat.llm.common import only_ids
from reelcat.session import renewed_scope, stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a hard rule go, and those that fail any rule on a host with mostly failing documents."""
    return quality.quality_rules(docs).where("kept").select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of 0.85 on 4-word shingles the one with the smallest id stays.

    Rows are told apart by a number, so those without an id, or that share one, have a verdict each.
    """
    docs = stage_table(docs.withColumn("__number", F.monotonically_increasing_id()), "pipeline-numbered")  # fixed once written
    found = ngram_join.ngram_rows(docs, number="__number")
    dropped = stage_table(found.where("NOT kept").select(F.col("r").alias("__number")), "pipeline-dropped")
    return only_ids(docs, dropped, "__number", "left_anti").drop("__number")


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources levelled by temperature: every document once at least, those of small sources up to three times."""
    return mixing.mixed(docs).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids; what the ids decode to must be the text."""
    back = pieces.encode(docs, with_decoded=True)
    exact = F.col("decoded") == F.coalesce("row.text", F.lit(""))
    return back.select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"), exact.alias("exact"))


def _alone(stage):
    """``stage`` with a staging folder of its own, for which the last stage's is deleted."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with renewed_scope(spark, "pipeline-stage"):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _alone(quality_rules)),
    ("exact_dedup", _alone(exact_duplicates)),
    ("ngram_join", _alone(near_duplicates)),
    ("mixing", _alone(mixing_weights)),
    ("sentencepiece", _alone(sentencepiece)),
]

#: SQL can't express the last stage: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
