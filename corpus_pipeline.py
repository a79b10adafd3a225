"""A corpus pipeline over `documents`: five of the training-data operators in a row, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import chunks, decontaminate, jaccard, pieces, toxicity
from voxmill.llm.common import fresh_path, table
from voxmill.session import discard


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts to be toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the least id stays."""
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred in a document before are cut out of the texts; every document stays."""
    return chunks.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text, and of what they decode to."""
    return pieces.round_trip(docs, pieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_similar),
    ("chunk_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("piece_encoding", encode),
]

#: SQL can't express learned scores, chunk digests or merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each returns is written as Parquet to the shared folder and read back, and its input deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
