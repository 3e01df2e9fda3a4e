"""The training-data pipeline: documents in, tokens out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared folder and hands the reread table to the
next stage, so that a lost executor costs a re-read. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm import decontamination, mixing, quality_classifier, setsketch, token_files
from tideguard.llm.common import free_name, table
from tideguard.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality classifier rejects go."""
    net = quality_classifier.train(docs, table(spark, sf_dir, "labels"), quality_classifier.learn_from())
    return quality_classifier.accepted(docs, net, quality_classifier.THRESHOLD)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near-duplicates the row with the smallest id stays, of several the first.

    Rows are judged by a stored number, so rows that repeat an id or have none count each; a null id comes last.
    """
    row = free_name("_row_of_the_stage", docs.columns)
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    judged = setsketch.near_duplicates(numbered, key=row).select(F.col("doc_id").alias(row), "component_id")
    stays = (judged.join(numbered.select(row, "doc_id"), row).groupBy("component_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("s")).select(f"s.{row}"))
    return numbered.join(stays, row, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold an item of the benchmark go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix of the sources draws it."""
    return mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the ids of all documents, written to files and read back."""
    return token_files.round_trip(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
    ("token_files", tokens),
]

#: Trained models and tokenizers have no SQL form; tests/llm compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
