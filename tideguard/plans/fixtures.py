"""Inputs of the catalogue queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.config import LABELS
from tideguard.sources.readers import read_parallel

# Probability of label L for event e of user u is
# ((e * a + b) % 1000) / 1000 * ((u % 5 + 1) / 5).
SCORE_PARAMETERS = {
    "toxic": (37, 11),
    "severe_toxic": (53, 29),
    "obscene": (71, 5),
    "threat": (89, 43),
    "insult": (97, 17),
    "identity_hate": (113, 61),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, for work that is heavy per row.

    They are read as they lie. A caller with one small file and many cores may
    set ``spark.tideguard.textTasks`` in the session, see ``read_parallel``.
    """
    tasks = spark.conf.get("spark.tideguard.textTasks", None)
    return read_parallel(spark, f"{sf_dir}/documents.parquet", "doc_id", int(tasks) if tasks else None)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored events: real users and times, probabilities by arithmetic."""
    events = table(spark, sf_dir, "events")
    scored = events.select(
        F.col("event_id").alias("id"), "user_id", "ts", "event_type",
        F.concat("event_type", F.lit(" "), "props").alias("comment_text"),
        *[(((F.col("event_id") * a + b) % 1000) / F.lit(1000.0)
           * ((F.col("user_id") % 5 + 1) / F.lit(5.0))).alias(f"prob_{label}")
          for label, (a, b) in SCORE_PARAMETERS.items()])
    actual = {"toxic": (F.col("event_type") == "error").cast("int")}
    for k, label in enumerate(LABELS[1:], start=1):
        actual[label] = ((F.col("id") + k) % 7 == 0).cast("int")
    hard = {f"pred_{x}": F.when(F.col(f"prob_{x}") >= 0.5, 1.0).otherwise(0.0)
            for x in LABELS}
    return scored.withColumns(hard).withColumns(actual)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the labels some of them have (NULL where they have none)."""
    return (long_texts(spark, sf_dir)
            .join(table(spark, sf_dir, "labels"), "doc_id", "left")
            .select(F.col("doc_id").alias("id"), F.col("text").alias("comment_text"),
                    "lang", "source", "n_chars", "quality", "toxic"))


def six_label_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a six-label comment table; labels not given are derived."""
    docs = labelled_documents(spark, sf_dir)
    derived = {
        "toxic": F.coalesce("toxic", F.lit(0)),
        "severe_toxic": F.when((F.col("toxic") == 1) & (F.col("quality") == 0), 1).otherwise(0),
        "obscene": F.when(F.col("quality") == 0, 1).otherwise(0),
    }
    for k, label in enumerate(LABELS[3:], start=3):
        derived[label] = ((F.col("id") + k) % 7 == 0).cast("int")
    return docs.select("id", "comment_text",
                       *[derived[x].cast("int").alias(x) for x in LABELS], "source")


def training_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that carry a label, as a six-label comment table."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return six_label_comments(spark, sf_dir).join(labelled, "id", "left_semi")
