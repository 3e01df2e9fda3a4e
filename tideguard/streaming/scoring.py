"""Scoring a stream of comments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideguard.config import DEFAULT_LEXICON, DEFAULTS, ModerationConfig
from tideguard.functions.scoring import apply_thresholds
from tideguard.operators.filters import lexicon_hit, override_by_lexicon, validate_comments
from tideguard.operators.responses import score_response
from tideguard.session import store


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType,
                      files_per_trigger: int | None = None) -> DataFrame:
    """The tables ``name*.parquet`` of a folder as a stream, each a file or a folder of files.

    The name is part of the path: a filter on file names would miss the files of a folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{name}*.parquet")


def score_stream(comments: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str,
                 checkpoint: str, config: ModerationConfig = DEFAULTS,
                 key: str = "id", available_now: bool = True,
                 lexicon: Sequence[str] = DEFAULT_LEXICON) -> StreamingQuery:
    """Check, score and answer every comment of a stream.

    ``scorer`` takes (key, comment_text), the key being the number of a row in
    the micro-batch, and returns key and the ``prob_L`` columns; it is ordinary batch code (a fitted pipeline, or a join with a
    weight table), run on each micro-batch. A word of ``lexicon`` flags a comment
    that the model leaves clean, and the answer says so. Answers land in ``out/accepted``,
    refused comments with their reason in ``out/rejected``. Each micro-batch
    owns one folder and overwrites it, so a batch that runs again after a
    failure leaves no copies.
    """
    def handle(batch: DataFrame, number: int) -> None:
        # Keys may repeat: each row gets a number, written down so that it stays.
        checked = store(validate_comments(batch.select(key, "comment_text"), config=config)
                        .withColumn("__row", F.monotonically_increasing_id()), "stream-batch")
        try:
            (checked.df.filter("NOT accepted").select(key, "reason")
             .write.mode("overwrite").parquet(f"{out}/rejected/batch={number}"))
            accepted = checked.df.filter("accepted").select("__row", key, "comment_text")
            scores = scorer(accepted.select(F.col("__row").alias(key), "comment_text"))
            scored = accepted.join(scores.drop("comment_text").withColumnRenamed(key, "__row"), "__row").drop("__row")
            flags = override_by_lexicon(apply_thresholds(scored, config), lexicon_hit(F.col("comment_text"), lexicon))
            (score_response(flags, config, key)
             .write.mode("overwrite").parquet(f"{out}/accepted/batch={number}"))
        finally:
            checked.discard()

    writer = (comments.writeStream.foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def answers(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/accepted").drop("batch")


def rejected(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/rejected").drop("batch")


def score_in_stream(comments: DataFrame, model, config: ModerationConfig = DEFAULTS,
                    key: str = "id", lexicon: Sequence[str] = DEFAULT_LEXICON) -> DataFrame:
    """The same answers as a plain streaming DataFrame, for a fitted pipeline
    that scores row by row; goes to any sink. ``refused_in_stream`` has the rest."""
    checked = validate_comments(comments, config=config).filter("accepted")
    flags = override_by_lexicon(apply_thresholds(model.transform(checked), config),
                                lexicon_hit(F.col("comment_text"), lexicon))
    return score_response(flags, config, key)


def refused_in_stream(comments: DataFrame, config: ModerationConfig = DEFAULTS, key: str = "id") -> DataFrame:
    """(key, reason) of the comments that ``score_in_stream`` does not answer."""
    return validate_comments(comments, config=config).filter("NOT accepted").select(key, "reason")
