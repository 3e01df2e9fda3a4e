"""The moderation jobs end to end, each a function a scheduler can call.

ingest -> build_corpus -> train -> predict -> aggregate_users / report
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import DEFAULTS, LABELS, ModerationConfig
from tideguard.functions.hashing import stable_row_id
from tideguard.functions.scoring import apply_thresholds
from tideguard.operators import harmonize, profile, reports, training
from tideguard.operators.ids import number_copies
from tideguard.sources import readers, writers


def ingest(spark: SparkSession, csv_path: str, out: str, quarantine: str | None = None) -> DataFrame:
    """Labelled CSV to Parquet partitioned by ``toxic``; returns the NULL counts.

    A row that does not parse is an error, or goes to the table at ``quarantine``.
    """
    if quarantine is None:
        rows = readers.read_csv(spark, csv_path, readers.COMMENT_SCHEMA)
    else:
        rows, bad = readers.split_csv(spark, csv_path, readers.COMMENT_SCHEMA)
        writers.write_table(bad, quarantine)
    writers.write_partitioned(rows, out, "toxic")
    return profile.null_counts(spark.read.parquet(out))


def build_corpus(sources: Sequence[DataFrame], target: str) -> DataFrame:
    """Harmonised sources published as one table; returns expected and stored
    rows per source. Each source is computed once, and counted on its way."""
    return writers.publish_sources([harmonize.conform(s) for s in sources], target)


def train(corpus: DataFrame, model_path: str, card_path: str,
          config: ModerationConfig = DEFAULTS) -> training.MultiLabelResult:
    """Fit, save and document the six label models."""
    result = training.train_multilabel(with_id(corpus), config)
    result.model.save(model_path)
    training.model_card(result.metrics).coalesce(1).write.mode("overwrite").json(card_path)
    return result


def _content(comments: DataFrame) -> list[str]:
    return [c for c in ("comment_text", "source") if c in comments.columns]


def with_id(comments: DataFrame) -> DataFrame:
    """A table without an id gets one from its content. Copies share it, and so
    never stand on both sides of a split."""
    if "id" in comments.columns:
        return comments
    return comments.withColumn("id", stable_row_id(*[F.col(c) for c in _content(comments)]))


def with_unique_id(comments: DataFrame) -> DataFrame:
    """A table without an id gets one that tells copies apart, as results are joined on it."""
    return comments if "id" in comments.columns else number_copies(comments, _content(comments))


def predict(comments: DataFrame, model: training.MultiLabelModel, out: str) -> None:
    """Score every comment with text, in one pass from scan to write.

    A table without ids is numbered first (stored once, and one shuffle)."""
    keep = ["id", "row_order", "clean_text", *[c for c in (*LABELS, "user_id") if c in comments.columns]]
    text = with_unique_id(in_row_order(comments)).filter(F.col("comment_text").isNotNull())
    # The text that is stored is the one the model's first stage has cleaned.
    scored = model.score(text, keep).withColumnRenamed("clean_text", "comment_text")
    writers.write_table(scored.withColumn("id", F.col("id").cast("string")), out)


def in_row_order(comments: DataFrame) -> DataFrame:
    """Adds ``row_order``: a numeric id, or else the place of the row in the input."""
    if "row_order" in comments.columns:
        return comments
    numeric = "id" in comments.columns and isinstance(comments.schema["id"].dataType, T.NumericType)
    return comments.withColumn("row_order", F.col("id") if numeric else F.monotonically_increasing_id())


def aggregate_users(spark: SparkSession, predictions: str, out: str) -> None:
    """User statistics from hard predictions, and the risky users among them."""
    df = readers.load_predictions(spark, predictions)
    writers.write_table(reports.user_stats_actual(df), f"{out}/user_stats")
    writers.write_table(reports.user_stats_predicted(df), f"{out}/flagged_users")


def report(spark: SparkSession, predictions: str, out: str, run_date: str,
           config: ModerationConfig = DEFAULTS) -> None:
    """The five reports as CSV. Each reads only the columns it needs; only the
    flagged comments read text, and only they grow with the input. The reports
    do not depend on each other and are submitted together."""
    flags = apply_thresholds(readers.load_predictions(spark, predictions), config)
    jobs = {
        "summary": (lambda: reports.moderation_summary(flags, run_date), True),
        "category_breakdown": (lambda: reports.category_breakdown(flags), True),
        "flagged_comments": (lambda: reports.flagged_comments(flags, run_date), False),
        "high_risk_users": (lambda: reports.high_risk_users(flags, run_date, config), False),
        "volume_buckets": (lambda: reports.volume_buckets(flags, config, "row_order"), True),
    }

    def write(name):
        build, single_file = jobs[name]
        writers.write_report(build(), f"{out}/{name}", single_file)

    with ThreadPoolExecutor(len(jobs)) as pool:
        list(pool.map(write, jobs))
